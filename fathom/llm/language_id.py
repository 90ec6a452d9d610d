"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is lower-cased, whatever is no letter becomes one space, and each byte n-gram (1 to 4 bytes) of the
result is hashed into a table of embeddings. The mean embedding goes through a linear softmax. Table and
softmax are trained in numpy by mini-batch gradient descent on a bounded sample of labelled texts;
a temperature and the rejection threshold are fitted on a part of the sample that training does not see.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import as_batch, byte_slices

BUCKETS, DIMS, GRAMS = 1 << 13, 16, 4
#: Texts of the training sample, all languages together: expected number, drawn by a hash of the id.
SAMPLE = 2000
EPOCHS, MINI, RATE, DECAY = 60, 64, 0.5, 1e-6
BLOCK = 1 << 20  # bytes of a text hashed at once
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def has_letter(cleaned: str) -> bool:
    return any(map(str.isalpha, cleaned))


def clean(text: str | None) -> str:
    """Lower-case letters with one space between stretches; characters that \\w has beside letters stay."""
    return f" {NOT_LETTERS.sub(' ', (text or '').lower()).strip()} "


def buckets(cleaned: bytes, starts: int) -> np.ndarray:
    """The buckets of the byte n-grams that begin in the first ``starts`` bytes."""
    b = np.frombuffer(cleaned, np.uint8).astype(np.uint32)
    found, h = [], np.zeros(len(b), np.uint32)
    for n in range(1, GRAMS + 1):
        if len(b) < n:
            break
        h = (h[: len(b) - n + 1] * np.uint32(0x01000193)) ^ (b[n - 1 :] + np.uint32(n << 8))
        mixed = h * np.uint32(0x9E3779B1)
        found.append(mixed[:starts] >> np.uint32(32 - 13))
    return np.concatenate(found)


def blocks(cleaned: str) -> Iterator[np.ndarray]:
    """How often each bucket is met, by blocks of a very long text; an n-gram counts in the block that it begins in."""
    raw = cleaned.encode("utf-8")
    for at in range(0, len(raw), BLOCK):
        yield np.bincount(buckets(raw[at : at + BLOCK + GRAMS - 1], BLOCK), minlength=BUCKETS)


def frequencies(cleaned: str) -> np.ndarray:
    """Mean one-hot vector of a text's n-grams."""
    total = sum(blocks(cleaned), np.zeros(BUCKETS))
    return (total / total.sum()).astype(np.float16)


@dataclass
class Model:
    names: list[str]
    table: np.ndarray  # BUCKETS x languages: embeddings times the softmax's weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, accepted); ``und``, 0 and False without a letter or a language to choose."""
        cleaned = clean(text)
        if not self.names or not has_letter(cleaned):
            return UNKNOWN, 0.0, False
        total, n = np.zeros(len(self.names)), 0
        for found in blocks(cleaned):
            total += found @ self.table
            n += found.sum()
        p = softmax((total / n + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.names[best], float(p[best]), bool(p[best] >= self.threshold)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(x: np.ndarray, y: list[str], seed: int = 7) -> Model:
    """Train on rows of frequencies (16-bit floats) with their languages; a fifth is kept apart for calibration."""
    names = sorted(set(y))
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    target = np.searchsorted(names, y)
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    scale = np.sqrt(BUCKETS)  # mean vectors are short: without it the gradients are too
    e, w, bias = rng.normal(0, 0.1, (BUCKETS, DIMS)), rng.normal(0, 0.1, (DIMS, len(names))), np.zeros(len(names))
    for epoch in range(EPOCHS):
        rng.shuffle(used)
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(used), MINI):
            rows = used[at : at + MINI]
            xs = x[rows].astype(np.float32) * np.float32(scale)
            mean = xs @ e
            g = softmax(mean @ w + bias)
            g[np.arange(len(rows)), target[rows]] -= 1
            g /= len(rows)
            back = g @ w.T
            w -= rate * (mean.T @ g + DECAY * w)
            bias -= rate * g.sum(axis=0)
            e -= rate * (xs.T @ back)
    table = scale * (e @ w)
    part = held if len(held) >= 20 else order
    z, t = x[part].astype(np.float32) @ table + bias, target[part]
    heat = min(np.geomspace(0.25, 8, 61), key=lambda k: -np.log(softmax(z / k)[np.arange(len(t)), t] + 1e-12).mean())
    p = softmax(z / heat)
    right = p.max(axis=1)[p.argmax(axis=1) == t]
    # Rejected is what is less sure than nearly all right answers, and never what has an even chance.
    threshold = float(min(0.5, np.quantile(right, 0.001))) if len(right) else 0.0
    return Model(names, table, bias, float(heat), threshold)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` labelled texts, as many of each language, chosen by a hash of the id.

    Rows without text or language are not learned from. The languages' counts cover all rows.
    """
    known = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit(np.zeros((0, BUCKETS)), [])
    share = sample / len(counts)
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    keep: Column = F.lit(False)
    for name, n in sorted(counts.items()):
        keep = keep | ((F.col("lang") == name) & (draw < min(1.0, share / n)))

    def vectors(batches):
        for b in byte_slices(batches, 0):
            cleaned = [clean(t) for t in b.column(0).to_pylist()]
            rows = [(lang, frequencies(c).tobytes()) for c, lang in zip(cleaned, b.column(1).to_pylist(), strict=True) if has_letter(c)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["lang", "x"])

    found = known.where(keep).select("text", "lang").mapInArrow(vectors, "lang string, x binary").toArrow()
    names, column = found.column("lang").to_pylist(), found.column("x")
    order = sorted(range(len(names)), key=lambda i: (names[i], column[i].as_buffer().to_pybytes()))
    x = np.empty((len(order), BUCKETS), np.float16)
    for at, i in enumerate(order):
        x[at] = np.frombuffer(column[i].as_buffer(), np.float16)
    return fit(x, [names[i] for i in order])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the columns named in ``carry``, ``lang_pred``, ``score``, ``accepted``.

    Only the whole text is looked at. Null texts and texts without a letter get ``und``, 0 and False.
    Null ids and repeated rows are carried. Columns named neither way are not touched. The model holds
    BUCKETS x languages numbers, which is what is broadcast.
    """
    names = [f"c{i}" for i in range(len(carry) + 1)]
    narrow = docs.select(*(F.col(c).alias(n) for c, n in zip((id_col, *carry), names, strict=True)), F.col(text_col).alias("text"))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
    schema = T.StructType([*(narrow.schema[n] for n in names), *added])
    arrow, at = to_arrow_schema(schema), len(names)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        for b in byte_slices(batches, at):
            found = [fitted.predict(t) for t in b.column(at).to_pylist()]
            yield as_batch(arrow, *b.columns[:at], *([f[i] for f in found] for i in range(3)))

    return narrow.mapInArrow(run, schema).toDF(id_col, *carry, "lang_pred", "score", "accepted")
