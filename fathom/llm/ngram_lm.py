"""Language-model scoring with an Elias-Fano n-gram trie.

Tasks cut training texts into words by numpy alone. For every order from 2 up they count (context, successor) pairs locally,
a context being the words before the successor, and send compact sorted blocks to the shard of the pair's hash, so that a very
common context is spread over all shards. A shard's task merges its blocks, keeps the counted pairs in a file, and sends each
context's sums to the shard of the context's hash. There the context level is built: hashes and counts (as running sums) in
Elias-Fano sequences, and 8-bit logarithms of the back-off weights. With it the shards of pairs are finished: their
contexts, monotone pointers to where each context's successors start, the successors, and 8-bit logarithms of the
discounted probabilities. All successors are one monotone Elias-Fano sequence: a context's are stored above the last value of the context before.

For scoring, workers memory-map the files and look up each batch's distinct pairs: the context's place by its hash, its two
pointers, the value before the first of them, and relative to that the successor, searched between the pointers.
P(w | u) = p(u, w) + b(u) P(w | u less its first word), with each context's absolute discount estimated from its own counts
of one and two, and P(w) from the exact counts, likewise discounted in favour of one unknown word. Nothing is
pruned, and neither the driver nor a task ever holds more than a shard.

Words are told apart by 56 bits of a hash, successors of one context by 40: of V different words an expected
V**2 / 2**57 share a hash (0.07 of 100 million), of k successors of a context k**2 / 2**41 (0.5 of a million). An unknown word is
taken for a known one with a probability of V / 2**56. Counts are exact but for these.
"""

from __future__ import annotations

import json
import struct
import uuid
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import as_batch, byte_slices, discard, scratch_path, written
from .elias_fano import EliasFano
from .storage import mapped, put, remove

U64 = np.uint64
HASH_BITS, NEXT_BITS = 56, 40  # of a word's hash; of the part kept for a successor
BEGIN, END = (1 << HASH_BITS) - 1, (1 << HASH_BITS) - 2  # context of the first word; token after the last word
SHARD_BYTES = 24 << 20  # training text to a shard
TASK_PAIRS, SCORE_BYTES = 2 << 20, 4 << 20
MAPPED = 1 << 30  # bytes of files that a worker keeps mapped
LOWEST = 8.0  # the smallest probability that a code can tell from none is 10 ** -LOWEST
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """56-bit hashes of all words of texts that stand one after another, and the number of words of each.

    ``ends`` are the texts' ends. A word's hash adds each byte times a random number of its place in the
    word, then mixes in the length.
    """
    counts = np.zeros(len(ends), np.int64)
    if not len(data):
        return np.zeros(0, U64), counts
    letter = ~SPACE[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    first[edges] = letter[edges]  # a word ends with its text
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, U64), counts
    at = np.flatnonzero(letter)
    word = np.cumsum(first[at]) - 1
    place = (at - starts[word]).astype(U64)
    begins = np.flatnonzero(first[at])
    h = np.add.reduceat((FOLD[data[at]].astype(U64) + U64(1)) * (mixed((place + U64(1)) * U64(0x9E3779B97F4A7C15)) | U64(1)), begins)
    length = np.diff(np.append(begins, len(at))).astype(U64)
    h = mixed(h ^ (length * U64(0xD6E8FEB86659FD93))) >> U64(64 - HASH_BITS)
    np.add.at(counts, np.searchsorted(ends, starts, "right"), 1)
    return np.minimum(h, U64(END - 1)), counts


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ends of a string column, nulls as empty."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def pairs_of(hashes: np.ndarray, counts: np.ndarray, order: int = 2) -> tuple[np.ndarray, list[np.ndarray]]:
    """Every token, the end of each text included, and for each order from 2 its context: a hash of the words before.

    Before the first word stands BEGIN. The context of order 2 is the hash of the one word before.
    """
    tokens = np.insert(hashes, np.cumsum(counts), U64(END))
    starts = np.concatenate(([0], np.cumsum(counts + 1)[:-1])).astype(np.int64)

    def shifted(x: np.ndarray) -> np.ndarray:
        before = np.empty_like(x)
        before[1:] = x[:-1]
        before[starts] = U64(BEGIN)
        return before

    word = shifted(tokens)
    contexts = [word]
    for _ in range(order - 2):
        word = shifted(word)
        contexts.append(np.minimum(mixed(contexts[-1] * U64(0x9E3779B97F4A7C15) ^ word) >> U64(64 - HASH_BITS), U64(END - 1)))
    return tokens, contexts


def shard_of(context: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a context's sums, by ranges of its hash."""
    return ((context >> U64(HASH_BITS - 32)) * U64(shards) >> U64(32)).astype(np.int64)


def pair_shard(context: np.ndarray, part: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a pair, by a hash of both sides."""
    return ((mixed(context ^ (part * U64(0x9E3779B97F4A7C15))) >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)


def planes(x: np.ndarray, width: int) -> bytes:
    """Bytes of equal weight together: they pack better."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(raw: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def to_block(contexts: np.ndarray, runs: np.ndarray, following: np.ndarray, counts: np.ndarray) -> bytes:
    """Counted pairs in order: each context once with its number of successors."""
    parts = [planes(contexts, 8), planes(runs, 4), planes(following, NEXT_BITS // 8), planes(counts, 5)]
    return struct.pack("<QQ", len(contexts), len(following)) + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def from_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, m = struct.unpack_from("<QQ", block)
    raw, out, at = zstandard.ZstdDecompressor().decompress(block[16:]), [], 0
    for size, width in ((n, 8), (n, 4), (m, NEXT_BITS // 8), (m, 5)):
        out.append(unplanes(raw[at : at + size * width], size, width))
        at += size * width
    return tuple(out)


def counted(before: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, successor part) pairs in order, with their counts."""
    names, ids = np.unique(before, return_inverse=True)
    order_next, next_ids = np.unique(tokens >> U64(HASH_BITS - NEXT_BITS), return_inverse=True)
    keys = (ids.astype(U64) << U64(32)) | next_ids.astype(U64)
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    keys = keys[first]
    counts = np.diff(np.append(first, len(before)))
    return names[(keys >> U64(32)).astype(np.int64)], order_next[(keys & U64(0xFFFFFFFF)).astype(np.int64)], counts


def code_of(p: np.ndarray) -> np.ndarray:
    """8-bit codes of probabilities on a logarithmic scale; 0 is none."""
    with np.errstate(divide="ignore"):
        steps = 1 + np.rint((1 + np.maximum(np.log10(p), -LOWEST) / LOWEST) * 254)
    return np.where(p > 0, steps, 0).astype(np.uint8)


DECODE = np.concatenate(([0.0], 10.0 ** ((np.arange(255) / 254 - 1) * LOWEST)))


def runs_of(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts, and the end of the last."""
    return np.append(np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64), len(keys)).astype(np.int64)


def merge_pairs(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, runs, successors, counts) of a shard's blocks, in order and each pair once."""
    parts = [from_block(b) for b in blocks]
    names, rank = np.unique(np.concatenate([np.repeat(c, r.astype(np.int64)) for c, r, _, _ in parts]), return_inverse=True)
    keys = (rank.astype(U64) << U64(NEXT_BITS)) | np.concatenate([f for _, _, f, _ in parts])
    counts = np.concatenate([n for _, _, _, n in parts]).astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = runs_of(keys)[:-1]
    keys, counts = keys[first], np.add.reduceat(counts, first)
    runs = np.bincount((keys >> U64(NEXT_BITS)).astype(np.int64), minlength=len(names))
    return names, runs, keys & U64((1 << NEXT_BITS) - 1), counts


def sums_of(names: np.ndarray, runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of (context, tokens, kinds, ones, twos) as 64-bit integers."""
    starts = np.concatenate(([0], np.cumsum(runs)[:-1])).astype(np.int64)
    ones, twos = (np.add.reduceat((counts == k).astype(np.int64), starts) for k in (1, 2))
    return np.column_stack([names.astype(np.int64), np.add.reduceat(counts, starts), runs, ones, twos])


def discounts(kinds: np.ndarray, ones: np.ndarray, twos: np.ndarray) -> np.ndarray:
    """A context's absolute discount, by leaving one out."""
    return (ones + 1) / (ones + 2 * twos + 1)


def build_contexts(blocks: list[bytes], path: str) -> dict:
    """Merge the sums of a shard's contexts, write the level to ``path``, and return the shard's own sums."""
    rows = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.int64).reshape(-1, 5) for b in blocks])
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    first = runs_of(rows[:, 0])[:-1]
    names = rows[first, 0].astype(U64)
    total, kinds, ones, twos = (np.add.reduceat(rows[:, k], first) for k in range(1, 5))
    discount = discounts(kinds, ones, twos)
    arrays, sizes = levels(contexts=(names, 1 << HASH_BITS), sums=(np.concatenate(([0], np.cumsum(total))), int(total.sum()) + 1))
    arrays |= {"back": code_of(discount * kinds / total), "discount": discount.astype(np.float32)}
    real = names < U64(END)
    put(path, file_of(arrays, sizes))
    return {"words": int(real.sum()), "tokens": int(total.sum()), "ones": int((total[real] == 1).sum()), "twos": int((total[real] == 2).sum())}


def build_pairs(names: np.ndarray, runs: np.ndarray, following: np.ndarray, counts: np.ndarray, total: np.ndarray, discount: np.ndarray, path: str) -> None:
    """Write a shard's pairs to ``path``, with their contexts' totals and discounts."""
    rank = np.repeat(np.arange(len(names)), runs)
    starts = np.concatenate(([0], np.cumsum(runs)))
    tops = np.cumsum(following[starts[1:] - 1])  # the last value of each context
    values = following + np.concatenate((np.zeros(1, U64), tops[:-1]))[rank]
    arrays, sizes = levels(contexts=(names, 1 << HASH_BITS), starts=(starts, int(starts[-1]) + 1), next=(values, int(tops[-1]) + 1))
    put(path, file_of(arrays | {"p": code_of(np.maximum(counts - discount[rank], 0) / total[rank])}, sizes))


def levels(**sequences: tuple[np.ndarray, int]) -> tuple[dict[str, np.ndarray], dict]:
    """Arrays and sizes of Elias-Fano sequences, each given with its universe."""
    arrays, sizes = {}, {}
    for name, (values, universe) in sequences.items():
        ef = EliasFano.of(np.asarray(values, U64), universe)
        sizes[name] = (ef.n, ef.width)
        arrays |= {f"{name}.{k}": v for k, v in ef.arrays.items()}
    return arrays, sizes


def file_of(arrays: dict[str, np.ndarray], sizes: dict) -> list[bytes]:
    """A header line in JSON, then the arrays, each at a multiple of 8 bytes."""
    at, places, data = 0, {}, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        places[name] = (at, len(a), a.dtype.str)
        data.append(raw + bytes(-len(raw) % 8))
        at += len(data[-1])
    head = json.dumps({"sizes": sizes, "places": places}).encode()
    head += b" " * (-(len(head) + 8) % 8)
    return [struct.pack("<Q", len(head)), head, *data]


class Level:
    """A memory-mapped file of the trie: its Elias-Fano sequences and plain arrays by name."""

    def __init__(self, path: str):
        whole = mapped(path)
        self.bytes = len(whole)
        (n,) = struct.unpack_from("<Q", whole)
        head = json.loads(whole[8 : 8 + n])
        self.plain = {name: np.frombuffer(whole, kind, size, 8 + n + at) for name, (at, size, kind) in head["places"].items()}
        self.ef = {k: EliasFano(*size, {part: self.plain[f"{k}.{part}"] for part in ("low", "high", "ones")}) for k, size in head["sizes"].items()}

    def context(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count or 0, back-off weight, discount) of each context."""
        place = self.ef["contexts"].find(hashes)
        known = np.flatnonzero(place >= 0)
        count, back, discount = np.zeros(len(hashes), np.int64), np.ones(len(hashes)), np.zeros(len(hashes))
        at = place[known]
        count[known] = (self.ef["sums"].access(at + 1) - self.ef["sums"].access(at)).astype(np.int64)
        back[known], discount[known] = DECODE[self.plain["back"][at]], self.plain["discount"][at]
        return count, back, discount

    def successor(self, contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Discounted probabilities of the tokens after the contexts; 0 if never seen."""
        out = np.zeros(len(contexts))
        place = self.ef["contexts"].find(contexts)
        there = np.flatnonzero(place >= 0)
        first, end = self.ef["starts"].access(place[there]).astype(np.int64), self.ef["starts"].access(place[there] + 1).astype(np.int64)
        base = np.where(first > 0, self.ef["next"].access(np.maximum(first - 1, 0)), U64(0))
        found = self.ef["next"].find(base + (tokens[there] >> U64(HASH_BITS - NEXT_BITS)), first, end)
        hit = found >= 0
        out[there[hit]] = DECODE[self.plain["p"][found[hit]]]
        return out

    def followers(self, contexts: np.ndarray) -> np.ndarray:
        """How many successors this shard has of each context, from its pointers."""
        place = self.ef["contexts"].find(contexts)
        at, starts = np.maximum(place, 0), self.ef["starts"]
        return np.where(place >= 0, (starts.access(at + 1) - starts.access(at)).astype(np.int64), 0) if starts.n > 1 else np.zeros(len(contexts), np.int64)


def look_up(contexts: np.ndarray, shards: int, level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, back-off weight, discount) of contexts in order, each from the level of its shard (None: there is none)."""
    count, back, discount = np.zeros(len(contexts), np.int64), np.ones(len(contexts)), np.zeros(len(contexts))
    home = shard_of(contexts, shards)
    for k in np.unique(home).tolist():
        if found := level(k):
            own = slice(*np.searchsorted(home, [k, k + 1]))
            count[own], back[own], discount[own] = found.context(contexts[own])
    return count, back, discount


@dataclass
class Model:
    contexts: list[list[str | None]]  # by order from 2: files of the context level by shard
    pairs: list[list[str | None]]  # and of the pairs
    texts: int
    tokens: int
    words: int  # distinct, without the end
    ones: int
    twos: int

    def __post_init__(self):
        self.maps: dict[str, Level] = {}

    def __getstate__(self):
        return self.__dict__ | {"maps": {}}

    def level(self, path: str | None) -> Level | None:
        """A mapped file; those used longest ago are let go beyond MAPPED bytes."""
        if not path:
            return None
        found = self.maps.pop(path, None) or Level(path)
        while self.maps and sum(x.bytes for x in self.maps.values()) + found.bytes > MAPPED:
            self.maps.pop(next(iter(self.maps)))
        self.maps[path] = found
        return found

    @property
    def kinds(self) -> int:
        return self.words + bool(self.texts)

    def seen_after(self, files: list[str | None], contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Discounted probabilities of pairs, each from the file of its shard; 0 if never seen."""
        p = np.zeros(len(contexts))
        home = pair_shard(contexts, tokens >> U64(HASH_BITS - NEXT_BITS), len(files))
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(len(files) + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            if level := self.level(files[k]):
                own = order[cuts[k] : cuts[k + 1]]
                p[own] = level.successor(contexts[own], tokens[own])
        return p

    def score(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known tokens, base score, score) of each text."""
        tokens, contexts = pairs_of(hashes, counts, len(self.pairs) + 1)
        starts = np.concatenate(([0], np.cumsum(counts + 1)[:-1])).astype(np.int64)
        names, where = np.unique(np.concatenate((contexts[0], tokens)), return_inverse=True)
        w = where[len(tokens) :]
        p = None
        for k, context in enumerate(contexts):
            found, u = (names, where[: len(tokens)]) if k == 0 else np.unique(context, return_inverse=True)
            total, back, _ = look_up(found, len(self.contexts[k]), lambda i, files=self.contexts[k]: self.level(files[i]))
            if k == 0:
                count = total.copy()
                count[names == U64(END)] = self.texts
                p = self.alone(count)[w]
            pairs, at = np.unique((u.astype(U64) << U64(32)) | w.astype(U64), return_inverse=True)
            pu, pw = (pairs >> U64(32)).astype(np.int64), (pairs & U64(0xFFFFFFFF)).astype(np.int64)
            tried = np.flatnonzero((total[pu] > 0) & (count[pw] > 0))
            after = np.zeros(len(pairs))
            after[tried] = self.seen_after(self.pairs[k], found[pu[tried]], names[pw[tried]])
            p = after[at] + back[u] * p
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))
        known = np.add.reduceat((count[w] > 0).astype(np.int64), starts)
        return known, np.add.reduceat(base[w], starts), np.add.reduceat(np.log10(np.minimum(p, 1.0)), starts)

    def alone(self, count: np.ndarray) -> np.ndarray:
        """P(w) from counts; all unknown words are one, which gets what the discount leaves."""
        if not self.tokens:
            return np.ones(len(count))
        d = min(0.95, max(0.05, self.ones / max(1, self.ones + 2 * self.twos)))
        return np.where(count > 0, (count - d) / self.tokens, d * self.kinds / self.tokens)


def learn(texts: DataFrame, text_col: str = "text", shard_bytes: int = SHARD_BYTES, order: int = 2) -> Model:
    """Build the trie of orders 2 to ``order`` of all rows of ``texts`` in the shared folder; null texts are empty ones.

    ``shard_bytes`` of training text go to a shard of each order: a task's memory is about six times that.
    """
    spark = texts.sparkSession
    narrow = texts.select(F.col(text_col).alias("text"))
    size, rows = narrow.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards, depth = max(1, -(-(size or 0) // shard_bytes)), order - 1
    folder = scratch_path(spark, "trie")
    # Shard k of the order o is number (o - 2) * shards + k.

    def local(batches):
        kept, n = [], 0

        def flush():
            tokens = np.concatenate([t for t, _ in kept])
            for level in range(depth):
                names, following, counts = counted(np.concatenate([c[level] for _, c in kept]), tokens)
                home = pair_shard(names, following, shards)
                by_home = np.argsort(home, kind="stable")
                names, following, counts = names[by_home], following[by_home], counts[by_home]
                cuts = np.searchsorted(home[by_home], np.arange(shards + 1))
                for k in np.flatnonzero(np.diff(cuts)).tolist():
                    part = slice(cuts[k], cuts[k + 1])
                    ends = runs_of(names[part])
                    block = to_block(names[part][ends[:-1]], np.diff(ends), following[part], counts[part])
                    yield pa.RecordBatch.from_arrays([pa.array([level * shards + k], pa.int32()), pa.array([block], pa.binary())], ["shard", "block"])

        for b in byte_slices(batches, 0, SCORE_BYTES):
            kept.append(pairs_of(*words_of(*buffers(b.column(0))), order))
            n += len(kept[-1][0])
            if n >= TASK_PAIRS:
                yield from flush()
                kept, n = [], 0
        if kept:
            yield from flush()

    def gathered(batches):
        """(shard, blocks) of a partition, which is a shard."""
        shard, blocks = None, []
        for b in batches:
            blocks += b.column(1).to_pylist()
            shard = b.column(0)[0].as_py() if b.num_rows else shard
        return shard, blocks

    def merge(batches):
        shard, blocks = gathered(batches)
        if not blocks:
            return
        names, runs, following, counts = merge_pairs(blocks)
        path = f"{folder}/counts-{shard:06d}-{uuid.uuid4().hex[:8]}"
        put(path, [to_block(names, runs, following, counts)])
        rows = sums_of(names, runs, counts)
        cuts = np.searchsorted(shard_of(names, shards), np.arange(shards + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            block = zstandard.ZstdCompressor(level=1).compress(rows[cuts[k] : cuts[k + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([shard // shards * shards + k], pa.int32()), pa.array([block], pa.binary()), pa.array([shard], pa.int32()), pa.array([path])], ["shard", "block", "from", "path"])

    def build(batches):
        shard, blocks = gathered(batches)
        if blocks:
            path = f"{folder}/contexts-{shard:06d}-{uuid.uuid4().hex[:8]}.trie"
            made = build_contexts(blocks, path)
            yield as_batch(arrow, [shard], [path], *([made[k]] for k in arrow.names[2:]))

    def finish(batches):
        level = cache(Level)
        for b in batches:
            for shard, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                names, runs, following, counts = from_block(bytes(mapped(source)))
                total, _, discount = look_up(names, shards, lambda k, files=contexts[shard // shards]: level(files[k]) if files[k] else None)
                path = f"{folder}/pairs-{shard:06d}-{uuid.uuid4().hex[:8]}.trie"
                build_pairs(names, runs.astype(np.int64), following, counts.astype(np.int64), total, discount, path)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([path]), pa.array([source])], ["shard", "path", "source"])

    def listed(paths: dict[int, str]) -> list[list[str | None]]:
        return [[paths.get(level * shards + k) for k in range(shards)] for level in range(depth)]

    sums = "shard int, path string, words long, tokens long, ones long, twos long"
    arrow = to_arrow_schema(T._parse_datatype_string(sums))
    every = depth * shards
    merged = written(narrow.mapInArrow(local, "shard int, block binary").repartitionById(every, "shard").mapInArrow(merge, "shard int, block binary, from int, path string"), "sums")
    made = merged.select("shard", "block").repartitionById(every, "shard").mapInArrow(build, sums).collect()
    contexts = listed({r["shard"]: r["path"] for r in made})
    sources = merged.select(F.col("from").alias("shard"), "path").distinct()
    finished = sources.repartitionById(every, "shard").mapInArrow(finish, "shard int, path string, source string").collect()
    for r in finished:
        remove(r["source"])
    ends = [rows] if rows else []
    total = {k: sum(r[k] for r in made if r["shard"] < shards) for k in ("tokens", "words", "ones", "twos")}
    discard(merged)
    return Model(contexts, listed({r["shard"]: r["path"] for r in finished}), rows, total["tokens"], total["words"], total["ones"] + ends.count(1), total["twos"] + ends.count(2))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``carry``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are words after A-Z are lower-cased, and one end a text; null and empty texts are the end
    alone. ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1))) over the tokens, ``score`` the model's log10 probabilities. A
    model of no texts gives 0 for both. Null ids and repeated rows are carried, and equal texts score alike. Columns named neither way are not touched.
    """
    names = [f"c{i}" for i in range(len(carry) + 1)]
    narrow = docs.select(*(F.col(c).alias(n) for c, n in zip((id_col, *carry), names, strict=True)), F.col(text_col).alias("text"))
    added = {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType()}
    schema = T.StructType([*(narrow.schema[n] for n in names), *(T.StructField(k, t) for k, t in added.items())])
    arrow, at = to_arrow_schema(schema), len(names)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the paths and sums of the shards, not the trie

    def run(batches):
        lm = shared.value
        for b in byte_slices(batches, at, SCORE_BYTES):
            hashes, counts = words_of(*buffers(b.column(at)))
            known, base, scores = lm.score(hashes, counts)
            yield as_batch(arrow, *b.columns[:at], counts + 1, known, np.full(len(counts), lm.tokens), base, scores)

    return narrow.mapInArrow(run, schema).toDF(id_col, *carry, *added)
