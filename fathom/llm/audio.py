"""Audio features of media columns: polyphase resampling, log-mel frames, energy segments, Arrow tensors.

A clip is stored as a WAV file of 8-bit mono samples and every feature is computed from the bytes read
back. The signal is resampled by 3/4 with a windowed-sinc polyphase filter, cut into overlapped Hann
frames and turned into log-mel energies. Frames are stored as fixed-shape tensors (``PATCH`` x ``MELS``)
with the time span of each, in an Arrow IPC stream; the last patch is filled up with the floor value and
its span ends with the clip. Segments come from the frames' log energy by hysteresis: one opens above the
upper threshold and closes below the lower one.
"""

from __future__ import annotations

import hashlib
import io
import json
import wave
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import as_batch, byte_slices

UNIT, RATE = 192, 8000  # payload bytes come in multiples of UNIT; samples a second
UP, DOWN, TAPS = 3, 4, 8  # resampling ratio; filter taps on either side, per phase
FRAME, HOP, FFT, MELS, PATCH = 150, 60, 256, 16, 32
FLOOR, OPEN_DB, CLOSE_DB = 1e-8, 3.0, 1.0  # thresholds stand above and below the clip's mean level
BLOCK = 1 << 14  # frames, and samples of a phase, computed at once
BATCH_BYTES = 4 << 20


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes filled up with spaces to a positive multiple of UNIT, and their number before."""
    raw = (text or "").encode("utf-8")
    return raw + b" " * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw)), len(raw)


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as w:
        return w.readframes(w.getnframes())


@cache
def phases() -> np.ndarray:
    """Filter taps by output phase (UP x 2*TAPS); each phase sums to 1, so a constant stays constant."""
    offsets = np.arange(-TAPS + 1, TAPS + 1)
    rows = []
    for k in range(UP):
        t = offsets - (k * DOWN % UP) / UP
        h = np.sinc(t * min(1, UP / DOWN)) * np.cos(np.pi * t / (2 * TAPS + 1)) ** 2
        rows.append(h / h.sum())
    return np.array(rows, dtype=np.float64)


def resample(x: np.ndarray) -> np.ndarray:
    """``x`` at UP/DOWN of its rate; beyond the ends the signal keeps its end values."""
    n = len(x) * UP // DOWN
    padded = np.concatenate((np.full(TAPS, x[0]), x, np.full(TAPS + DOWN, x[-1])))
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * TAPS)
    out, taps = np.empty(n), phases()
    for k in range(UP):
        phase, first = out[k::UP], k * DOWN // UP + 1
        for at in range(0, len(phase), BLOCK):
            stop = min(len(phase), at + BLOCK)
            phase[at:stop] = windows[first + DOWN * at : first + DOWN * stop : DOWN][: stop - at] @ taps[k]
    return out


@cache
def mel_bank() -> np.ndarray:
    """Triangular filters (FFT bins x MELS) evenly spaced on the mel scale up to half the new rate."""
    rate = RATE * UP / DOWN
    edges = 700 * (10 ** (np.linspace(0, 2595 * np.log10(1 + rate / 2 / 700), MELS + 2) / 2595) - 1)
    f = np.linspace(0, rate / 2, FFT // 2 + 1)[:, None]
    lo, mid, hi = edges[:-2], edges[1:-1], edges[2:]
    return np.clip(np.minimum((f - lo) / (mid - lo), (hi - f) / (hi - mid)), 0, None)


def log_mel(signal: np.ndarray) -> np.ndarray:
    """Log10 mel energies, frames x MELS; at least one frame, the last ones filled up with zeros."""
    n = max(1, -(-(len(signal) - FRAME + HOP) // HOP))
    signal = np.concatenate((signal, np.zeros(max(0, (n - 1) * HOP + FRAME - len(signal)))))
    frames = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP][:n]
    hann, bank, out = np.hanning(FRAME + 2)[1:-1], mel_bank(), np.empty((n, MELS), np.float32)
    for at in range(0, n, BLOCK):
        spectrum = np.fft.rfft(frames[at : at + BLOCK] * hann, FFT)
        out[at : at + BLOCK] = np.log10((spectrum.real**2 + spectrum.imag**2) @ bank + FLOOR)
    return out


def segments(mel: np.ndarray) -> list[tuple[int, int]]:
    """[first, end) frames of each active stretch: opened above the upper level, closed below the lower one."""
    level = 10 * mel.mean(axis=1)
    mean = float(level.mean())
    # +1 opens, -1 closes, 0 keeps the state; the state is the last non-zero mark.
    marks = np.where(level > mean + OPEN_DB, 1, np.where(level < mean + CLOSE_DB, -1, 0))
    last = np.maximum.accumulate(np.where(marks != 0, np.arange(len(marks)), -1))
    on = np.where(last >= 0, marks[last], -1) > 0
    turns = np.flatnonzero(np.diff(np.concatenate(([False], on, [False])).astype(np.int8)))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def tensor_stream(mel: np.ndarray, seconds: float) -> bytes:
    """An Arrow IPC stream: start_s, end_s, fixed-shape tensor (PATCH x MELS) of 32-bit floats."""
    n = -(-len(mel) // PATCH)
    full = np.full((n * PATCH, MELS), np.log10(FLOOR), np.float32)
    full[: len(mel)] = mel
    step = PATCH * HOP / (RATE * UP / DOWN)
    kind = pa.fixed_shape_tensor(pa.float32(), (PATCH, MELS))
    tensors = pa.ExtensionArray.from_storage(kind, pa.FixedSizeListArray.from_arrays(pa.array(full.ravel()), PATCH * MELS))
    starts = np.arange(n) * step
    batch = pa.RecordBatch.from_arrays([pa.array(starts), pa.array(np.minimum(starts + step, max(seconds, step))), tensors], ["start_s", "end_s", "log_mel"])
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue()


def read_tensors(stream: bytes) -> pa.Table:
    """The table of a stored stream; ``log_mel`` is a fixed-shape tensor column."""
    with pa.ipc.open_stream(stream) as r:
        return r.read_all()


def features(stored: bytes) -> tuple[bytes, list[tuple[float, float]], str]:
    """Of a stored clip: its tensor stream, its active spans in seconds, and a short summary text."""
    payload = from_wav(stored)
    signal = resample((np.frombuffer(payload, np.uint8).astype(np.float64) - 128) / 128)
    mel = log_mel(signal)
    spans = [(round(a * HOP * DOWN / UP / RATE, 4), round(b * HOP * DOWN / UP / RATE, 4)) for a, b in segments(mel)]
    stream = tensor_stream(mel, len(payload) / RATE)
    summary = {"seconds": round(len(payload) / RATE, 4), "frames": len(mel), "segments": len(spans), "mel": [round(float(v), 2) + 0.0 for v in mel.mean(axis=0, dtype=np.float64)]}
    return stream, spans, json.dumps(summary, separators=(",", ":"))


def audio_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, from the whole text taken as 8-bit samples (null: empty).

    Columns: ``id_col``, ``n_bytes``, ``payload_bytes``, ``payload_sha256`` and ``tail_crc32`` of the payload
    read back, ``media_bytes`` and ``media_sha256`` of the stored WAV, ``feature`` (a summary), ``media``
    (the WAV), ``tensors`` (see :func:`read_tensors`) and ``spans`` (active seconds). An empty text is one
    unit of spaces. Null ids and repeated rows are carried; equal texts give equal values. Columns beside
    the two are not touched. A WAV holds under 4 GB, more than a row can.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = T.StructType([T.StructField("start_s", T.DoubleType()), T.StructField("end_s", T.DoubleType())])
    kinds = {"n_bytes": T.LongType(), "payload_bytes": T.LongType(), "payload_sha256": T.StringType(), "tail_crc32": T.LongType(), "media_bytes": T.LongType(), "media_sha256": T.StringType(), "feature": T.StringType(), "media": T.BinaryType(), "tensors": T.BinaryType(), "spans": T.ArrayType(span)}
    schema = T.StructType([narrow.schema["id"], *(T.StructField(k, t) for k, t in kinds.items())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in byte_slices(batches, 1, BATCH_BYTES):
            rows = []
            for text in b.column(1).to_pylist():
                payload, n = payload_of(text)
                stored = to_wav(payload)
                back = from_wav(stored)
                stream, spans, summary = features(stored)
                rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), summary, stored, stream, [{"start_s": s, "end_s": e} for s, e in spans]))
            yield as_batch(arrow, b.column(0), *map(list, zip(*rows, strict=True)))

    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
