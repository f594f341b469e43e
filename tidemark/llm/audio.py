"""Media columns: audio features of 8-bit sound, kept as fixed-shape Arrow tensors with time spans.

A payload of 8-bit samples is stored as an Arrow stream: one row for each chunk of CHUNK samples, the samples as
a fixed-shape tensor, and the chunk's start and end in seconds. Features are computed from what is read back:
polyphase resampling by UP/DOWN, overlapped log-mel filterbanks, and segments of sound by energy with two
thresholds (hysteresis). The log-mel frames are stored the same way, BLOCK frames to a tensor.

Defined cases: a null or empty text is one chunk of zeros (its payload is padded to a positive multiple of CHUNK);
silence and constant sound have no segment; repeated rows and equal texts get equal values; a sound is processed whole,
whatever its length; an empty table gives no rows; only the key and text columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read

CHUNK = 64
RATE = 8000
UP, DOWN, TAPS = 4, 5, 12  # 8000 Hz to 6400 Hz; TAPS filter taps for each phase
FRAME, HOP, BANDS, BLOCK = 256, 128, 16, 8
RATE_OUT = RATE * UP // DOWN
ON, OFF = 0.75, 0.25  # thresholds: standard deviations of the log energy above its mean


def payload(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw + bytes(max(CHUNK, -(-len(raw) // CHUNK) * CHUNK) - len(raw))


def _tensors(values: np.ndarray, start: np.ndarray, end: np.ndarray, meta: dict[str, str]) -> bytes:
    """An Arrow stream of one batch: fixed-shape tensors, start and end in seconds."""
    flat = values.reshape(len(values), -1)
    storage = pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), flat.shape[1])
    kind = pa.fixed_shape_tensor(storage.type.value_type, values.shape[1:])
    batch = pa.record_batch([pa.ExtensionArray.from_storage(kind, storage), pa.array(start), pa.array(end)], schema=pa.schema([("tensor", kind), ("start", pa.float64()), ("end", pa.float64())], metadata=meta))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def store(samples: bytes, rate: int = RATE) -> bytes:
    """The sound as an Arrow stream; nothing of it is lost."""
    n = len(samples) // CHUNK
    at = np.arange(n) * (CHUNK / rate)
    return _tensors(np.frombuffer(samples, np.uint8).reshape(n, CHUNK), at, at + CHUNK / rate, {"rate": str(rate)})


def load(media: bytes) -> tuple[np.ndarray, int]:
    """The samples and their rate."""
    with pa.ipc.open_stream(media) as r:
        table = r.read_all()
    column = table.column("tensor").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.storage.flatten().to_numpy(), int(table.schema.metadata[b"rate"])


@lru_cache
def phases(up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """A Hann-windowed sinc low-pass filter, dealt into its polyphase branches (reversed for correlation)."""
    n = up * taps
    t = np.arange(n) - (n - 1) / 2
    cut = 1 / max(up, down)
    h = np.sinc(t * cut) * np.hanning(n + 2)[1:-1]
    h *= up / h.sum()
    return np.ascontiguousarray(h.reshape(taps, up).T[:, ::-1])


def resample(x: np.ndarray, up: int = UP, down: int = DOWN) -> np.ndarray:
    """``len(x) * up / down`` samples (rounded up); output n takes branch n*down mod up at input n*down div up."""
    h = phases(up, down)
    taps = h.shape[1]
    n_out = -(-len(x) * up // down)
    padded = np.concatenate((np.zeros(taps - 1 - taps // 2), x, np.zeros(taps // 2 + down)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, taps)
    out = np.empty(n_out)
    for first in range(up):  # outputs first, first + up, ... share a branch and step `down` inputs
        n = len(out[first::up])
        if n:
            begin = first * down // up
            out[first::up] = windows[begin : begin + (n - 1) * down + 1 : down] @ h[first * down % up]
    return out


@lru_cache
def mel_bank() -> np.ndarray:
    """Triangles, evenly spaced on the mel scale, over the bins of a frame's spectrum."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edge = 700 * (10 ** (np.linspace(0, mel(RATE_OUT / 2), BANDS + 2) / 2595) - 1)
    f = np.arange(FRAME // 2 + 1) * RATE_OUT / FRAME
    rise = (f[:, None] - edge[:-2]) / (edge[1:-1] - edge[:-2])
    fall = (edge[2:] - f[:, None]) / (edge[2:] - edge[1:-1])
    return np.maximum(0, np.minimum(rise, fall))


@lru_cache
def _hann() -> np.ndarray:
    return np.hanning(FRAME + 1)[:-1]


FRAMES_AT_ONCE = 4096


def log_mel(y: np.ndarray) -> np.ndarray:
    """(frames, BANDS): a frame every HOP samples, the last ones padded with silence."""
    n = max(1, -(-max(len(y) - FRAME, 0) // HOP) + 1)
    y = np.concatenate((y, np.zeros((n - 1) * HOP + FRAME - len(y))))
    frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    out = np.empty((n, BANDS))
    for i in range(0, n, FRAMES_AT_ONCE):
        spectrum = np.fft.rfft(frames[i : i + FRAMES_AT_ONCE] * _hann(), axis=1)
        out[i : i + FRAMES_AT_ONCE] = (spectrum.real**2 + spectrum.imag**2) @ mel_bank()
    return np.log(out + 1e-6)


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Runs of frames that start at the upper threshold and last down to the lower one."""
    spread = energy.std()
    if spread < 1e-9:
        return []
    on, off = energy >= energy.mean() + ON * spread, energy < energy.mean() + OFF * spread
    # Between the thresholds the last decision holds.
    at = np.where(on | off, np.arange(len(energy)), -1)
    last = np.maximum.accumulate(at)
    active = (last >= 0) & on[last]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], active.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def features(media: bytes) -> tuple[bytes, list[tuple[float, float]]]:
    """Log-mel blocks as an Arrow stream of (BLOCK, BANDS) tensors with time spans, and the sound segments in seconds."""
    samples, _ = load(media)
    mel = log_mel(resample((samples.astype(np.float64) - 128) / 128)).astype(np.float32)
    spans = [(a * HOP / RATE_OUT, ((b - 1) * HOP + FRAME) / RATE_OUT) for a, b in segments(np.log(np.exp(mel.astype(np.float64)).sum(axis=1)))]
    blocks = -(-len(mel) // BLOCK)
    full = np.concatenate((mel, np.full((blocks * BLOCK - len(mel), BANDS), np.log(1e-6), np.float32))).reshape(blocks, BLOCK, BANDS)
    start = np.arange(blocks) * (BLOCK * HOP / RATE_OUT)
    end = np.minimum(start + ((BLOCK - 1) * HOP + FRAME) / RATE_OUT, ((len(mel) - 1) * HOP + FRAME) / RATE_OUT)
    return _tensors(full, start, end, {"frames": str(len(mel))}), spans


def audio(docs: DataFrame, key: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """``key``, n_bytes, media (the stored sound), mel (its log-mel tensors), spans; one row for each row of ``docs``.

    ``digests=True`` returns the contract's digests of these, computed from the bytes read back.
    """

    def run(batches):
        for batch in batches:
            rows = [[] for _ in names[1:]]
            for t in batch.column(1).to_pylist():
                n = len((t or "").encode())
                media = store(payload(t))
                mel, spans = features(media)
                if digests:
                    back = load(media)[0].tobytes()
                    feature = f"{len(spans)}:{round(1000 * sum(b - a for a, b in spans))}:{hashlib.sha256(mel).hexdigest()[:32]}"
                    own = [n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-CHUNK:]), len(media), hashlib.sha256(media).hexdigest(), feature]
                else:
                    own = [n, media, mel, [{"start": a, "end": b} for a, b in spans]]
                for column, value in zip(rows, own, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]], names)

    span = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))
    if digests:
        names, kinds = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        shape = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    else:
        names, kinds, shape = ["n_bytes", "media", "mel", "spans"], [pa.int64(), pa.binary(), pa.binary(), span], "n_bytes long, media binary, mel binary, spans array<struct<start: double, end: double>>"
    names = [key, *names]
    base = docs.select(key, text)
    return base.mapInArrow(run, f"`{key}` {base.schema[key].dataType.simpleString()}, {shape}")


def op3_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio(read(spark, sf_dir, "documents"), digests=True)
