"""Language-model scoring: online logistic context mixing over bytes, next to an add-one unigram base.

The model predicts a text bit by bit. A byte's bits are those of its Huffman code among the bytes that follow the byte
before it, so a likely byte takes few bits, and what a single byte of context tells is in the code. Each bit gets predictions
from several longer contexts:

- the corpus: for each order of ORDERS (bytes before the byte), how often the training documents went either way;
- the text itself, read so far: for each order of ONLINE, the byte that followed the last time, as strong as the
  number of times that it has followed in a row. These predictors learn with every byte.

A gate, chosen by which predictors know something, selects the weights that mix the predictions in the logistic domain. The
weights follow the text's own errors, one step for every STEP bits wherever in the text. A second stage refines the mixed
prediction: a table by gate and confidence, learned in the same steps, that corrects over- and underconfidence. A final
byte that UTF-8 never uses ends a text, so the score is a proper log-probability of the text.

Texts are cut into blocks where they lie and are moved once, compressed. Counts are exact: each block sends its words and
what followed its contexts to buckets, whose number grows with the corpus, and a bucket answers each block for the words and
contexts that it has. On the driver there are only 256 x 256 counts of bytes, from which the codes are made.

Defined cases: a null text is an empty one (a single end token); a null id is never held out; without training documents
every count is zero and only the text itself teaches; an empty table gives no rows; repeated rows train once each and get
equal scores; texts are scored whole, whatever their length (those over PASSAGE bytes in passages, whose weights carry on;
the text's own predictors look back to the passage's beginning); only the key and text columns are read, so others may have any name.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, materialize, read

#: Bytes of context whose followers are counted over the corpus, and those looked up in the text itself.
ORDERS = (2, 3, 4)
ONLINE = (4,)
TOP, LEAD = max(ORDERS), max(ORDERS + ONLINE)
INPUTS = len(ORDERS) + len(ONLINE)
PRIOR = (0.3, 0.2, 0.15)  # of the counts, by order
STEP = 256  # bits between two updates of the weights
GATES, BINS = 4, 12
RATE, FINE_RATE = 0.006, 0.005
#: Weights that a text begins with, by gate: whether the longest order knows the context, and whether the text does.
FIRST_WEIGHTS = ((0.45, 0.65, 0.0, 0.0), (0.15, 0.35, 0.6, 0.0), (0.4, 0.6, 0.0, 0.4), (0.1, 0.3, 0.55, 0.4))
GRAIN = 0.06  # of the predictions, which are kept as 8-bit numbers
STRONGEST = 8  # times in a row that a predictor of the text tells apart
END = 0xFF
DEEPEST = 48  # bits of a code
FOLDS, HELD = 7, 2
BLOCK_BYTES = 8 << 20  # texts that ask for counts together
BATCH_BYTES = 3 << 20  # texts that are counted and mixed together, which bounds a worker's memory
SLICE_BITS = 1 << 21  # laid out at a time
PASSAGE = 3 << 20
PLACE_BITS = 22  # of a place among the texts mixed together


def lay_out(texts: list[bytes], before: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts in a row, each behind LEAD bytes of what came before (zeros); the places of their bytes, and their lengths."""
    length = np.array([len(t) for t in texts], np.int64)
    before = before or [bytes(LEAD)] * len(texts)
    raw = b"".join(x for b, t in zip(before, texts, strict=True) for x in (b, t)) + bytes(8)  # room for the last reading
    return np.frombuffer(raw, np.uint8), ranges(np.cumsum(length + LEAD) - length, length), length


def endings(raw: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes that end at each place as one number, the last byte in the highest place."""
    every = np.ndarray((len(raw) - 7,), "<i8", raw.data, strides=(1,))
    return every[at - (size - 1)] & ((1 << 8 * size) - 1)


def ranges(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after another."""
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())


def starts_of(x: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(x)), bool), x[1:] != x[:-1])))


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = starts_of(keys)
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def pair_counts(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, and one byte, the context (order's number, then its bytes) and the byte that follows, as one number; how often."""
    raw, at, _ = lay_out([t + bytes([END]) for t in texts])
    # A byte lies above its context, whose nearest byte lies highest: in this order pairs of all lower orders lie together.
    keys = np.sort(endings(raw, at, TOP + 1))
    first = starts_of(keys)
    keys, n = keys[first], np.diff(np.append(first, len(keys)))
    out = []
    for order in (1, *ORDERS):
        pairs = keys >> 8 * (TOP - order)
        first = starts_of(pairs)
        own = pairs[first]
        byte, ctx = own >> 8 * order, own & ((1 << 8 * order) - 1)
        out.append((order << 56 | ctx << 8 | byte, np.add.reduceat(n, first) if len(first) else n))
    return out


class Code:
    """A Huffman code of the bytes after each byte: lengths and words (in the highest of DEEPEST bits), 256 by 256."""

    def __init__(self, counts: np.ndarray):
        self.length, self.word = np.zeros((256, 256), np.int64), np.zeros((256, 256), np.int64)
        every = counts.sum(axis=0).astype(np.int64)
        common = self._tree(every + 1)
        for before in range(256):
            if counts[before].any():
                self.length[before], self.word[before] = self._tree(counts[before].astype(np.int64) * 1024 + every * 64 // max(1, int(every.sum())) + 1)
            else:
                self.length[before], self.word[before] = common

    @staticmethod
    def _tree(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        while True:
            heap = [(int(w), b) for b, w in enumerate(weight)]
            heapq.heapify(heap)
            parent, side, new = [0] * 511, [0] * 511, 256
            while len(heap) > 1:
                (n, a), (m, b) = heapq.heappop(heap), heapq.heappop(heap)
                parent[a] = parent[b] = new
                side[b] = 1
                heapq.heappush(heap, (n + m, new))
                new += 1
            depth, word = [0] * 511, [0] * 511
            for k in range(509, -1, -1):
                depth[k] = depth[parent[k]] + 1
                if depth[k] <= DEEPEST:
                    word[k] = word[parent[k]] | side[k] << (DEEPEST - depth[k])
            if max(depth[:256]) <= DEEPEST:
                return np.array(depth[:256]), np.array(word[:256])
            weight = weight // 2 + 1

    def shared(self, before: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bits the codes of two bytes have in common; the whole length if the bytes are equal."""
        differ = self.word[before, a] ^ self.word[before, b]
        return np.where(differ == 0, self.length[before, a], DEEPEST - np.frexp(differ.astype(np.float64))[1])


def grains(ours: np.ndarray, others: np.ndarray, prior: float) -> np.ndarray:
    """The prediction for the way taken, from how often it and the other one were taken; 0 where nothing is known."""
    return np.clip(np.rint(np.log((ours + prior) / (others + prior)) / GRAIN), -127, 127).astype(np.int8)


@dataclass
class Counts:
    """What followed the contexts of the corpus: pairs as of ``pair_counts``, in order."""

    keys: np.ndarray
    n: np.ndarray

    def paths(self, code: Code, pairs: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
        """Predictions along the code of each pair's byte in its context, one pair after another; where each pair's begin."""
        ctx, byte = pairs >> 8, pairs & 255
        order = int(pairs[0] >> 56) if len(pairs) else 1
        before = (ctx >> 8 * (order - 1)) & 255
        steps = code.length[before, byte]
        first = np.searchsorted(self.keys, ctx << 8)
        known = np.searchsorted(self.keys, (ctx + 1) << 8) - first
        # Every byte that followed the context goes along with ours for the bits that they share.
        at, own = ranges(first, known), np.repeat(np.arange(len(pairs)), known)
        shared = code.shared(before[own], byte[own], self.keys[at] & 255)
        room = np.cumsum(steps + 1) - (steps + 1)
        total = int((steps + 1).sum())
        reach = np.bincount(room[own] + shared, self.n[at], total)
        # Summed from the end of the path: how many went along at least so many bits.
        tail = np.append(np.cumsum(reach[::-1])[::-1], 0.0)
        reach = tail[:-1] - np.repeat(tail[np.append(room[1:], total)], steps + 1)
        here = ranges(room, steps)
        return grains(reach[here + 1], reach[here] - reach[here + 1], prior), np.cumsum(steps) - steps


#: How sure a predictor of the text is, by the number of times in a row.
SHARPNESS = np.rint(np.log1p(2.0 * np.arange(STRONGEST + 1)) / GRAIN).astype(np.int8)


def told_by_text(raw: np.ndarray, text: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the byte that followed the same context last time in the same text, and how often in a row (0: never)."""
    keys = endings(raw, at - 1, order)
    keys <<= PLACE_BITS
    keys |= np.arange(len(at))
    keys.sort()
    place = keys & ((1 << PLACE_BITS) - 1)
    keys >>= PLACE_BITS
    own, byte = text[place], raw[at][place]
    again = np.zeros(len(at), bool)
    again[1:] = (keys[1:] == keys[:-1]) & (own[1:] == own[:-1])
    same = again.copy()
    same[1:] &= byte[1:] == byte[:-1]
    number = np.arange(len(at), dtype=np.int32)
    run = np.minimum(number - np.maximum.accumulate(np.where(same, np.int32(0), number)) + 1, STRONGEST).astype(np.uint8)
    follows, times = np.zeros(len(at), np.uint8), np.zeros(len(at), np.uint8)
    where = np.flatnonzero(again)
    follows[place[where]], times[place[where]] = byte[where - 1], run[where - 1]
    return follows, times


@dataclass
class Mixer:
    code: Code
    counts: Counts

    @classmethod
    def trained(cls, texts: list[bytes]) -> Mixer:
        keys, n = merged(pair_counts(texts))
        return cls(Code(byte_table(keys, n)), Counts(keys, n))

    def log10(self, texts: list[bytes]) -> np.ndarray:
        """Log10 probability of each text, taken in batches; it does not depend on the batch."""
        own = {t: i for i, t in enumerate(dict.fromkeys(texts))}
        found, batch, size = np.zeros(len(own)), [], 0
        for t in [*own, None]:
            if batch and (t is None or size + len(t) > BATCH_BYTES):
                found[[own[x] for x in batch]] = self.passages([x + bytes([END]) for x in batch])[0]
                batch, size = [], 0
            if t is not None and len(t) >= PASSAGE:
                found[own[t]] = self.long(t + bytes([END]))
            elif t is not None:
                batch.append(t)
                size += len(t) + 1
        return found[[own[t] for t in texts]]

    def long(self, text: bytes) -> float:
        before, state, total = bytes(LEAD), None, 0.0
        for at in range(0, len(text), PASSAGE):
            part, state = self.passages([text[at : at + PASSAGE]], [before], state)
            before = text[at + PASSAGE - LEAD : at + PASSAGE]
            total += float(part[0])
        return total

    def inputs(self, texts: list[bytes], before: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of STEP bits with INPUTS predictions of the way taken for each bit, four bytes together; the bits of each text.

        A text begins with a row; what is left of its last row predicts nothing.
        """
        raw, at, length = lay_out(texts, before)
        text = np.repeat(np.arange(len(texts), dtype=np.int32), length)
        keys = endings(raw, at, TOP + 1)
        keys <<= PLACE_BITS
        keys |= np.arange(len(at))
        keys.sort()
        place = keys & ((1 << PLACE_BITS) - 1)
        keys >>= PLACE_BITS
        first = starts_of(keys)
        pair = np.empty(len(at), np.int32)
        pair[place] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(at))))
        keys = keys[first]  # distinct pairs of the longest order; a row of predictions for each bit of their codes
        del place
        steps = self.code.length[keys >> 8 * (TOP - 1) & 255, keys >> 8 * TOP]
        starts = np.cumsum(steps) - steps
        told = np.zeros((int(steps.sum()), INPUTS), np.int8)
        for k, order in enumerate(ORDERS):
            short = keys >> 8 * (TOP - order)
            head = starts_of(short)
            own = short[head]
            values, where = self.counts.paths(self.code, order << 56 | (own & ((1 << 8 * order) - 1)) << 8 | own >> 8 * order, PRIOR[k])
            which = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(short))))
            told[:, k] = values[ranges(where[which], steps)]
        told = told.view(np.int32).ravel()
        by_text = []
        for order in ONLINE:
            follows, times = told_by_text(raw, text, at, order)
            shared = np.where(times > 0, steps[pair], 0)  # bits of its code that are ours
            off = np.flatnonzero((times > 0) & (follows != raw[at]))
            shared[off] = self.code.shared(raw[at[off] - 1], raw[at[off]], follows[off])
            by_text.append((shared, SHARPNESS[times]))
        size = steps[pair]
        bits = np.bincount(text, size, len(texts)).astype(np.int64)
        rows = -(-bits // STEP)
        laid = np.zeros(int(rows.sum()) * STEP, np.int32)
        row0, byte0 = (np.cumsum(rows) - rows) * STEP, np.cumsum(length) - length
        done = 0
        while done < len(texts):  # as many texts at a time as have SLICE_BITS, one at least
            end = max(done + 1, int(np.searchsorted(np.cumsum(bits[done:]), SLICE_BITS, side="right")) + done)
            part = slice(int(byte0[done]), int(byte0[end - 1] + length[end - 1]))
            n = size[part]
            out = told[ranges(starts[pair[part]], n)]
            for k, (shared, sharp) in enumerate(by_text, len(ORDERS)):
                # Right for the bits that the codes share, wrong at the next one, then silent.
                right, sure = shared[part], sharp[part]
                wrong = (sure != 0) & (right < n)
                out.view(np.int8).reshape(-1, INPUTS)[:, k] = np.repeat(np.column_stack([sure, -sure, np.zeros_like(sure)]).ravel(), np.column_stack([right, wrong, n - right - wrong]).ravel())
            here = 0
            for at0, n in zip(row0[done:end].tolist(), bits[done:end].tolist(), strict=True):
                laid[at0 : at0 + n] = out[here : here + n]
                here += n
            done = end
        return laid.reshape(-1, STEP), bits

    def passages(self, texts: list[bytes], before: list[bytes] | None = None, state=None) -> tuple[np.ndarray, tuple]:
        """Log10 probability of each, and the weights and refinements reached; ``state`` to begin with those of one text."""
        laid, bits = self.inputs(texts, before)
        order = np.argsort(-bits, kind="stable")
        rows = -(-bits // STEP)
        row0, rows = (np.cumsum(rows) - rows)[order], rows[order]
        weight = np.zeros((len(texts), INPUTS, GATES), np.float32)
        weight[:] = np.array(FIRST_WEIGHTS, np.float32).T if state is None else state[0]
        fine = np.zeros(len(texts) * GATES * BINS, np.float32) if state is None else state[1].copy()
        lost = np.zeros(len(texts))
        place = np.arange(len(texts) * STEP).reshape(-1, STEP) * GATES
        own = (np.arange(len(texts)) * (GATES * BINS))[:, None]
        for step in range(int(rows[0]) if len(rows) else 0):
            n = int(np.searchsorted(-rows, -step, side="left"))  # texts that reach this far
            x = laid[row0[:n] + step].view(np.int8).reshape(n, STEP, INPUTS)
            gate = (x[:, :, INPUTS - 2] != 0) + 2 * (x[:, :, INPUTS - 1] != 0)
            x = x.astype(np.float32)
            x *= np.float32(GRAIN)
            w = weight[:n]
            chosen = place[:n] + gate
            mixed = np.matmul(x, w).ravel()[chosen]
            way = np.sign(mixed)
            cell = np.minimum((np.abs(mixed) * 2).astype(np.int64), BINS - 1)
            cell += gate * BINS
            cell += own[:n]
            logit = mixed + way * fine[cell]
            np.clip(logit, -20, 20, out=logit)
            wrong = np.exp(-logit)
            wrong += 1
            lost[:n] += np.log(wrong).sum(axis=1, dtype=np.float64)
            error = 1 - 1 / wrong  # how far the prediction of the way taken is from certain
            by_gate = np.zeros((n, STEP, GATES), np.float32)
            by_gate.ravel()[chosen] = error
            w += np.float32(RATE) * np.matmul(x.transpose(0, 2, 1), by_gate)
            used = n * GATES * BINS
            fine[:used] += (FINE_RATE * np.bincount(cell.ravel(), (error * way).ravel(), used)).astype(np.float32)
        total = np.zeros(len(texts))
        # The silent bits of last rows have cost one bit each.
        total[order] = -(lost - (rows * STEP - bits[order]) * math.log(2)) / math.log(10)
        return total, (weight[0], fine)


def byte_table(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How often each byte followed each byte."""
    own = keys >> 56 == 1
    return np.bincount(keys[own] & 65535, n[own], 65536).reshape(256, 256)


def packed(keys: np.ndarray, n: np.ndarray) -> bytes:
    """All first bytes of the numbers, then all second ones and so on, which compresses well; keys as differences."""
    both = np.column_stack([np.diff(keys, prepend=0), n.astype(np.int64)]).view(np.uint8)
    return zstandard.compress(both.T.tobytes(), 1)


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(16, -1).T).view(np.int64)
    return np.cumsum(both[:, 0]), both[:, 1]


def packed_words(words: list[bytes], n: list[int]) -> bytes:
    return zstandard.compress(np.array([len(words), *n], np.int64).tobytes() + b" ".join(words), 1)


def unpacked_words(raw: bytes) -> tuple[list[bytes], list[int]]:
    raw = zstandard.decompress(raw)
    k = int(np.frombuffer(raw[:8], np.int64)[0])
    return raw[8 * (k + 1) :].split(b" ") if k else [], np.frombuffer(raw[8 : 8 * (k + 1)], np.int64).tolist()


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    none = np.zeros(0, np.int64)
    return summed(np.concatenate([none, *(k for k, _ in parts)]), np.concatenate([none, *(n for _, n in parts)]))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((keys >> 8).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


#: What a block sends: its texts (kind 0), its words (1) and contexts (2) to a bucket, and its counts of bytes (3).
_SENT = "block long, kind int, bucket int, data binary"
TEXTS, WORDS, PAIRS, BYTES = range(4)


def _rows(block: int, kind: int, data: list[tuple[int, bytes]]) -> pa.RecordBatch:
    n = len(data)
    return pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array([b for b, _ in data], pa.int32()), pa.array([x for _, x in data], pa.binary())], ["block", "kind", "bucket", "data"])


def _send(block: int, rows: list[tuple], schema: pa.Schema, buckets: int):
    """All that a block sends for its rows (key, held, text)."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.table([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(3)], schema=schema))
    yield _rows(block, TEXTS, [(-1, sink.getvalue().to_pybytes())])
    counter: Counter[bytes] = Counter()
    for _, held, text in rows:
        if held:
            for w in _words(text):
                counter[w] += 0
        else:
            counter.update(_words(text))
    dealt: dict[int, list[bytes]] = {}
    for w in counter:
        dealt.setdefault(zlib.crc32(w) % buckets, []).append(w)
    yield _rows(block, WORDS, [(b, packed_words(own, [counter[w] for w in own])) for b, own in dealt.items()])
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for held in (False, True):  # contexts of held-out texts are only asked for
        texts = [(t or "").encode() for _, h, t in rows if bool(h) == held]
        at, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size > BATCH_BYTES or i == len(texts) - 1:
                parts += [(keys, n * (not held)) for keys, n in pair_counts(texts[at : i + 1])]
                at, size = i + 1, 0
    keys, n = merged(parts)
    one = keys >> 56 == 1
    yield _rows(block, BYTES, [(-1, packed(keys[one & (n > 0)], n[one & (n > 0)]))])
    keys, n = keys[~one], n[~one]
    own = bucket_of(keys, buckets)
    order = np.argsort(own, kind="stable")
    keys, n, own = keys[order], n[order], own[order]
    cut = np.searchsorted(own, np.arange(buckets + 1))
    yield _rows(block, PAIRS, [(int(b), packed(keys[cut[b] : cut[b + 1]], n[cut[b] : cut[b + 1]])) for b in np.flatnonzero(np.diff(cut))])


def _gather(schema: pa.Schema, buckets: int):
    """Cut a task's texts into blocks; what each sends."""

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        rows, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    rows.append(row)
                    size += len(row[2] or "")
                    if size >= BLOCK_BYTES:
                        yield from _send(block, rows, schema, buckets)
                        rows, size, block = [], 0, block + 1
        if rows:
            yield from _send(block, rows, schema, buckets)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """A bucket's counts of all blocks, for each block those of the words and contexts that it has; the sums of the words."""
    block, kind, data = (table.column(c).to_pylist() for c in ("block", "kind", "data"))
    counter: Counter[bytes] = Counter()
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    out = []
    for k, raw in zip(kind, data, strict=True):
        if k == WORDS:
            for w, n in zip(*unpacked_words(raw), strict=True):
                counter[w] += n
        else:
            parts.append(unpacked(raw))
    keys, n = merged(parts)
    keys, n = keys[n > 0], n[n > 0]
    heads = starts_of(keys >> 8)
    known, lengths = keys[heads] >> 8, np.diff(np.append(heads, len(keys)))
    asked = iter(parts)
    for b, k, raw in zip(block, kind, data, strict=True):
        if k == WORDS:
            own = [w for w in unpacked_words(raw)[0] if counter[w]]
            out.append((b, k, packed_words(own, [counter[w] for w in own]), 0, 0))
        else:
            own = next(asked)[0] >> 8
            own = own[starts_of(own)]
            at = np.searchsorted(known, own)
            own = at[np.append(known, -1)[at] == own]
            at = ranges(heads[own], lengths[own])
            out.append((b, k, packed(keys[at], n[at]), 0, 0))
    seen = [c for c in counter.values() if c]
    out.append((None, WORDS, None, sum(seen), len(seen)))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["block", "kind", "data", "tokens", "types"])


def _score(block: pa.Table, code: Code, n: int, v: int, ends: int, names: list[str]) -> pa.Table:
    """The rows of a block, from its texts and all answers that it got."""
    counts, parts, texts = {}, [], None
    for kind, raw in zip(block.column("kind").to_pylist(), block.column("data").to_pylist(), strict=True):
        if kind == TEXTS:
            texts = pa.ipc.open_stream(raw).read_all()
        elif kind == WORDS:
            counts.update(zip(*unpacked_words(raw), strict=True))
        else:
            parts.append(unpacked(raw))
    mixer = Mixer(code, Counts(*merged(parts)))
    log_all = math.log10(n + v + 1)
    unseen = -log_all
    logs = {w: math.log10(c + 1) - log_all for w, c in counts.items()}
    tokens, hits, sums, raw = [], [], [], []
    for t in texts.column(2).to_pylist():
        own = [logs.get(w, unseen) for w in _words(t)]
        tokens.append(len(own) + 1)
        hits.append(sum(1 for x in own if x > unseen) + (ends > 0))
        sums.append(math.fsum(own) + math.log10(ends + 1) - log_all)
        raw.append((t or "").encode())
    scores = mixer.log10(raw)
    bits = -scores * math.log2(10) / np.array([len(t) + 1 for t in raw])
    m = len(raw)
    return pa.table([texts.column(0), texts.column(1), pa.array(tokens, pa.int64()), pa.array(hits, pa.int64()), pa.array([n] * m, pa.int64()), pa.array(sums, pa.float64()), pa.array(scores), pa.array(bits)], names=names)


def _sum_bytes(batches):
    total = np.zeros(65536, np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            keys, n = unpacked(raw)
            total[keys & 65535] += n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "n"])


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte; one row for each row of ``docs``."""
    base = docs.select(F.col(f"`{key}`").alias("_key"), held_out(key).alias("_held"), F.col(f"`{text}`").alias("_text"))
    size = base.agg(F.sum(F.octet_length("_text")).alias("bytes"), F.sum((~F.col("_held")).cast("long")).alias("training")).first()
    buckets = max(6, -(-(size["bytes"] or 0) // (2 * BLOCK_BYTES)))
    schema = base.limit(0).toArrow().schema
    gathered = materialize(base.mapInArrow(_gather(schema, buckets), _SENT), "gathered")
    table = np.zeros(65536)
    for part in gathered.where(F.col("kind") == BYTES).select("data").mapInArrow(_sum_bytes, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toLocalIterator():
        table[part["pair"]] = part["n"]  # 65,536 rows at most
    table = table.reshape(256, 256)
    answers = gathered.where(F.col("kind").isin(WORDS, PAIRS)).groupBy("bucket").applyInArrow(_answer, "block long, kind int, data binary, tokens long, types long")
    answers = materialize(answers, "answers")
    ends = size["training"] or 0  # every training document ends once
    whole = answers.where("block is null").agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    n, v = (whole["n"] or 0) + ends, (whole["v"] or 0) + (ends > 0)
    code = docs.sparkSession.sparkContext.broadcast(Code(table))  # of a fixed size
    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    both = gathered.where(F.col("kind") == TEXTS).select("block", "kind", "data").unionByName(answers.where("block is not null").select("block", "kind", "data"))
    kind = base.schema["_key"].dataType.simpleString()
    shape = f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return both.groupBy("block").applyInArrow(lambda rows: _score(rows, code.value, n, v, ends, names), shape)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents").select("doc_id", "text"))
