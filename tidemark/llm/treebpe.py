"""Byte-level BPE by a segment tree over byte positions.

Every position of a pre-token holds the rank of the pair that begins there; a segment tree over the positions gives the leftmost pair of
the lowest rank at its root. A merge takes the right symbol out and renews three leaves: the merged position, the one taken out and the live
neighbour on the left. Each costs one way up the tree, so a pre-token of n bytes takes n log n steps, however long it is.

Pre-tokens of up to ``SHORT`` bytes are laid out side by side, one tree a row, and all trees of one width make their next merge together; a
longer one has a tree to itself. Equal pre-tokens of a batch are encoded once.

Defined cases: a null text is treated as empty and has no ids; there are no special tokens, so their strings are ordinary text; a pre-token
that is itself in the vocabulary is one id, whether merges lead there or not; ids decode to the text's own bytes; a text of any length is
processed whole; repeated rows get equal results; an empty table gives no rows; only the key and text columns are read, so others may
have any name. A vocabulary that lacks a single byte raises an error on a text that needs it.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import distinct_runs, pretokens, take_runs
from .common import read

NONE = np.iinfo(np.int64).max  # a leaf without a pair
SHORT = 64  # bytes of a pre-token whose tree is a row among others
CELLS = 1 << 20  # leaves of the trees that are laid out together


class TreeBpe:
    """``ranks``: the vocabulary, each token's bytes and rank, which is its id too."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, max(ranks.values(), default=0) + 1
        self.token_bytes = [b""] * self.size
        for token, r in ranks.items():
            self.token_bytes[r] = token
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        # Every way to put a token together of two: a pair's rank is that of its bytes.
        pairs = {a * (self.size + 1) + b: r for t, r in ranks.items() for c in range(1, len(t)) if (a := ranks.get(t[:c])) is not None and (b := ranks.get(t[c:])) is not None}
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.token_len = np.fromiter(map(len, self.token_bytes), np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.all_bytes = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    @classmethod
    def load(cls, path: str) -> TreeBpe:
        with open(path, "rb") as f:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token})

    def leaves(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        """rank * width + position of each pair, so that equal ranks go by position; NONE where the two don't merge."""
        if not len(self.keys):
            return np.full(len(a), NONE)
        key = a * (self.size + 1) + b
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[k] == key, self.pair_rank[k] * width + at, NONE)

    def symbols(self, raw: bytes) -> np.ndarray:
        out = self.byte_id[np.frombuffer(raw, np.uint8)]
        if len(out) and out.min() < 0:
            raise ValueError("the vocabulary lacks a single byte that a text holds")
        return out

    def merge_rows(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in a row, and how many each has. ``width``: a power of two that no word exceeds."""
        n, lengths = len(words), np.fromiter(map(len, words), np.int64, len(words))
        row = np.repeat(np.arange(n), lengths)
        col = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # Column ``width`` stands for "no neighbour"; its symbol pairs with none.
        sym = np.full((n, width + 1), self.size, np.int64)
        sym[row, col] = self.symbols(b"".join(words))
        live = np.zeros((n, width), bool)
        live[row, col] = True
        nxt = np.tile(np.arange(1, width + 2), (n, 1))
        nxt[np.arange(n), lengths - 1] = width
        prv = np.tile(np.arange(-1, width), (n, 1))
        prv[:, 0] = width
        at = np.tile(np.arange(width), n)
        levels = [self.leaves(sym[:, :-1].ravel(), sym[:, 1:].ravel(), at, width).reshape(n, width)]
        while levels[-1].shape[1] > 1:
            levels.append(np.minimum(levels[-1][:, ::2], levels[-1][:, 1::2]))
        root, todo = levels[-1][:, 0], np.arange(n)

        def put(rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> None:
            levels[0][rows, cols] = values
            for low, high in zip(levels, levels[1:], strict=False):
                cols = cols >> 1
                high[rows, cols] = np.minimum(low[rows, 2 * cols], low[rows, 2 * cols + 1])

        while len(todo := todo[root[todo] < NONE]):
            best = root[todo]
            i, made = best % width, best // width
            j, before = nxt[todo, i], prv[todo, i]
            after = nxt[todo, j]
            sym[todo, i], live[todo, j] = made, False
            nxt[todo, i], prv[todo, after] = after, i
            put(todo, j, np.full(len(todo), NONE))
            put(todo, i, self.leaves(made, sym[todo, after], i, width))
            left = before < width
            put(todo[left], before[left], self.leaves(sym[todo[left], before[left]], made[left], before[left], width))
        return sym[:, :width][live], live.sum(axis=1)

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same for one word of any length."""
        n = len(word)
        width = 1 << (n - 1).bit_length()
        start = self.symbols(word)
        level = np.full(width, NONE)
        level[: n - 1] = self.leaves(start[:-1], start[1:], np.arange(n - 1), width)
        levels = [level]
        while len(level) > 1:
            level = np.minimum(level[::2], level[1::2])
            levels.append(level)
        # Node k has the children 2k and 2k + 1; leaf i is node width + i.
        tree = array("q", np.concatenate([[NONE], *reversed(levels)]).tobytes())
        sym, nxt, prv = array("q", start.tobytes()), array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        pairs, base, none = self.pairs, self.size + 1, int(NONE)

        def put(i: int, value: int) -> None:
            k = width + i
            tree[k] = value
            while k > 1:
                a, b = tree[k], tree[k ^ 1]
                k >>= 1
                a = a if a < b else b
                if tree[k] == a:
                    return
                tree[k] = a

        while (best := tree[1]) < none:
            made, i = divmod(best, width)
            j = nxt[i]
            after, before = nxt[j], prv[i]
            sym[i], sym[j] = made, -1
            nxt[i] = after
            put(j, none)
            rank = None
            if after < n:
                prv[after] = i
                rank = pairs.get(made * base + sym[after])
            put(i, none if rank is None else rank * width + i)
            if before >= 0:
                rank = pairs.get(sym[before] * base + made)
                put(before, none if rank is None else rank * width + before)
        out = np.frombuffer(sym, np.int64)
        return out[out >= 0]

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where each word's begin, and how many it has."""
        starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        parts: list[np.ndarray] = []
        total = 0

        def place(which: list[int], ids: np.ndarray, n: np.ndarray) -> None:
            nonlocal total
            starts[which], counts[which] = total + np.cumsum(n) - n, n
            parts.append(ids)
            total += len(ids)

        whole, rows = [], {}
        for k, w in enumerate(words):
            if w in self.ranks:
                whole.append(k)
            elif len(w) <= SHORT:
                rows.setdefault(1 << (len(w) - 1).bit_length(), []).append(k)
            else:
                ids = self.merge_long(w)
                place([k], ids, np.array([len(ids)]))
        place(whole, np.array([self.ranks[words[k]] for k in whole], np.int64), np.ones(len(whole), np.int64))
        for width, which in rows.items():
            for at in range(0, len(which), step := CELLS // width):
                part = which[at : at + step]
                place(part, *self.merge_rows([words[k] for k in part], width))
        return np.concatenate(parts), starts, counts

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's ids end."""
        raw, start, stop, first = pretokens(texts)
        code, words = distinct_runs(raw, start, stop)
        if not words:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        ids, begins, counts = self.merge_words(words)
        n_ids = counts[code]
        return take_runs(ids, begins[code], n_ids), np.concatenate(([0], np.cumsum(n_ids)))[first[1:]]

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each text."""
        lengths = self.token_len[ids]
        raw = take_runs(self.all_bytes, self.token_at[ids], lengths).tobytes()
        stop = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], ends))].tolist()
        return [raw[a:b] for a, b in zip(stop, stop[1:], strict=False)]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_batch(np.array(ids, np.int64), np.array([len(ids)]))[0]


_LOADED: dict[str, TreeBpe] = {}


def tokenizer(path: str) -> TreeBpe:
    """One a worker process."""
    if path not in _LOADED:
        _LOADED[path] = TreeBpe.load(path)
    return _LOADED[path]


BATCH_BYTES = 6_000_000  # texts are encoded together up to so many bytes, which bounds a worker's memory


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """``key``, n_tokens, ids (binary, little-endian unsigned 32-bit), decoded (binary); one row for each row of ``docs``.

    ``ids=False`` returns ids_sha256 and decoded_sha256 instead. ``path`` is that of the rank file on the machines that do the work;
    without one each looks up the public vocabulary for itself.
    """
    names = [key, "n_tokens", *(["ids", "decoded"] if ids else ["ids_sha256", "decoded_sha256"])]

    def run(batches):
        bpe = tokenizer(path or default_path())
        for batch in batches:
            keys, texts, start = batch.column(0), batch.column(1), 0
            size = pc.binary_length(texts).fill_null(0).to_pylist()
            while start < len(texts):
                stop, held = start, 0
                while stop < len(texts) and (stop == start or held + size[stop] <= BATCH_BYTES):
                    held += size[stop]
                    stop += 1
                flat, ends = bpe.encode_batch([t or "" for t in texts.slice(start, stop - start).to_pylist()])
                back = bpe.decode_batch(flat, ends)
                raw, cut = flat.astype("<u4").tobytes(), [0, *(4 * ends).tolist()]
                out = [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]
                counts = pa.array(np.diff(ends, prepend=0), pa.int64())
                if ids:
                    cols = [pa.array(out, pa.binary()), pa.array(back, pa.binary())]
                else:
                    cols = [pa.array([hashlib.sha256(x).hexdigest() for x in part]) for part in (out, back)]
                yield pa.RecordBatch.from_arrays([keys.slice(start, stop - start), counts, *cols], names)
                start = stop

    base = docs.select(F.col(key), F.col(text))
    kind = base.schema[key].dataType.simpleString()
    return base.mapInArrow(run, f"`{key}` {kind}, n_tokens long, " + ("ids binary, decoded binary" if ids else "ids_sha256 string, decoded_sha256 string"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), ids=False)
