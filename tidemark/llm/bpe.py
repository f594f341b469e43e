"""Byte-level BPE by a pair occurrence index.

A batch's distinct pre-tokens are laid out as one array of symbols with links to their neighbours. The
index maps the rank of every mergeable pair to all positions where that pair stands. Active ranks are
applied in ascending order: one rank's occurrences are merged together in the whole batch, and the lists
of the pairs that thereby arise on the left and right are updated. A merge only ever creates pairs of
higher rank, as the new symbol was learned later, so one ascending sweep gives what merging word by word
gives.

Defined cases: a null text is treated as empty and has no ids; special tokens that occur in a text are
matched as the tokenizers library does; ids decode to the text's own bytes, so every text comes back
unless it holds lone surrogates, which Spark's UTF-8 strings can't; long texts are processed whole; repeated rows get equal
results; an empty table gives no rows; only the key and text columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import read

#: The pre-tokenizer's pattern, a fixed value of this public vocabulary; pretokens() finds the same runs.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""".replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s+", r"\p{White_Space}+").replace(r"\S", r"\P{White_Space}")


def byte_chars() -> dict[str, int]:
    """The vocabulary's printable stand-in for each byte, by its public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndexBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, to_byte = spec["model"]["vocab"], byte_chars()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = np.zeros(256, np.int32)
        for c, b in to_byte.items():
            self.byte_id[b] = vocab[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.left, self.right = left.astype(np.int32), right.astype(np.int32)
        key = left * size + right
        self.order = np.argsort(key, kind="stable")
        self.keys, self.size = key[self.order], size
        self.cuts = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.token_len = np.fromiter(map(len, self.token_bytes), np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.all_bytes = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it never merges."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in a row, and where each word's ids end."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n, ends = int(lengths.sum()), np.cumsum(lengths)
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        at = np.arange(n, dtype=np.int64)
        # Position n stands for "no neighbour" and holds no symbol.
        nxt, prv = np.append(at + 1, n), np.append(at - 1, n)
        nxt[ends[lengths > 0] - 1] = n
        prv[(ends - lengths)[lengths > 0]] = n
        sym = np.append(sym, np.int32(-1))
        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(where: np.ndarray) -> None:
            """Enter the pairs that begin at these positions in the index."""
            where = where[nxt[where] < n]
            rank = self.ranks(sym[where], sym[nxt[where]])
            keep = rank >= 0
            where, rank = where[keep], rank[keep]
            if not len(where):
                return
            by = np.argsort(rank, kind="stable")
            where, rank = where[by], rank[by]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.concatenate(([0], cut))].tolist(), np.split(where, cut), strict=True):
                if r in lists:
                    lists[r].append(part)
                else:
                    lists[r] = [part]
                    heapq.heappush(active, r)

        note(at[nxt[:n] < n])
        while active:
            r = heapq.heappop(active)
            parts = lists.pop(r)
            i = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            a, b = self.left[r], self.right[r]
            i = i[(sym[i] == a) & (sym[nxt[i]] == b)]
            if a == b and len(i) > 1:  # in a run, every other pair from the left
                i, taken, last = np.sort(i), [], -1
                for x, y in zip(i.tolist(), nxt[i].tolist(), strict=True):
                    if x != last:
                        taken.append(x)
                        last = y
                i = np.array(taken, np.int64)
            if not len(i):
                continue
            j = nxt[i]
            sym[i], sym[j] = self.made[r], -1
            after = nxt[j]
            nxt[i] = after
            prv[after[after < n]] = i[after < n]
            before = prv[i]
            before = before[before < n]
            note(np.concatenate((before, i)))
        live = sym[:n] >= 0
        return sym[:n][live], np.concatenate(([0], np.cumsum(live)))[ends]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's ids end."""
        marks: list[tuple[int, int, int]] = []  # piece, its special token's id, its text
        pieces, owner = [], []
        for k, t in enumerate(texts):
            if self.cuts is None or not any(s in t for s in self.special):
                pieces.append(t)
                owner.append(k)
                continue
            for x in self.cuts.split(t):
                if x in self.special:
                    marks.append((len(pieces), self.special[x], k))
                    pieces.append("")
                else:
                    pieces.append(x)
                owner.append(k)
        raw, start, stop, first = pretokens(pieces)
        code, words = distinct_runs(raw, start, stop)
        ids, ends = self.merge_words(words)
        counts = np.diff(ends, prepend=0)
        n_ids = counts[code] if len(code) else np.zeros(0, np.int64)
        out = take_runs(ids, (ends - counts)[code], n_ids) if len(code) else ids
        before = np.concatenate(([0], np.cumsum(n_ids)))
        piece_end = before[first[1:]]
        if marks:
            at = np.array([piece_end[m[0]] for m in marks])
            out = np.insert(out, at, [m[1] for m in marks])
            extra = np.zeros(len(pieces), np.int64)
            extra[[m[0] for m in marks]] = 1
            piece_end = piece_end + np.cumsum(extra)
        last = np.searchsorted(np.array(owner, np.int64), np.arange(len(texts)), side="right") - 1
        return out, piece_end[last] if len(texts) else np.zeros(0, np.int64)

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each text."""
        lengths = self.token_len[ids]
        raw = take_runs(self.all_bytes, self.token_at[ids], lengths).tobytes()
        stop = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], ends))].tolist()
        return [raw[a:b] for a, b in zip(stop, stop[1:], strict=False)]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_batch(np.array(ids, np.int64), np.array([len(ids)]))[0].decode("utf-8", "replace")


LETTER, NUMBER, SPACE, OTHER, EDGE = range(5)
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point, by the same Unicode properties that the pattern names."""
    if not _CLASSES:
        table = np.full(0x110000, OTHER, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, prop in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(prop, every):
                a, b = ord(every[m.start()]), ord(every[m.end() - 1])
                table[a : b + 1] = kind  # a run never spans the surrogates, which are neither
        _CLASSES.append(table)
    return _CLASSES[0]


def pretokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What PATTERN finds in the texts, as byte runs: all bytes, starts, stops, and the first run of each text (and the total).

    Text edges are marked by a separating code point of a class of its own, so no run crosses them.
    """
    raw = "\0".join(["", *texts, ""])
    c = np.frombuffer(raw.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    edge = np.concatenate(([0], np.cumsum(lengths + 1)))
    k = classes()[c]
    k[edge] = EDGE
    n = len(c)
    begin = np.empty(n, bool)
    begin[0] = True
    np.not_equal(k[1:], k[:-1], out=begin[1:])
    begin[edge] = True
    begin[np.minimum(edge + 1, n - 1)] = True
    white = k == SPACE
    # The last character of white space before a word stands alone, or leads the word if it is a blank.
    last = np.zeros(n, bool)
    last[:-1] = white[:-1] & ~white[1:] & (k[1:] != EDGE)
    begin |= last
    lead = last & (c == 32)
    joined = np.zeros(n, bool)
    joined[1:] = lead[:-1]
    begin &= ~joined
    # Contractions: an apostrophe that begins a run, with the letters of a fixed list behind it.
    tick = np.flatnonzero((c == 39) & begin & (k == OTHER))
    if len(tick):
        a, b = c[np.minimum(tick + 1, n - 1)], c[np.minimum(tick + 2, n - 1)]
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        begin[tick[one | two] + 1] = False
        for at in (tick[one] + 2, tick[two] + 3):
            begin[at] = True
    begin[edge] = True
    at = np.flatnonzero(begin)
    width = np.ones(n, np.int64)
    for bound in (0x80, 0x800, 0x10000):
        width += c >= bound
    byte_at = np.concatenate(([0], np.cumsum(width)))
    is_edge = k[at] == EDGE
    start, stop = byte_at[at], byte_at[np.append(at[1:], n)]
    first = (np.cumsum(~is_edge))[is_edge]
    return np.frombuffer(raw.encode(), np.uint8), start[~is_edge], stop[~is_edge], first


def distinct_runs(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number the byte runs by content: the number of each, and the distinct runs."""
    import pandas as pd

    if not len(start):
        return np.zeros(0, np.int64), []
    length = stop - start
    base = np.full(int(length.max()), 0x9E3779B97F4A7C15, np.uint64)
    base[0] = 1
    power = np.cumprod(base)
    # Weight each byte by its place in its run, then sum by run.
    place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(np.cumsum(length) - length, length)
    flat = raw[np.repeat(start, length) + place]
    key = np.add.reduceat((flat.astype(np.uint64) + np.uint64(1)) * power[place], np.cumsum(length) - length) ^ (length.astype(np.uint64) << np.uint64(56))
    code, uniques = pd.factorize(key)
    sample = np.empty(len(uniques), np.int64)
    sample[code[::-1]] = np.arange(len(code))[::-1]
    # The key only sorts; equality is checked byte by byte.
    if (length[sample][code] != length).any() or (raw[np.repeat(start[sample][code], length) + place] != flat).any():
        number: dict[bytes, int] = {}
        code = np.array([number.setdefault(raw[a:b].tobytes(), len(number)) for a, b in zip(start, stop, strict=True)])
        return code, list(number)
    whole = raw.tobytes()
    return code, [whole[a:b] for a, b in zip(start[sample].tolist(), stop[sample].tolist(), strict=True)]


def take_runs(source: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Runs of ``source`` one after the other."""
    before = np.cumsum(length) - length
    return source[np.repeat(start - before, length) + np.arange(int(length.sum()))]


_LOADED: dict[str, PairIndexBpe] = {}


def tokenizer(path: str) -> PairIndexBpe:
    """One a worker process."""
    if path not in _LOADED:
        _LOADED[path] = PairIndexBpe(path)
    return _LOADED[path]


BATCH_CHARS = 2_000_000  # texts are encoded together up to so many characters, which bounds a worker's memory


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """``key``, n_tokens, ids (binary, little-endian unsigned 32-bit), decoded text; one row for each row of ``docs``.

    ``ids=False`` returns ids_sha256 and decoded_sha256 instead of the ids and the text. ``path`` is that of the vocabulary on the
    machines that do the work; without one each looks up the public vocabulary for itself.
    """

    def run(batches):
        bpe = tokenizer(path or default_path())
        for batch in batches:
            keys, texts, start = batch.column(0), batch.column(1).to_pylist(), 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and (stop == start or chars + len(texts[stop] or "") <= BATCH_CHARS):
                    chars += len(texts[stop] or "")
                    stop += 1
                flat, ends = bpe.encode_batch([t or "" for t in texts[start:stop]])
                back = bpe.decode_batch(flat, ends)
                counts = np.diff(ends, prepend=0)
                raw, cut = flat.astype("<u4").tobytes(), [0, *(4 * ends).tolist()]
                out = [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]
                cols = [pa.array(counts, pa.int64())]
                if ids:
                    cols += [pa.array(out, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in back], pa.string())]
                else:
                    cols += [pa.array([hashlib.sha256(x).hexdigest() for x in out]), pa.array([hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in back])]
                yield pa.RecordBatch.from_arrays([keys.slice(start, stop - start), *cols], names)
                start = stop

    names = [key, "n_tokens", *(["ids", "decoded"] if ids else ["ids_sha256", "decoded_sha256"])]
    base = docs.select(key, text)
    kind = base.schema[key].dataType.simpleString()
    return base.mapInArrow(run, f"`{key}` {kind}, n_tokens long, " + ("ids binary, decoded string" if ids else "ids_sha256 string, decoded_sha256 string"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), ids=False)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's count and digest of ids, and the digest of the text that they decode to."""
    out = encode(docs, ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
