"""Personal data: base patterns, and a semi-Markov conditional random field that adds what they miss.

The base finds e-mail addresses, IP addresses, card and phone numbers by fixed patterns. The field labels segments, not
tokens: a candidate segment of up to MAX_LEN tokens is scored as a whole (its digits, shape, separators, checksum and the
words on both sides), and dynamic programming over bounded segments chooses boundaries and types together. It is trained
here, by gradient ascent on the log-likelihood of labelled sentences that ``examples`` makes by rule.

A segment can only be personal data if it meets a digit, an at sign or a word like "token" (or what follows such a word
closely), keeps to one line and overlaps nothing of the base. All other segments are single tokens of no type, so
the best labelling of a whole text is that of its stretches around these marks, MAX_LEN tokens to either side, and only they are
decoded; tests hold this against decoding every token.

Spans are in code points, the end exclusive. Spans of the base always stay; a span of the field is added where it
overlaps none of them.

Defined cases: a null or empty text has no spans; overlapping kinds of the base are all kept, as the kinds are searched
independently; long runs of digits or local characters take linear time; repeated rows get equal results; an empty table
gives no rows; texts are searched whole; only the key and text columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read

#: Kinds in the order of the contract; ``secret`` is found by the field only.
KINDS = ("email", "ip", "card", "phone", "secret")
#: The contract's patterns (fixed values), with possessive runs: no shorter match can succeed where a run has failed.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    """Leftmost matches, searched from each at sign back to the start of its local part."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str):
    for m in _CARD.finditer(text):
        d = digits_of(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end), sorted."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for k, search in ((1, ips), (2, cards), (3, phones)):
            found += [(a, k, b) for a, b in search(text)]
    return sorted(found)


_DIGIT = re.compile(r"[0-9]")

# ---- the field -------------------------------------------------------------------------------------------------

TYPES = ("none", *KINDS)
MAX_LEN = 20  # tokens of a segment of personal data; other segments are single tokens
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]|[^\S\n]+|\n")
_MARK = re.compile(r"[0-9@]+|\b(?:dot|token|secret|password|passwd|api[_ -]?key)\b", re.I)
NEAR = 24  # code points behind a word that marks
_WORD_NEAR = re.compile(r"[A-Za-z]+")
CUES = {"mail": "email", "email": "email", "contact": "email", "ip": "ip", "host": "ip", "address": "ip", "server": "ip", "card": "card", "visa": "card", "credit": "card", "payment": "card", "phone": "phone", "call": "phone", "tel": "phone", "mobile": "phone", "fax": "phone", "token": "secret", "secret": "secret", "password": "secret", "passwd": "secret", "key": "secret", "api": "secret"}


def _shape(s: str) -> str:
    """Classes of the characters, runs collapsed."""
    return re.sub(r"[0-9]+", lambda m: "9" if len(m[0]) < 3 else "999" if len(m[0]) < 5 else "99999", re.sub(r"[A-Za-z]+", "a", s))


def segment_features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Features of the tokens i to j (exclusive) as one whole."""
    a, b = tokens[i][0], tokens[j - 1][1]
    s = text[a:b]
    d = digits_of(s)
    out = ["len" + str(j - i), "shape" + _shape(s)]
    if d:
        out.append("digits" + str(min(len(d), 20)))
        if 12 <= len(d) <= 19 and luhn(d):
            out.append("luhn")
        if len(d) == len(s):
            out.append("alldigits")
    if "@" in s:
        out.append("at")
    if len(s) >= 16 and j - i <= 2 * MAX_LEN and s.isalnum() and d and len(d) < len(s):
        out.append("mixed16")
    if s[0].isspace() or s[-1].isspace():
        out.append("blankedge")
    if "\n" in s:
        out.append("newline")
    low = s.lower()
    if " at " in low and " dot " in low:
        out.append("spelled")
        if text[b : b + 5].lower() == " dot " or low.endswith((" dot", " at")):
            out.append("spelledon")
        if _SPELLED.match(low):
            out.append("localpart")
    if _DOTTED.fullmatch(s):
        out.append("dotted4")
    if _NATIONAL.fullmatch(s):
        out.append("national")
    for w in _WORD_NEAR.findall(text[max(0, a - 24) : a].lower())[-2:]:
        if w in CUES:
            out.append("cue" + CUES[w])
    if a and not text[a - 1].isspace():
        out.append("glued" + (text[a - 1] if not text[a - 1].isalnum() else "x"))
    if b < len(text) and text[b].isalnum():
        out.append("gluedright")
    return out


def marked(text: str, tokens: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> tuple[list[bool], list[bool]]:
    """Which tokens meet a mark, and which the base has taken."""
    if not tokens:
        return [], []
    first, last = tokens[0][0], tokens[-1][1]
    zones = [(m.start(), m.end() + (NEAR if m[0][0].isalpha() else 0)) for m in _MARK.finditer(text, first, last)]
    return _met(tokens, zones), _met(tokens, [(a, b) for a, _, b in base if a < last and b > first])


def _met(tokens: list[tuple[int, int]], zones: list[tuple[int, int]]) -> list[bool]:
    """Which tokens overlap a zone; both are in order of their starts."""
    out, k, reach = [], 0, -1
    for a, b in tokens:
        while k < len(zones) and zones[k][0] < b:
            reach = max(reach, zones[k][1])
            k += 1
        out.append(reach > a)
    return out


def candidates(text: str, tokens: list[tuple[int, int]], hot: list[bool], taken: list[bool]) -> Iterator[list[tuple[int, list[str], bool]]]:
    """First token and features of each segment that may end at each token, and whether it can be personal data.

    Those that can't are single tokens. None holds a newline, begins or ends blank, or holds a token that the base has taken.
    """
    blank = [text[a].isspace() for a, _ in tokens]
    first, mark = 0, -1  # a segment begins after the last newline or taken token; the last marked token
    for j in range(1, len(tokens) + 1):
        if taken[j - 1] or text[tokens[j - 1][0]] == "\n":
            first = j
        if hot[j - 1]:
            mark = j - 1
        low = max(first, j - MAX_LEN)
        own = [(i, segment_features(text, tokens, i, j), True) for i in range(low, min(j, mark + 1)) if not (blank[i] or blank[j - 1])]
        if not own or own[-1][0] != j - 1:
            own.append((j - 1, segment_features(text, tokens, j - 1, j), False))
        yield own


_DOTTED = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_SPELLED = re.compile(r"[a-z0-9._+-]+ at ")
_NATIONAL = re.compile(r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}")


@dataclass
class SemiCrf:
    weights: dict[tuple[int, str], float] = field(default_factory=dict)
    moves: np.ndarray = field(default_factory=lambda: np.zeros((len(TYPES), len(TYPES))))

    def score(self, y: int, feats: list[str]) -> float:
        w = self.weights
        return sum(w.get((y, f), 0.0) for f in feats)

    def lattice(self, candidates: Iterable[list[tuple[int, list[str], bool]]]):
        """Scored segments that end at each token: (start, type, score, features)."""
        for j, own in enumerate(candidates, 1):
            here = []
            for i, feats, data in own:
                if i == j - 1:
                    here.append((i, 0, self.score(0, feats), feats))
                if data:
                    here += [(i, y, self.score(y, feats), feats) for y in range(1, len(TYPES))]
            yield here

    def decode(self, text: str, tokens: list[tuple[int, int]], hot: list[bool], taken: list[bool]) -> list[tuple[int, int, int]]:
        """Best segmentation: (first token, end token, type) of the segments that are personal data. A text goes on with no type."""
        best = np.full((len(tokens) + 1, len(TYPES)), -1e18)
        best[0, 0] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j, here in enumerate(self.lattice(candidates(text, tokens, hot, taken)), 1):
            for i, y, s, _ in here:
                reach = best[i] + self.moves[:, y]
                p = int(reach.argmax())
                if reach[p] + s > best[j, y]:
                    best[j, y] = reach[p] + s
                    back[j, y] = (i, p)
        out, j, y = [], len(tokens), int((best[-1] + self.moves[:, 0]).argmax())
        while j > 0:
            i, p = back[j, y]
            if y:
                out.append((i, j, y))
            j, y = i, p
        return out[::-1]

    def gradient(self, own: list[list[tuple[int, list[str], bool]]], gold: list[tuple[int, int, int]]):
        """Observed less expected features, and the same for moves; the log-likelihood."""
        lattice, n, k = list(self.lattice(own)), len(own), len(TYPES)
        fwd, bwd = np.full((n + 1, k), -1e18), np.full((n + 1, k), -1e18)
        fwd[0, 0] = 0
        for j, here in enumerate(lattice, 1):
            for i, y, s, _ in here:
                fwd[j, y] = np.logaddexp(fwd[j, y], np.logaddexp.reduce(fwd[i] + self.moves[:, y]) + s)
        bwd[n] = self.moves[:, 0]
        for j in range(n, 0, -1):
            for i, y, s, _ in lattice[j - 1]:
                bwd[i] = np.logaddexp(bwd[i], self.moves[:, y] + s + bwd[j, y])
        z = np.logaddexp.reduce(fwd[n] + self.moves[:, 0])
        grad: dict[tuple[int, str], float] = {}
        moves = np.zeros((k, k))
        observed = {(i, j): y for i, j, y in gold}
        covered = {t for i, j, _ in gold for t in range(i, j)}
        last = 0
        for j, here in enumerate(lattice, 1):
            for i, y, s, feats in here:
                prob = np.exp(np.minimum(fwd[i] + self.moves[:, y] + s + bwd[j, y] - z, 0))
                moves[:, y] -= prob
                diff = -float(prob.sum())
                if observed.get((i, j)) == y or (y == 0 and i not in covered and j == i + 1):
                    diff += 1
                if diff:
                    for f in feats:
                        grad[y, f] = grad.get((y, f), 0.0) + diff
        i = 0
        starts = {a: (b, y) for a, b, y in gold}
        while i < n:
            i, y = starts.get(i, (i + 1, 0))
            moves[last, y] += 1
            last = y
        moves[last, 0] += 1
        moves[:, 0] -= np.exp(np.minimum(fwd[n] + self.moves[:, 0] - z, 0))
        return grad, moves, z


def tokenize(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, end)]


def examples(n: int = 300, seed: int = 11) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Sentences with labelled spans, made by rule: entities in all spellings, and numbers that are none."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["the", "on", "er", "in", "qu", "ation", "ei", "sch", "os", "en"]) for _ in range(r.randint(1, 3)))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card() -> str:
        body = r.choice("456") + num(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        return r.choice([body, f"{body[:4]} {body[4:8]} {body[8:12]} {body[12:]}", f"{body[:4]}-{body[4:8]}-{body[8:12]}-{body[12:]}"])

    make = {
        "email": lambda: r.choice([f"{word()}.{num(2)}@{word()}{num(1)}.example.com", f"{word()}@{word()}.org", f"{word()} at {word()} dot com", f"{word()}.{word()} at {word()}.example dot com", f"{word()} at {word()} dot example dot com"]),
        "ip": lambda: ".".join(str(r.randint(1, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: r.choice([f"+1 ({num(3)}) 555-{num(4)}", f"({num(3)}) 555-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}"]),
        "secret": lambda: "".join(r.choice("0123456789abcdef") for _ in range(40)),
        "": lambda: r.choice([num(r.randint(1, 6)), f"{r.randint(1, 12)}.{num(2)}", f"{num(4)}-{num(2)}-{num(2)}", f"{num(16)}0{num(5)}", "v" + num(1) + "." + num(1), f"{num(2)}%", f"@{word()}", f"{num(1)},{num(3)},{num(3)}"]),
    }
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(1, 2)):
            text += " ".join(word() for _ in range(r.randint(1, 3))) + " "
            kind = r.choice(list(make))
            if kind == "secret":
                text += r.choice(["token", "secret", "api key", "password"]) + r.choice([' = "', ": ", "="])
            elif kind and r.random() < 0.3:
                text += r.choice([c for c, k in CUES.items() if k == kind]) + r.choice([": ", " "])
            s = make[kind]()
            if kind:
                spans.append((len(text), len(text) + len(s), kind))
            text += s + ('"' if text.endswith('= "') else "") + r.choice([" ", ", ", ". ", "### "])
        out.append((text + word(), spans))
    return out


@lru_cache
def model(epochs: int = 4) -> SemiCrf:
    """The field, trained on ``examples`` by stochastic gradient ascent with AdaGrad steps."""
    crf, squares, move_squares = SemiCrf(), {}, np.full((len(TYPES), len(TYPES)), 1e-3)
    data = []
    for text, spans in examples():
        tokens = tokenize(text, 0, len(text))
        at, to = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
        gold = [(at[a], to[b], TYPES.index(k)) for a, b, k in spans if a in at and b in to and to[b] - at[a] <= MAX_LEN]
        if len(gold) == len(spans):
            data.append((list(candidates(text, tokens, *marked(text, tokens, []))), gold))
    for _ in range(epochs):
        for own, gold in data:
            grad, moves, _ = crf.gradient(own, gold)
            for key, g in grad.items():
                squares[key] = squares.get(key, 1e-3) + g * g
                crf.weights[key] = crf.weights.get(key, 0.0) * 0.9995 + 0.3 * g / squares[key] ** 0.5
            move_squares += moves**2
            crf.moves += 0.3 * moves / move_squares**0.5
    return crf


def added_spans(text: str, base: list[tuple[int, int, int]], crf: SemiCrf) -> list[tuple[int, int, int]]:
    """Spans that the field finds; they overlap none of the base's."""
    out: list[tuple[int, int, int]] = []
    for start, end in marked_lines(text):
        tokens = tokenize(text, start, end)
        hot, taken = marked(text, tokens, base)
        for a, b in stretches([h and not t for h, t in zip(hot, taken, strict=True)]):
            for i, j, y in crf.decode(text, tokens[a:b], hot[a:b], taken[a:b]):
                out.append((tokens[a + i][0], y - 1, tokens[a + j - 1][1]))
    return out


def marked_lines(text: str) -> Iterator[tuple[int, int]]:
    """Lines with a mark, and those that begin close behind a word that marks."""
    done = -1
    for m in _MARK.finditer(text):
        reach = m.end() + (NEAR if m[0][0].isalpha() else 0)
        at = max(m.start(), done + 1)
        while at < min(reach, len(text)):
            end = text.find("\n", at)
            end = len(text) if end < 0 else end
            if end > at:
                yield max(text.rfind("\n", 0, at) + 1, done + 1), end
            done, at = end, end + 1


def stretches(hot: list[bool]) -> Iterator[tuple[int, int]]:
    """Stretches of tokens outside which no segment can be personal data, with a token to spare."""
    start = end = 0
    for k in [*(k for k, h in enumerate(hot) if h), None]:
        if k is None or k - MAX_LEN > end:
            if end:
                yield start, end
            if k is None:
                return
            start = max(0, k - MAX_LEN)
        end = min(len(hot), k + MAX_LEN + 1)


def spans(text: str | None, crf: SemiCrf) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base's spans, and all spans."""
    text = text or ""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, crf))


def written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_email, n_ip, n_card, n_phone (of all spans of the base), base, spans; one row for each row of ``docs``."""
    crf = docs.sparkSession.sparkContext.broadcast(model())
    base = docs.select(key, text)
    names = [key, "n_email", "n_ip", "n_card", "n_phone", "base", "spans"]

    def run(batches):
        for batch in batches:
            found = [spans(t, crf.value) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(k == kind for _, k, _ in b) for b, _ in found], pa.int64()) for kind in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array([written(b) for b, _ in found]), pa.array([written(s) for _, s in found])], names)

    return base.mapInArrow(run, f"`{key}` {base.schema[key].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    out = personal_data(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
