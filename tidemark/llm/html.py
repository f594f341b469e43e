"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is read once into leaf blocks: runs of text between block-level tags, with the tags and class words of their
ancestors. Script-like elements, comments and form controls have no blocks. Features of a block's ancestors and text
feed a two-state chain (main text or not) that is decoded by Viterbi. The chain is trained here, by gradient
ascent on the log-likelihood of labelled pages that ``labelled_pages`` lays out by rule in many templates.

Defined cases: a null or empty page, and one without main text, give an empty text; unclosed and stray tags are taken
as browsers do for paragraphs, list items and cells; very long pages and blocks are taken whole, and tags or quotes that never
end cost linear time; embedded formulas, drawings and objects keep their text; repeated rows get equal results; an empty table
gives no rows; only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read

BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Elements whose content is never read as text: scripts, styles and form controls.
SKIPPED = frozenset("script style noscript template textarea select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag closes an open element of these names, up to the nearest container.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
CONTAINERS = frozenset("article aside blockquote body div dl fieldset figure footer form header html main menu nav ol section table ul".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: What may change a tag's end: a quote that begins a value, or the end itself.
_QUOTE = re.compile(r"""=\s*["']|>""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
#: Words of class and id attributes that name the same kind of part; they share a feature.
HINTS = {
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination toolbar tabs",
    "side": "sidebar aside related widget rail recommended",
    "notice": "cookie cookies notice consent alert popup modal newsletter subscribe gdpr",
    "talk": "comment comments commentlist reply replies responses discussion reviews",
    "edge": "footer foot copyright header masthead topbar",
    "share": "share sharing social follow tags",
    "text": "content entry post story article body main text",
}
_HINT = {w: k for k, ws in HINTS.items() for w in ws.split()}


class Level:
    """An open element over the one that it stands in: the features that no element below it has, so a path's features are those of its levels."""

    __slots__ = ("below", "new", "inside")

    def __init__(self, below: Level | None, new: tuple[str, ...], inside: bool):
        self.below, self.new, self.inside = below, new, inside


class Block:
    """A run of text: the element it stands in, the level of the page's open elements, how much of it is links."""

    __slots__ = ("text", "tag", "level", "linked")

    def __init__(self, text: str, tag: str, level: Level | None, linked: int):
        self.text, self.tag, self.level, self.linked = text, tag, level, linked


class Scanner:
    """Tags in page order, in linear time: a stretch without an end is looked through once."""

    def __init__(self, page: str):
        self.page = page
        self.last = {q: page.rfind(q) for q in "\"'"}
        self.ends: dict[str, tuple[int, int]] = {}

    def tag(self, pos: int) -> tuple[int, int, bool, str, str] | None:
        """The next tag: start, end, whether it closes, lower-case name, attributes; comments and declarations have no name.

        A quoted value may hold ``>``; one that never ends is none.
        """
        page, pos = self.page, self.page.find("<", pos)
        while pos >= 0:
            if page.startswith("<!--", pos):
                end = page.find("-->", pos + 4)
                return pos, len(page) if end < 0 else end + 3, False, "", ""
            if page[pos + 1 : pos + 2] in ("!", "?"):
                end = page.find(">", pos)
                return (pos, end + 1, False, "", "") if end >= 0 else None
            if m := _NAME.match(page, pos + 1 + (page[pos + 1 : pos + 2] == "/")):
                at = m.end()
                while q := _QUOTE.search(page, at):
                    if q[0] == ">":
                        return pos, q.end(), page[pos + 1] == "/", m[0].lower(), page[m.end() : q.start()]
                    at = page.find(q[0][-1], q.end()) + 1 if q.end() <= self.last[q[0][-1]] else q.end()
                return None  # no tag can end any more
            pos = page.find("<", pos + 1)
        return None

    def after(self, name: str, pos: int) -> int:
        """Where the element of this name ends."""
        found = self.ends.get(name, (-1, -1))
        if found[0] < pos:
            m = re.compile(f"</{re.escape(name)}\\b[^>]*>", re.I).search(self.page, pos)
            found = self.ends[name] = m.span() if m else (len(self.page), len(self.page))
        return found[1]


class Stack:
    """Open elements, with counts of their features, and the places of each name and of the containers."""

    def __init__(self) -> None:
        self.open: list[tuple[str, tuple[str, ...], Level]] = []
        self.counts: Counter[str] = Counter()
        self.places: dict[str, list[int]] = {}
        self.containers: list[int] = []

    @property
    def level(self) -> Level | None:
        return self.open[-1][2] if self.open else None

    def push(self, name: str, words: list[str]) -> None:
        own = tuple(dict.fromkeys(["in:" + name, *["name:" + w for w in words], *["hint:" + _HINT[w] for w in words if w in _HINT]]))
        below = self.level
        level = Level(below, tuple(f for f in own if f not in self.counts), bool(below and below.inside) or name in ("article", "main"))
        self.counts.update(own)
        self.places.setdefault(name, []).append(len(self.open))
        if name in CONTAINERS:
            self.containers.append(len(self.open))
        self.open.append((name, own, level))

    def cut(self, size: int) -> None:
        while len(self.open) > size:
            name, own, _ = self.open.pop()
            self.places[name].pop()
            if name in CONTAINERS:
                self.containers.pop()
            for f in own:
                self.counts[f] -= 1
                if not self.counts[f]:
                    del self.counts[f]

    def last(self, name: str) -> int:
        return places[-1] if (places := self.places.get(name)) else -1

    def close(self, name: str) -> None:
        if (i := self.last(name)) >= 0:
            self.cut(i)

    def start(self, name: str) -> None:
        """Close what a start tag of this name closes, up to the nearest container."""
        closed = CLOSES.get(name, {"p"})
        while (i := max(map(self.last, closed))) >= 0 and (not self.containers or i >= self.containers[-1]):
            self.cut(i)


def leaf_blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack, parts = Stack(), []
    linked, links, pos = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, stack.open[-1][0] if stack.open else "", stack.level, linked))
            parts.clear()
        linked = 0

    scanner = Scanner(page)
    while found := scanner.tag(pos):
        start, end, closes, name, attributes = found
        if start > pos:
            parts.append(page[pos:start])
            if links:
                linked += start - pos
        pos = end
        if not name:
            continue
        if name in SKIPPED:
            if not closes and not attributes.endswith("/"):
                pos = scanner.after(name, pos)
            continue
        if name == "a":
            links = 0 if closes else 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in BLOCKS:
            continue
        flush()
        links = 0
        if closes:
            stack.close(name)
            continue
        stack.start(name)
        if name not in VOID:
            stack.push(name, [w for c in _NAMES.findall(attributes) for w in _WORDS.findall("".join(c).lower())])
    if pos < len(page):
        parts.append(page[pos:])
        if links:
            linked += len(page) - pos
    flush()
    return out


def own_features(b: Block) -> list[str]:
    """The features of a block but for those of its path."""
    n = len(b.text)
    share = b.linked / max(n, 1)
    out = ["bias", "tag:" + b.tag, f"size:{min(7, int(math.log2(n + 1)))}", f"links:{0 if share < 0.05 else 1 if share < 0.5 else 2}"]
    if b.text[-1] in ".!?":
        out.append("sentence")
    if "©" in b.text:
        out.append("copyright")
    if not (b.level and b.level.inside):
        out.append("outside")
    return out


def block_features(b: Block) -> list[str]:
    out, level = own_features(b), b.level
    while level:
        out += level.new
        level = level.below
    return out


MAIN, REST = 1, 0


class ChainCrf:
    """Two states; the weights of a feature are those of the state MAIN."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.moves = [[0.0, 0.0], [0.0, 0.0]]

    def score(self, feats: Iterable[str]) -> float:
        w = self.weights
        return sum(w.get(f, 0.0) for f in feats)

    def scores(self, blocks: list[Block]) -> list[float]:
        """The score of each block; what blocks share of their paths is added up once."""
        known: dict[Level | None, float] = {None: 0.0}
        out = []
        for b in blocks:
            level, more = b.level, []
            while level not in known:
                more.append(level)
                level = level.below
            total = known[level]
            for level in reversed(more):
                total = known[level] = total + self.score(level.new)
            out.append(self.score(own_features(b)) + total)
        return out

    def decode(self, scores: list[float]) -> list[int]:
        """The best states of a chain of blocks with these scores."""
        best, back = (0.0, 0.0), []
        for k, s in enumerate(scores):
            new, way = [], []
            for y in (REST, MAIN):
                a, b = (best[0] + self.moves[0][y], best[1] + self.moves[1][y]) if k else (0.0, -1e-9)
                way.append(int(b > a))
                new.append(max(a, b) + (s if y == MAIN else 0.0))
            best = (new[0], new[1])
            back.append(way)
        y, out = int(best[1] > best[0]), []
        for way in reversed(back):
            out.append(y)
            y = way[y]
        return out[::-1]

    def step(self, chain: list[list[str]], gold: list[int], squares: dict[str, float], rate: float) -> None:
        """One ascent step on the chain's log-likelihood, with AdaGrad rates."""
        s, n = [self.score(f) for f in chain], len(chain)
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
        fwd = [(0.0, s[0])]
        for k in range(1, n):
            p = fwd[-1]
            fwd.append((add(p[0] + self.moves[0][0], p[1] + self.moves[1][0]), add(p[0] + self.moves[0][1], p[1] + self.moves[1][1]) + s[k]))
        bwd = [(0.0, 0.0)]
        for k in range(n - 1, 0, -1):
            q = bwd[-1]
            bwd.append((add(self.moves[0][0] + q[0], self.moves[0][1] + s[k] + q[1]), add(self.moves[1][0] + q[0], self.moves[1][1] + s[k] + q[1])))
        bwd.reverse()
        z = add(*fwd[-1])
        for k in range(n):
            g = gold[k] - math.exp(min(0.0, fwd[k][1] + bwd[k][1] - z))
            if abs(g) > 1e-6:
                for f in chain[k]:
                    squares[f] = squares.get(f, 1e-2) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) * 0.9998 + rate * g / math.sqrt(squares[f])
        for k in range(1, n):
            for a in (0, 1):
                for b in (0, 1):
                    p = math.exp(min(0.0, fwd[k - 1][a] + self.moves[a][b] + (s[k] if b else 0.0) + bwd[k][b] - z))
                    self.moves[a][b] += 0.02 * rate * (float(gold[k - 1] == a and gold[k] == b) - p)


def labelled_pages(n: int = 400, seed: int = 5) -> list[tuple[str, list[str]]]:
    """Pages laid out by rule, and the texts of their main blocks."""
    r = random.Random(seed)
    pick = r.choice
    word = lambda: "".join(pick(["the", "on", "er", "in", "qu", "ation", "ei", "sch", "os", "en", "ré"]) for _ in range(r.randint(1, 3)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    sentence = lambda a=4, b=40: words(a, b).capitalize() + pick([".", ".", ".", "!", "?", "", "***", "!!"])
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'

    def paragraph(main: list[str]) -> str:
        text = " ".join(sentence(1 if r.random() < 0.3 else 4) for _ in range(r.randint(1, 4)))
        main.append(text)
        return pick(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<blockquote>{}</blockquote>"]).format(text)

    def junk(kinds: int = 9) -> str:
        kind = r.randrange(kinds)
        body = pick([sentence(), f"<p>{sentence()}</p>", f"<p>{sentence()}</p><p>{sentence()}</p>"])
        if kind == 0:
            return pick(["<nav>{}</nav>", '<div class="menu">{}</div>', '<div id="nav">{}</div>']).format("<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(3, 8))) + "</ul>")
        if kind == 1:
            return f'<div class="{pick(["ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo"])}">{body}</div>'
        if kind == 2:
            return pick(["<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div id="sidebar">{}</div>', '<section class="related">{}</section>']).format(f"<h3>{words(1, 3)}</h3>" + pick([body, f"<ul><li>{link()}</li><li>{link()}</li></ul>"]))
        if kind == 3:
            return pick(['<div class="cookie-notice">{}</div>', '<div class="notice">{}</div>', '<div role="alert" class="consent">{}</div>', '<div class="newsletter">{}</div>', '<div class="popup">{}</div>']).format(body)
        if kind == 4:
            return f'<form action="/s"><label>{words(1, 3)}</label><input name="q"><p>{sentence()}</p><button>{word()}</button></form>'
        if kind == 5:
            return pick(['<section class="comments">{}</section>', '<div id="comments">{}</div>', '<div class="comment">{}</div>', '<ol class="comment-list">{}</ol>', '<article class="comment">{}</article>', '<section id="responses" class="replies">{}</section>']).format(f"<h2>{words(1, 3)}</h2>" + "".join(pick(["<p>{}</p>", "<li><p>{}</p></li>", '<div class="comment-body">{}</div>']).format(sentence()) for _ in range(r.randint(1, 4))))
        if kind == 6:
            return f'<div class="{pick(["share", "social", "tags", "breadcrumbs", "pagination", "toolbar"])}">{link()} {link()}</div>'
        if kind == 7:
            return pick(["<script>var t=\"</p>\";f(0);</script>", "<style>p{margin:0}</style>", "<!-- ad 3 -->", f"<noscript>{sentence()}</noscript>"])
        return pick(["<header>{}</header>", '<div class="header">{}</div>', '<div id="masthead">{}</div>']).format(pick([f"<h2>{words(1, 4)}</h2>", f"<p>{sentence()}</p>", link()]))

    def article(main: list[str]) -> str:
        title = words(2, 12)
        main.append(title)
        out = pick(["<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h1>{}</h1>"]).format(title)
        for _ in range(r.randint(1, 9)):
            x = r.random()
            if x < 0.78:
                out += paragraph(main)
            elif x < 0.84:
                items = [sentence(2, 12) for _ in range(r.randint(2, 5))]
                main += items
                out += pick(["<ul>{}</ul>", "<ol>{}</ol>"]).format("".join(f"<li>{i}</li>" for i in items))
            elif x < 0.88:
                head = words(2, 6)
                main.append(head)
                out += f"<h2>{head}</h2>"
            elif x < 0.91:
                cells = [words(1, 4) for _ in range(4)]
                main += cells
                out += "<table><tr><td>{}</td><td>{}</td></tr><tr><td>{}</td><td>{}</td></tr></table>".format(*cells)
            elif x < 0.93:
                text = words(2, 10)
                main.append(text)
                out += f"<figure><img src='x'><figcaption>{text}</figcaption></figure>"
            else:
                out += junk(8)  # a header within an article holds its title
        return out

    pages = []
    for _ in range(n):
        main: list[str] = []
        before, after = "".join(junk() for _ in range(r.randint(1, 4))), "".join(junk() for _ in range(r.randint(0, 4)))
        open_, close = pick([("<article>", "</article>")] * 3 + [("<main>", "</main>"), ('<main><article class="post">', "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main" class="entry">', "</div>"), ('<section class="story">', "</section>")])
        body = open_ + article(main) + close
        foot = pick(["<footer>{}</footer>", '<div class="footer">{}</div>', '<div id="footer">{}</div>', ""]).format(f"&copy; {word()}.example.com &middot; {sentence()}")
        pages.append((f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body>{before}{body}{after}{foot}" + pick(["</body></html>", ""]), main))
    return pages


@lru_cache
def model(epochs: int = 10) -> ChainCrf:
    crf, squares, data = ChainCrf(), {}, []
    for page, main in labelled_pages():
        blocks, todo, gold = leaf_blocks(page), [" ".join(t.split()) for t in main], []
        for b in blocks:  # the main blocks come in page order
            hit = bool(todo) and b.text == todo[0]
            gold.append(int(hit))
            if hit:
                todo.pop(0)
        if not todo and blocks:
            data.append(([block_features(b) for b in blocks], gold))
    for epoch in range(epochs):
        for chain, gold in data:
            crf.step(chain, gold, squares, 0.3 / (1 + 0.3 * epoch))
    return crf


def main_text(page: str | None, crf: ChainCrf) -> str:
    blocks = leaf_blocks(page or "")
    if not blocks:
        return ""
    return "\n\n".join(b.text for b, y in zip(blocks, crf.decode(crf.scores(blocks)), strict=True) if y == MAIN)


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """``keys``, text, n_chars; one row for each row of ``pages``."""
    crf = pages.sparkSession.sparkContext.broadcast(model())
    base = pages.select(*keys, html)

    def run(batches):
        for batch in batches:
            texts = [main_text(p, crf.value) for p in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keys, "text", "n_chars"])

    return base.mapInArrow(run, ", ".join(f"`{k}` {base.schema[k].dataType.simpleString()}" for k in keys) + ", text string, n_chars long")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
