"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is parsed into leaf blocks, the runs of text between block-level tags.  Each block is
content or boilerplate; a chain over the blocks in page order scores features of the ancestor
tags, their class and id words and the text, and the change of label from block to block.
The field is trained by maximum likelihood on labelled pages and decoded by Viterbi.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labelled pages of a table that training uses, about, and their longest; and built pages.
TRAIN_PAGES, TRAIN_CHARS, BUILT_PAGES = 400, 200_000, 500
STEPS, RATE, RIDGE = 150, 0.3, 0.003
SEED = 11

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var".split())
UNSEEN = frozenset("head script style noscript template svg math iframe object select textarea button canvas audio video".split())
# An opening tag closes an open element of its group.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Block tags that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main nav ol p pre section table ul".split())
# Elements that a closing tag of something outside does not leave open or close across.
WALLS = frozenset("article aside body div footer form header html main nav section table td th".split())
LISTS = frozenset("dl ol ul".split())

SECTIONS = frozenset("article aside footer form header main nav".split())
# Short blocks that hold one of these words are seldom the article's.
CUES = frozenset("advertisement comment comments cookie cookies copyright login menu newsletter privacy related reply search share "
                 "sign sponsored subscribe".split())

_NAME = re.compile(r"[a-z]+")
_TAG_START = re.compile(r"<[/!?a-zA-Z]")
_SECTION = re.compile(r"<!\[(?!CDATA\[)")
_EMPTY_COMMENT, _COMMENT_END = re.compile(r"<!---?>"), re.compile(r"--(?:\s*|!)>")
# Elements whose text is no markup, if their closing tag follows; script and style are so always.
_RAW_END = {tag: re.compile(rf"</\s*{tag}\s*>", re.I) for tag in ("iframe", "textarea", "title")}


class Place:
    """The elements around a block, inline ones aside.

    A place holds what its element adds to the features of the place ``up`` around it, so
    places of any depth take memory and time linear in the page.
    """

    __slots__ = ("up", "leaf", "own", "section", "new", "score")

    def __init__(self, up: Place | None, leaf: str, own: tuple[str, ...], section: str, new: tuple[str, ...]):
        self.up, self.leaf, self.own, self.section, self.new = up, leaf, own, section, new
        self.score: tuple[dict[str, float], float] | None = None

    def features(self) -> Iterator[str]:
        place = self
        while place:
            yield from place.new
            place = place.up

    def scored(self, weights: dict[str, float]) -> float:
        """Sum of the weights of all features; remembered for the last weights asked for."""
        waiting, place = [], self
        while place and not (place.score and place.score[0] is weights):
            waiting.append(place)
            place = place.up
        total = place.score[1] if place else 0.0
        for place in reversed(waiting):
            total += sum(weights.get(f, 0.0) for f in place.new)
            place.score = weights, total
        return total


class Block(NamedTuple):
    text: str
    place: Place | None
    link_chars: int
    label: int | None


class Element(NamedTuple):
    """An open element: its tag, the place and label inside it, and the features that it opened."""

    tag: str
    place: Place | None
    label: int | None
    new: tuple[str, ...]


class _Blocks(HTMLParser):
    """Collects leaf blocks with the place of their elements.

    Positions of open elements are kept by tag and by kind, so the element that a tag closes
    is found at once at any depth.
    """

    CDATA_CONTENT_ELEMENTS = ("script", "style", *_RAW_END)

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.at, self.raw_until = 0, {}
        self.blocks: list[Block] = []
        self.stack: list[Element] = []
        self.open: dict[str, list[int]] = {}
        self.solid: list[int] = []  # not inline
        self.walls: list[int] = []
        self.stops: list[int] = []  # walls and lists
        self.held: set[str] = set()  # features of the open elements
        self.unseen = self.links = 0
        self.pieces: list[str] = []
        self.link_chars = 0

    def flush(self) -> None:
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.stack[-1] if self.stack else Element("", None, None, ())
            self.blocks.append(Block(text, top.place, self.link_chars, top.label))
        self.pieces, self.link_chars = [], 0

    def _push(self, tag: str, names: list[str], label: int | None) -> None:
        at, top = len(self.stack), self.stack[-1] if self.stack else Element("", None, None, ())
        place, new = top.place, ()
        if tag not in INLINE:
            said = dict.fromkeys(["in=" + tag, *(f for name in names for f in ("name=" + name, "stem=" + name[:5]))])
            new = tuple(f for f in said if f not in self.held)
            self.held.update(new)
            place = Place(place, tag, tuple(names) or (place.own if place else ()),
                          tag if tag in SECTIONS else place.section if place else "none", new)
            self.solid.append(at)
            if tag in WALLS:
                self.walls.append(at)
            if tag in WALLS or tag in LISTS:
                self.stops.append(at)
        self.open.setdefault(tag, []).append(at)
        self.stack.append(Element(tag, place, top.label if label is None else label, new))
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def _pop_to(self, at: int) -> None:
        while len(self.stack) > at:
            tag, *_, new = self.stack.pop()
            self.open[tag].pop()
            self.held.difference_update(new)
            for kind in (self.solid, self.walls, self.stops):
                if kind and kind[-1] == len(self.stack):
                    kind.pop()
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"

    def _last(self, tag: str) -> int:
        """Position of the innermost open element of a tag, -1 without one."""
        return self.open[tag][-1] if self.open.get(tag) else -1

    def parse_comment(self, i, report=1):
        """The end of a comment; one that never ends takes the rest of the page."""
        end = _EMPTY_COMMENT.match(self.rawdata, i) or _COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_starttag(self, i):
        self.at = i
        return super().parse_starttag(i)

    def set_cdata_mode(self, elem):
        if elem in _RAW_END:
            if elem not in self.raw_until:  # from the end, since the text before a rest may be gone
                last = max((m.start() for m in _RAW_END[elem].finditer(self.rawdata, self.at)), default=-1)
                self.raw_until[elem] = len(self.rawdata) - last if last >= 0 else len(self.rawdata) + 1
            if len(self.rawdata) - self.at <= self.raw_until[elem]:
                return
        super().set_cdata_mode(elem)

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif not self.unseen:
                self.pieces.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            group = CLOSES.get(tag, ()) + (("p",) if tag in ENDS_P else ())
            at = max(map(self._last, group), default=-1)
            if at >= 0 and not (self.stops and self.stops[-1] > at):
                self._pop_to(at)
        names, label = [], None
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += _NAME.findall(value.lower())
            elif key == "data-label" and value in ("0", "1"):
                label = int(value)
            elif key == "hidden" or (key == "style" and value and "display:none" in value.replace(" ", "").lower()):
                names.append("hidden")
        self._push(tag, names, label)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag not in INLINE:
            self.flush()
        at = self._last(tag)
        if at < 0 or (tag in INLINE and self.solid and self.solid[-1] > at):
            return  # a stray end
        if tag == "p" and self.walls and self.walls[-1] > at:
            return
        self._pop_to(at)

    def handle_data(self, data):
        if self.unseen:
            return
        if self.cdata_elem == "title":
            data = entities.unescape(data)
        self.pieces.append(data)
        if self.links:
            self.link_chars += len(data.strip())


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order.  A tag or comment that the page's end cuts off is dropped."""
    if cut := _TAG_START.search(page, page.rfind(">") + 1):  # a tag that never ends
        page = page[:cut.start()]
    parser = _Blocks()
    parser.feed(_SECTION.sub("<!", page))
    parser.close()
    parser.flush()
    return parser.blocks


def _bucket(n: int) -> int:
    return min(int(math.log2(n + 1)), 9)


def own_features(block: Block, place: int, of: int, known_tags: bool = True) -> set[str]:
    """Names of the features of a block but those that any element around it gives."""
    text = block.text
    words = text.split()
    out = {"bias", f"len={_bucket(len(words))}", f"link={min(3, 4 * block.link_chars // max(len(text), 1))}",
           f"end={text[-1] if text[-1] in '.!?:;,…»>|' else 'x'}", f"commas={min(text.count(','), 3)}"}
    if "©" in text:
        out.add("copyright")
    if of <= 2:
        out.add("few")
    elif place in (0, of - 1):
        out.add("last" if place else "first")
    if len(words) <= 8:
        out.update("cue=" + w for w in {w.lower().strip(".,:!?") for w in words} & CUES)
    if block.place:
        leaf = block.place.leaf
        out.add("leaf=" + (leaf if known_tags or leaf in ("p", "li", "div", "td") or leaf[0] == "h" else "div"))
        # the innermost element that says something outweighs those around it
        out.update("own=" + name[:5] for name in block.place.own)
    if known_tags:
        out.add("sect=" + (block.place.section if block.place else "none"))
    return out


def block_features(block: Block, place: int, of: int, known_tags: bool = True) -> list[str]:
    """Names of the features of a block.  ``known_tags`` off hides what sectioning tags say."""
    around = block.place.features() if block.place else ()
    return sorted(own_features(block, place, of, known_tags).union(f for f in around if known_tags or not f.startswith("in=")))


class Field(NamedTuple):
    """A trained field: score of content over boilerplate per feature, and of label changes."""

    weights: dict[str, float]
    moves: list[list[float]]


def viterbi(scores: list[float], moves: list[list[float]]) -> list[int]:
    """The most likely labels; of equals, boilerplate."""
    if not scores:
        return []
    best, back = [0.0, scores[0]], []
    for s in scores[1:]:
        step, now = [], []
        for y in (0, 1):
            from0, from1 = best[0] + moves[0][y], best[1] + moves[1][y]
            step.append(int(from1 > from0))
            now.append(max(from0, from1) + (s if y else 0.0))
        back.append(step)
        best = now
    y = int(best[1] > best[0])
    out = [y]
    for step in reversed(back):
        y = step[y]
        out.append(y)
    return out[::-1]


def labels(field: Field, page: list[Block]) -> list[int]:
    get = field.weights.get
    scores = [math.fsum(get(f, 0.0) for f in own_features(b, i, len(page))) + (b.place.scored(field.weights) if b.place else 0.0)
              for i, b in enumerate(page)]
    return viterbi(scores, field.moves)


def main_text(field: Field, page: str | None) -> str:
    """Content blocks in page order, one per line."""
    found = blocks(page or "")
    return "\n".join(b.text for b, y in zip(found, labels(field, found)) if y)


def fit(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS) -> Field:
    """Maximum likelihood with a ridge, by adaptive gradient steps over all pages at once.

    Forward and backward sums run over all pages together, block position by block position.
    """
    pages = [(f, y) for f, y in pages if f]
    names = sorted({x for f, _ in pages for b in f for x in b})
    number = {x: i for i, x in enumerate(names)}
    n, longest = len(pages), max((len(y) for _, y in pages), default=0)
    if not n:
        return Field({}, [[0.0, 0.0], [0.0, 0.0]])
    flat, starts, cell, gold = [], [], [], np.zeros((n, longest), int)
    for p, (f, y) in enumerate(pages):
        for t, b in enumerate(f):
            starts.append(len(flat))
            flat += [number[x] for x in b]
            cell.append(p * longest + t)
        gold[p, :len(y)] = y
    flat, starts, cell = np.array(flat), np.array(starts), np.array(cell)
    owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(flat)]))
    size = np.array([len(y) for _, y in pages])
    real = np.arange(longest)[None, :] < size[:, None]
    pair = real[:, 1:]
    w, m = np.zeros(len(names)), np.zeros((2, 2))
    seen_w, seen_m = np.full(len(names), 1e-8), np.full((2, 2), 1e-8)
    gold_moves = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            gold_moves[a, b] = ((gold[:, :-1] == a) & (gold[:, 1:] == b) & pair).sum()
    for _ in range(steps):
        score = np.zeros(n * longest)
        score[cell] = np.add.reduceat(w[flat], starts)
        emit = np.stack([np.zeros((n, longest)), score.reshape(n, longest)], axis=2)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = emit[:, 0]
        for t in range(1, longest):
            nxt = np.logaddexp(ahead[:, t - 1, :1] + m[0], ahead[:, t - 1, 1:] + m[1]) + emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], nxt, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            part = behind[:, t + 1] + emit[:, t + 1]
            prev = np.logaddexp(part[:, :1] + m[:, 0], part[:, 1:] + m[:, 1])
            behind[:, t] = np.where(real[:, t + 1, None], prev, 0.0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None]
        marginal = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total)
        error = ((gold - marginal) * real).reshape(-1)[cell]
        grad = np.bincount(flat, error[owner], len(names)) - RIDGE * w
        moves = np.zeros((2, 2))
        if longest > 1:
            for a in (0, 1):
                for b in (0, 1):
                    joint = ahead[:, :-1, a] + m[a, b] + emit[:, 1:, b] + behind[:, 1:, b] - total
                    moves[a, b] = np.exp(np.where(pair, joint, -np.inf)).sum()
        grad_m = gold_moves - moves - RIDGE * m
        seen_w += grad ** 2
        seen_m += grad_m ** 2
        w += RATE * grad / np.sqrt(seen_w)
        m += RATE * grad_m / np.sqrt(seen_m)
    return Field({x: float(w[i]) for x, i in number.items() if w[i]}, m.tolist())


# Labelled pages built from parts: what a part is decides its label, its text and order vary.
# ``{s}`` stands for sentences, ``{t}`` for a few words, ``{l}`` for list items with links.
BOILERPLATE = (
    "<nav><ul>{l}</ul></nav>", "<div class='menu'><ul>{l}</ul></div>", "<div id='navigation'>{t} | {t}</div>",
    "<header><a href='/'>{t}</a><p>{t}</p></header>", "<div class='site-header'><h2>{t}</h2></div>",
    "<ul class='breadcrumb'>{l}</ul>", "<aside><h3>{t}</h3><p>{s}</p></aside>",
    "<div class='sidebar'><h3>{t}</h3><ul>{l}</ul><p>{s}</p></div>", "<div id='right-column' class='widget'><p>{s}</p></div>",
    "<div class='ad'>{s}</div>", "<div class='advert banner'><p>{t}</p></div>", "<div id='ads'><a href='/x'>{t}</a></div>",
    "<div class='sponsored promo'><p>{s}</p></div>", "<section class='advertisement'>{s}</section>",
    "<div class='cookie-notice'><p>We use cookies. {s}</p></div>", "<div id='consent' class='popup'>{s}</div>",
    "<div class='notice alert'>{s}</div>", "<div role='dialog' class='modal'><p>{s}</p></div>",
    "<form action='/search'><label>{t}</label><input name='q'></form>", "<form class='newsletter'><p>{s}</p><input type='email'></form>",
    "<div class='subscribe signup'><h4>{t}</h4><p>{s}</p></div>", "<div class='share social'><ul>{l}</ul></div>",
    "<section class='related'><h3>{t}</h3><ul>{l}</ul></section>", "<div class='recommended more'>{l}</div>",
    "<div class='tags'><a href='/t'>{t}</a> <a href='/t'>{t}</a></div>", "<div class='pagination'><a href='/2'>{t}</a></div>",
)
COMMENTS = (
    "<section id='comments'><h3>Comments</h3><div class='comment'><p>{s}</p></div><div class='comment'><p>{s}</p></div></section>",
    "<div class='comment-list'><ul><li>{s}</li><li>{s}</li></ul></div>", "<ol class='commentlist'><li><p>{s}</p></li></ol>",
    "<div class='reader-comments'><p>{s}</p><p>{s}</p></div>", "<div class='discussion replies'><p>{s}</p></div>",
)
BOTTOM = (
    "<footer>&copy; {t} {s}</footer>", "<footer><p>{t}</p><ul>{l}</ul></footer>", "<div class='footer'><p>&copy; {t}</p></div>",
    "<div id='page-footer'>{s}</div>", "<footer>{s}</footer>",
)
CONTENT = (
    "<p>{s}</p>", "<p>{s}</p>", "<p>{s}</p>", "<p>{s}</p>", "<h2>{t}</h2><p>{s}</p>", "<ul><li>{s}</li><li>{t}</li></ul>",
    "<blockquote><p>{s}</p></blockquote>", "<p>{t}</p>", "<p>{s} <a href='/r'>{t}</a> {s}</p>", "<h3>{t}</h3><ol><li>{s}</li></ol>",
    "<figure><img src='i'><figcaption>{t}</figcaption></figure>", "<table><tr><td>{t}</td><td>{s}</td></tr></table>", "<pre>{s}</pre>",
)
FRAMES = (
    "<article data-label='1'><h1>{t}</h1>{c}</article>", "<article data-label='1'><header><h1>{t}</h1></header>{c}</article>",
    "<main data-label='1'><h1>{t}</h1>{c}</main>", "<main><article data-label='1'><h1>{t}</h1>{c}</article></main>",
    "<div id='content' data-label='1'><h1>{t}</h1>{c}</div>", "<div class='post entry-content' data-label='1'><h1>{t}</h1>{c}</div>",
    "<div class='article-body' data-label='1'>{c}</div>", "<section class='story' data-label='1'><h1>{t}</h1>{c}</section>",
    "<div data-label='1'><h1>{t}</h1>{c}</div>", "<article data-label='1'>{c}</article>", "<div class='main text' data-label='1'>{c}</div>",
)


def built_pages(sentences: list[str], count: int = BUILT_PAGES, seed: int = SEED) -> list[str]:
    """Labelled pages of varied layout around the given sentences; the same for the same arguments."""
    rng = random.Random(seed)
    sentences = sentences or ["A page needs some text to be read.", "Here is one more, with a comma."]

    def fill(part: str, label: int | None = None) -> str:
        def text(kind):
            if kind == "s":
                return entities.escape(" ".join(rng.choice(sentences) for _ in range(rng.randint(1, 4))))
            words = rng.choice(sentences).split()
            short = lambda: entities.escape(" ".join(words[:rng.randint(1, 6)]))
            return short() if kind == "t" else "".join(f"<li><a href='/p'>{short()}</a></li>" for _ in range(rng.randint(2, 6)))
        out = re.sub(r"\{([stl])\}", lambda m: text(m[1]), part)
        return out if label is None else f"<div data-label='{label}'>{out}</div>" if rng.random() < 0.3 else re.sub(r"^<(\w+)", rf"<\1 data-label='{label}'", out)

    out = []
    for _ in range(count):
        inner = [fill(rng.choice(CONTENT)) for _ in range(rng.choice((0, 1, 2, 3, 5, 8, 13)))]
        if rng.random() < 0.4:  # something foreign inside the article
            inner.insert(rng.randint(0, len(inner)), fill(rng.choice(BOILERPLATE[9:]), 0))
        if rng.random() < 0.3:
            inner.append(fill(rng.choice(COMMENTS), 0))
        frame = fill(rng.choice(FRAMES)).replace("{c}", "".join(inner))
        open_body = "<body>"
        if rng.random() < 0.12:  # an article without a frame of its own
            open_body, frame = "<body data-label='1'>", fill("<h1>{t}</h1>") * (rng.random() < 0.7) + "".join(inner)
        before = [fill(rng.choice(BOILERPLATE), 0) for _ in range(rng.randint(0, 4))]
        after = [fill(rng.choice(BOILERPLATE), 0) for _ in range(rng.randint(0, 2))]
        if rng.random() < 0.4:
            after.append(fill(rng.choice(COMMENTS), 0))
        if rng.random() < 0.8:
            after.append(fill(rng.choice(BOTTOM), 0))
        if rng.random() < 0.08:
            before, after = [], []
        out.append(f"<html>{open_body}" + "".join([*before, frame, *after]) + "</body></html>")
    return out


def marked_label(block: Block) -> int:
    """Label of a block of a page whose markup says what is an article: the teacher on real pages."""
    around = set(block.place.features()) if block.place else set()
    outside = around & ({"in=" + tag for tag in ("nav", "footer", "aside", "form")} | {"name=" + name for name in (
        "ad", "ads", "advert", "banner", "comment", "comments", "cookie", "sidebar", "menu", "promo", "related", "share")})
    return int("in=article" in around and not outside)


def train(pages: DataFrame, html: str = "html", rows: int = TRAIN_PAGES) -> Field:
    """A field from about ``rows`` pages that mark their article, and built labelled pages.

    Real pages are chosen by a hash of their markup, so the choice is the same in every run.
    Half of all pages are shown without their sectioning tags, so that class words, text and
    order count as well.  Without real pages the built ones suffice.
    """
    marked = pages.select(F.col(html).alias("h")).filter(F.col("h").contains("<article") & (F.length("h") <= TRAIN_CHARS))
    total = marked.count()
    if total > rows:
        marked = marked.filter(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < F.lit((1 << 30) * rows // total))
    real = [blocks(p) for p in sorted(r["h"] for r in marked.limit(2 * rows).collect())]
    sentences = [s.strip() for page in real[:60] for b in page if marked_label(b) for s in re.split(r"(?<=[.!?])\s", b.text) if s.strip()]
    shown = [(page, [marked_label(b) for b in page]) for page in real]
    shown += [(page, [b.label or 0 for b in page]) for page in map(blocks, built_pages(sentences[:2000]))]
    rng = random.Random(SEED)
    examples = []
    for page, y in shown:
        known = rng.random() < 0.5
        examples.append(([block_features(b, i, len(page), known) for i, b in enumerate(page)], y))
    return fit(examples)


def extract(df: DataFrame, field: Field, html: str = "html") -> DataFrame:
    """``df`` with ``text`` and ``n_chars`` (replaced where they exist): the main text of whole pages.

    A null or empty page, and one without content blocks, has an empty text.
    """
    shared = df.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trained = shared.value
        for batch in batches:
            yield pd.Series([main_text(trained, p) for p in batch], dtype="object")

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("text", "n_chars")]
    out = df.select(*kept, text(F.coalesce(F.col(html), F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
