"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks at block-level tags.  A block's features are its
words and link density, those of both neighbours, and where it stands: in an article,
in an element for frames (nav, footer, ...), in an element whose class names a frame.
Class names are features, no verdicts: a decision tree, grown here on a small labelled
table of blocks, says which blocks are main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.labelled_pages import LABELLED

_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
#: text inside is never shown as text
_RAW = frozenset("script style noscript template textarea svg math iframe object canvas title select button".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FRAME = frozenset("nav footer aside form dialog menu".split())
#: elements that end the named open one when they start
_ENDS = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
_HINT = frozenset(
    "ad ads adbox advert advertisement advertising aside banner bottombar breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notification pager pagination popup promo recommended related replies reply respond search share sharing "
    "sidebar sidenav signup skip social sponsor sponsored subscribe teaser toolbar topbar warning alert widget".split()
)
#: a class with one of these parts says where text is, or where a frame is not
_CONTENT = frozenset("article body content entry layout main page post results story text wrapper has no with without".split())
#: no sign of a frame inside an article
_EDGES = frozenset("header footer title form login warning alert skip search".split())
_TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|/?[a-zA-Z](?:(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+(?:>|\Z)|[^>]*+(?:>|\Z)))",
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_HINTS = re.compile(r"\s(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=>/])|display\s*:\s*none|aria-hidden\s*=\s*\"?true", re.I)
_PART = re.compile(r"[a-z]+")
FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "in_article", "in_frame", "in_hint", "heading",
)


@dataclass
class Block:
    text: str
    link_words: int
    article: bool
    frame: bool
    hint: bool
    heading: bool

    @property
    def words(self) -> int:
        return len(self.text.split())


@dataclass
class _Open:
    name: str
    article: bool
    frame: bool
    hint: bool
    link: bool


def _hints(token: str) -> set[str]:
    """Words of a tag's classes, id and role that name a frame; a class with a word for content names none."""
    found: set[str] = set()
    for m in _HINTS.finditer(token):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = set(_PART.findall(name))
            if not parts & _CONTENT:
                found |= parts & _HINT
            elif parts <= _CONTENT:
                return set()
    return found


def blocks_of(html: str) -> list[Block]:
    """Non-empty text blocks in page order; white space runs are one space, references decoded."""
    found: list[Block] = []
    stack = [_Open("", False, False, False, False)]
    parts: list[str] = []
    linked: list[str] = []

    def end_block(heading: bool = False) -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            top = stack[-1]
            links = len(unescape(" ".join(linked)).split())
            found.append(Block(text, links, top.article, top.frame, top.hint, heading))
        parts.clear()
        linked.clear()

    def take(text: str) -> None:
        parts.append(text)
        if stack[-1].link:
            linked.append(text)

    def close(names: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                del stack[depth:]
                return
            if stack[depth].name in ("article", "main", "body", "table", "ul", "ol") and not {"article", "main", "body", "html", "table", "ul", "ol", "nav", "div", "section"} & set(names):
                return

    at, end = 0, len(html)
    while at < end:
        match = _TOKEN.search(html, at)
        take(html[at : match.start()] if match else html[at:])
        if not match:
            break
        token, at = match[0], match.end()
        if token.startswith(("<!", "<?")):
            continue
        name = _NAME.match(token)[1].lower()
        if token.startswith("</"):
            if name in _BLOCK:
                end_block(heading=name in ("h1", "h2", "h3", "h4", "h5", "h6"))
            if name in _BLOCK or name == "a":
                close((name,))
            continue
        if name in _RAW:
            if name == "select":
                end_block()
            if not token.endswith("/>"):
                shut = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                at = shut.end() if shut else end
            continue
        if name in ("br", "img", "input", "wbr"):
            take(" " if name == "br" else "")
            continue
        if name == "a":
            close(("a",))
        elif name in _BLOCK:
            end_block()
            for old in _ENDS.get(name, ()):
                close((old,))
        else:
            continue
        if name in _VOID or token.endswith("/>"):
            continue
        top = stack[-1]
        inner = name in ("article", "main")
        hints = _hints(token) if "=" in token and name not in ("body", "html") else set()
        if top.article or inner:
            hints -= _EDGES
        frame = (
            (top.frame and not inner)
            or name in _FRAME
            or (name == "header" and not top.article)
            or (" " in token and bool(_HIDDEN.search(token)))
        )
        # an article starts anew, whatever its wrappers are called
        hint = bool(hints) or (top.hint and not inner)
        stack.append(_Open(name, top.article or inner, frame, hint, top.link or name == "a"))
    end_block()
    return found


def features_of(blocks: list[Block]) -> np.ndarray:
    """One row per block, columns as in FEATURES; missing neighbours count as empty."""
    words = np.array([b.words for b in blocks], float)
    links = np.array([b.link_words for b in blocks], float) / np.maximum(words, 1)
    before, after = (lambda x: np.append(0.0, x[:-1])), (lambda x: np.append(x[1:], 0.0))
    flags = [np.array([getattr(b, k) for b in blocks], float) for k in ("article", "frame", "hint", "heading")]
    return np.stack([words, links, before(words), before(links), after(words), after(links), *flags], axis=1)


@dataclass
class Tree:
    """A binary decision tree: a leaf's share of main text, or a split at a threshold."""

    share: float
    column: int = -1
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None
    rows: int = field(default=0)

    def columns(self) -> set[str]:
        """Names of the features that the tree asks for."""
        if self.low is None:
            return set()
        return {FEATURES[self.column]} | self.low.columns() | self.high.columns()

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(rows), self.share >= 0.5)
        out = np.empty(len(rows), bool)
        left = rows[:, self.column] <= self.threshold
        out[left], out[~left] = self.low.predict(rows[left]), self.high.predict(rows[~left])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 12, least: int = 1) -> Tree:
    """A tree by Gini impurity: best split first, ties by column order and lower threshold."""
    tree = Tree(float(labels.mean()) if len(labels) else 0.0, rows=len(labels))
    if depth == 0 or tree.share in (0.0, 1.0) or len(labels) < 2 * least:
        return tree
    best = (1e-12, -1, 0.0)
    whole = tree.share * (1 - tree.share) * len(labels)
    for column in range(rows.shape[1]):
        values = np.unique(rows[:, column])
        for threshold in (values[1:] + values[:-1]) / 2:
            left = rows[:, column] <= threshold
            if min(left.sum(), (~left).sum()) < least:
                continue
            gain = whole - sum(p.mean() * (1 - p.mean()) * len(p) for p in (labels[left], labels[~left]))
            if gain > best[0] + 1e-9:
                best = (gain, column, float(threshold))
    if best[1] < 0:
        return tree
    tree.column, tree.threshold = best[1:]
    left = rows[:, tree.column] <= tree.threshold
    tree.low = grow(rows[left], labels[left], depth - 1, least)
    tree.high = grow(rows[~left], labels[~left], depth - 1, least)
    return tree


def train(labelled=LABELLED) -> Tree:
    """A tree from ``(html, main blocks)`` pages: a block is main text if its text is listed."""
    rows, labels = [], []
    for html, main in labelled:
        blocks = blocks_of(html)
        rows.append(features_of(blocks))
        labels += [b.text in main for b in blocks]
    return grow(np.concatenate(rows), np.array(labels, float))


def main_text(html: str | None, tree: Tree) -> str:
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    keep = tree.predict(features_of(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep.tolist(), strict=True) if k)


def extract(pages: DataFrame, tree: Tree | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; null html has an empty text.

    Pages are handled one by one in memory; rows that repeat an id stay rows of
    their own; malformed markup is read as far as it goes.
    """
    grown = tree or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, grown) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string").withColumn(
        "n_chars", F.length("text").cast("long")
    )
