"""Main text of web pages by tag-path ratios.

Every piece of text has the path of tags from the root to it. Text length and punctuation are
added up by path and divided by the number of pieces with that path: article text has long,
punctuated pieces, menus and notices have not. Along the page both ratios are smoothed with the
neighbours', multiplied, and compared with their standard deviation; the pieces above are the
content nodes.

The article is the ``article`` or ``main`` element that holds nearly all their text, with all its
blocks, so that short paragraphs between long ones stay. Without one it is the smallest section that
holds all of them: its parts without any content node are dropped, but for headings, and the
headings beside it belong to it.

What by its tag is a menu, footer, sidebar, form, script or style is left out, inside the article
too, and so is what by its class or id is a notice, advert, reader comment and the like. Such a name
is not believed where the element holds an ``article`` or ``main``, nor, on pages without these,
where it holds most of the content and is not about comments, nor where it says ``has-sidebar`` or ``no-comments``. Blocks that consist of links only are
left out unless their path is one of content nodes or they are headings or paragraphs.

Character references are decoded, white space within a block becomes one space, blocks are
trimmed, and empty ones dropped; they are joined by one line end in page order. A missing or
empty page, and one without text, gives an empty text. Unclosed and misplaced tags are closed
where the next block begins. Pages are handled one by one, so repeated rows give the same text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
SECTION = frozenset("html body main article section div table tbody tr td center blockquote".split())
LEFT_OUT = frozenset(
    "aside button dialog fieldset footer form head iframe input label legend math menu nav noscript "
    "object option script select style svg template textarea title".split()
)
# Words in a class or id that mark what is not the article.
MARKERS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disclaimer discussion disqus footer header login masthead menu "
    "modal nav navbar navigation newsletter notice notices overlay popup promo promotion related "
    "replies reply respond share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar widget".split()
)
# Of these, words that mark what readers wrote, which may be longer than the article.
READERS = frozenset("comment comments discussion disqus replies reply respond".split())
# A name that begins like this tells of the element's surroundings.
ABOUT = frozenset("after before has hide no not show with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKED, READER_MARKED = 1, 2
MOST = 0.5
# An element of the second kind is closed when one of the first begins inside it.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
LIST_OWNERS = frozenset("ul ol dl table menu select".split())
SMOOTHING = np.array([0.25, 0.5, 0.25])
NEARLY_ALL = 0.9
PAGE_FRAME = frozenset("html body main article".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？¡¿]")
NAME = re.compile(r"[A-Za-z]+")


class _Page(HTMLParser):
    """Reads a page into pieces of text with path, element, block and whether they are a mere link:
    one outside headings and paragraphs."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Open elements: (tag, element, path, left out, linked, inside an article, in running text).
        self.open = [("", 0, 0, False, False, False, False)]
        self.parents, self.tags, self.marks = [0], [""], [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.block = 0
        self.pieces: list[tuple[str, int, int, int, bool]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.block += 1
            self._close_open_paragraph()
        if tag in CLOSES:
            self._close_siblings(CLOSES[tag])
        if tag in VOID:
            if tag == "br" and not self.open[-1][3]:
                self._add(" ")
            return
        _, parent, path, left_out, linked, article, running = self.open[-1]
        element = len(self.parents)
        self.parents.append(parent)
        self.tags.append(tag)
        self.marks.append(0 if left_out else _mark(attrs))
        path = self.paths.setdefault((path, tag), len(self.paths) + 1)
        left_out = left_out or tag in LEFT_OUT or (tag == "header" and not article)
        article = article or tag in ("article", "main")
        running = running or tag == "p" or tag in HEADINGS
        self.open.append((tag, element, path, left_out, linked or tag == "a", article, running))

    def _close_open_paragraph(self) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == "p":
                del self.open[at:]
                return
            if self.open[at][0] in BLOCK:
                return

    def _close_siblings(self, tags: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at][0]
            if tag in LIST_OWNERS:
                return
            if tag in tags:
                del self.open[at:]
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.block += 1
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                return
            if self.open[at][0] in BLOCK and tag not in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        if not self.open[-1][3]:
            self._add(data)

    def _add(self, data: str) -> None:
        _, element, path, _, linked, _, running = self.open[-1]
        self.pieces.append((data, path, element, self.block, linked and not running))


def _mark(attrs: list[tuple[str, str | None]]) -> int:
    """What the names of an element say."""
    mark = 0
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            for name in value.split():
                words = [word.lower() for word in NAME.findall(name)]
                if words and words[0] not in ABOUT:
                    mark = max(mark, *(READER_MARKED if w in READERS else w in MARKERS for w in words))
    return int(mark)


def _content_nodes(lengths: np.ndarray, marks: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """Which pieces are content: smoothed length and punctuation per path, fused, thresholded."""
    _, path = np.unique(paths, return_inverse=True)
    pieces = np.bincount(path)
    ratios = []
    for amount in (lengths, marks):
        along = np.pad((np.bincount(path, amount) / pieces)[path], 1, mode="edge")
        ratios.append(np.convolve(along, SMOOTHING, "valid"))
    fused = ratios[0] * (1 + ratios[1])
    return fused >= min(fused.std(), fused.max())


def _held(page: _Page, elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weight inside every element."""
    held = np.bincount(elements, weights, len(page.parents))
    for element in range(len(page.parents) - 1, 0, -1):  # children come after their parents
        held[page.parents[element]] += held[element]
    return held


def _inside(page: _Page, roots: set[int]) -> np.ndarray:
    """For every element, whether it is one of ``roots`` or lies in one."""
    inside = np.zeros(len(page.parents), bool)
    for element in range(len(page.parents)):
        inside[element] = element in roots or (element > 0 and inside[page.parents[element]])
    return inside


def _weights(pieces: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Which pieces are content, and how much text the content pieces have."""
    lengths = np.array([len(p[0].strip()) for p in pieces])
    marks = np.array([len(PUNCTUATION.findall(p[0])) for p in pieces])
    content = _content_nodes(lengths, marks, np.array([p[1] for p in pieces]))
    return content, lengths * content


def _left_out(page: _Page, pieces: list[tuple]) -> np.ndarray:
    """The elements whose names are believed, and all in them."""
    marked = [e for e, mark in enumerate(page.marks) if mark and page.tags[e] not in PAGE_FRAME]
    if not marked or not pieces:
        return np.zeros(len(page.parents), bool)
    articles = np.array([t in ("article", "main") and not m for t, m in zip(page.tags, page.marks)], float)
    has_article = _held(page, np.arange(len(page.parents)), articles) > 0
    held = _held(page, np.array([p[2] for p in pieces]), _weights(pieces)[1])

    def believed(element: int) -> bool:
        most = held[element] >= MOST * held[0] and page.marks[element] == MARKED
        return not (has_article[element] or (most and not articles.any()))

    return _inside(page, {e for e in marked if believed(e)})


def _article(page: _Page, elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For every element, whether it belongs to the article."""
    held = _held(page, elements, weights)
    best, whole = 0, False
    for element in range(1, len(page.parents)):
        if page.parents[element] != best:
            continue
        whole = page.tags[element] in ("article", "main") and held[element] >= NEARLY_ALL * held[0]
        if whole or held[element] == held[0]:
            if page.tags[element] not in SECTION:
                break
            best = element
            if whole:
                break
    if whole:
        return _inside(page, {best})
    children = [e for e in range(1, len(page.parents)) if page.parents[e] == best]
    kept = {e for e in children if held[e] or page.tags[e] not in SECTION}
    beside = {
        e
        for e in range(1, len(page.parents))
        if best and page.parents[e] == page.parents[best] and page.tags[e] in HEADINGS
    }
    inside = _inside(page, kept | beside)
    inside[best] = True
    return inside


def main_text(html: str) -> str:
    page = _Page()
    page.feed(html)
    page.close()
    gone = _left_out(page, [p for p in page.pieces if p[0].strip()])
    every = [p for p in page.pieces if not gone[p[2]]]
    pieces = [p for p in every if p[0].strip()]
    if not pieces:
        return ""
    content, weights = _weights(pieces)
    inside = _article(page, np.array([p[2] for p in pieces]), weights)
    content_paths = {p[1] for p, good in zip(pieces, content) if good}
    blocks: dict[int, list[str]] = {}
    wanted: set[int] = set()
    for text, path, element, block, mere_link in every:
        if inside[element]:
            blocks.setdefault(block, []).append(text)
            if text.strip() and (not mere_link or path in content_paths):
                wanted.add(block)
    joined = (" ".join("".join(parts).split()) for block, parts in blocks.items() if block in wanted)
    return "\n".join(text for text in joined if text)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(html or "") for html in part["html"].to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "page_id": part["page_id"],
                        "url": part["url"],
                        "text": pa.array(texts, pa.string()),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    }
                )

    rows = pages.selectExpr("CAST(page_id AS BIGINT) AS page_id", "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
