"""Main text of web pages: parser events, text-to-tag ratios per line, smoothing and a threshold.

The standard library's streaming parser turns a page into lines, one for each block of text,
without scripts, controls and the like.  Elements that by tag, role or the name of a class or id are
not text of the page (menus, forms, comments and so on) are doubtful: they are left out unless they
hold the page's only article, main or h1, or, on a page without article and main, most of its text
of high ratio.  A name is read word by word, at hyphens, underscores and capitals; its last word says
what the element is (``site-footer``, ``comment-section``, not ``content-sidebar-wrap``).

Each line has a text-to-tag ratio.  Ratios are smoothed by a Gaussian, and lines at or above a share
of the mean are content.  Such lines choose the region: the innermost article or main element that
holds most of their text, or else the innermost section with nearly all of it and with the h1.  All
lines of the region are main text whatever their own ratio, so short paragraphs between long ones
are kept, and so is other content outside it (with an article: in other articles).

Work and memory grow with the length of a page, not with the depth of its elements.

Null or empty html gives an empty text.  Pages are handled one by one: repeated or null ids give
a row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X

#: Lines to either side that a line's ratio is smoothed over, and the share of the mean ratio
#: from which a line counts as content.
SPREAD, SHARE = 1.0, 0.5
#: Share of the content that the region of a page without article or main holds.
NEARLY = 0.9

# Elements of the HTML standard by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style noscript template svg math iframe object canvas audio video map head title button select textarea input label "
    "datalist".split()
)
DOUBTFUL = frozenset("nav footer aside form fieldset dialog menu".split())
LINKS = frozenset("nav footer dialog menu".split())
HEAD = frozenset("base link meta noscript script style template title".split())
MAIN = frozenset("article main".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NUMBERED = frozenset("article main section body div td blockquote h1".split())
CLOSED_BY = {
    **dict.fromkeys("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main nav ol p pre section table ul".split(), {"p"}),
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMED = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?\w*|consent\w*|notices?|alerts?|popups?|modal|overlay|"
    r"newsletter|subscribe|subscription|side-?bar\w*|menus?|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|top-?bar|"
    r"comments?|comment-?list|disqus\w*|replies|respond|discussion|related|share|sharing|social|toolbar|pagination|pager|widget\w*|"
    r"login|signup|search)",
    re.I,
)
# Words of a name that only say that something is there, in one piece or around another.
PARTS = frozenset(
    "area articles bar bars block blocks box boxes button buttons form icon icons item items link links list lists panel posts row "
    "section slot slots tags unit units zone".split()
)
AROUND = frozenset("container holder wrap wrapper".split())
ONLY_THEMSELVES = re.compile(r"(?:ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|comments?|newsletter|related|share|sharing|social)", re.I)
ABOUT = frozenset("has no not with without is".split())
HEADERS = frozenset("header masthead".split())
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@lru_cache(maxsize=4096)
def named_part(token: str) -> str | None:
    """What a class or id says that its element is, if that is not text of the page.

    ``NAMED`` as a whole, or as the last word before words of ``PARTS``.
    """
    if NAMED.fullmatch(token):
        return token.lower()
    words = [w.lower() for w in _WORDS.findall(token)]
    if not words or words[0] in ABOUT:
        return None
    if words[-1] in AROUND:
        return words[0] if len(words) == 2 and ONLY_THEMSELVES.fullmatch(words[0]) else None
    while len(words) > 1 and words[-1] in PARTS:
        words.pop()
    joined = "".join(words)
    return words[-1] if NAMED.fullmatch(words[-1]) else joined if NAMED.fullmatch(joined) else None


Line = tuple[str, int, int]  # text, tags, number of the innermost numbered element


class Lines(HTMLParser):
    """Collects a line for each block of text outside skipped elements.

    Elements that matter later are numbered from the top; ``parents`` and ``kinds`` tell of each
    number the element around it and the tag.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, bool, bool]] = []  # tag, skipped, numbered
        self.open: Counter[str] = Counter()
        self.inner = [0]  # numbers of the open numbered elements
        self.parents, self.kinds = [0], ["html"]
        self.doubtful: set[int] = set()
        self.parts: list[str] = []
        self.tags, self.skips = 0, 0

    def end_line(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append((text, max(self.tags, 1), self.inner[-1]))
            self.parts = []
        self.tags = 0

    def is_doubtful(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in DOUBTFUL:
            return True
        in_main = any(self.open[t] for t in MAIN)
        if tag == "header" and not in_main:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        for name, value in attrs:
            if name in ("class", "id") and value:
                found = {part for part in map(named_part, value.split()) if part}
                # an article has headers of its own
                if found - HEADERS if in_main else found:
                    return True
            if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return True
        return False

    def pop(self) -> None:
        tag, skipped, numbered = self.stack.pop()
        self.open[tag] -= 1
        if (tag in BLOCKS or numbered) and not self.skips:
            self.end_line()
        self.skips -= skipped
        if numbered:
            self.inner.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.stack and self.stack[-1][0] == "head" and tag not in HEAD:
            self.pop()
        closes = CLOSED_BY.get(tag)
        if closes and any(self.open[name] for name in closes):
            # an open paragraph or item ends here, with the inline elements inside it
            for i in range(len(self.stack) - 1, -1, -1):
                name = self.stack[i][0]
                if name in closes:
                    while len(self.stack) > i:
                        self.pop()
                    if not any(self.open[c] for c in closes):
                        break
                elif name in BLOCKS or name in SKIPPED or name in DOUBTFUL:
                    break
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag == "hr" and not self.skips:
                self.end_line()
            return
        skipped = tag in SKIPPED
        doubtful = not skipped and self.is_doubtful(tag, attrs)
        if (tag in BLOCKS or skipped or doubtful) and not self.skips:
            self.end_line()
        numbered = tag in NUMBERED or doubtful
        if numbered:
            if doubtful:
                self.doubtful.add(len(self.kinds))
            self.parents.append(self.inner[-1])
            self.inner.append(len(self.kinds))
            self.kinds.append(tag)
        self.skips += skipped
        self.stack.append((tag, skipped, numbered))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if not self.open[tag]:
            return
        block = tag in BLOCKS or tag in DOUBTFUL
        depth = len(self.inner) - 1
        for i in range(len(self.stack) - 1, -1, -1):
            name, skipped, numbered = self.stack[i]
            if name == tag:
                while len(self.stack) > i:
                    self.pop()
                return
            # blocks close what is open in them; the end of an inline element outside does not close a left-out one
            if not block and (skipped or numbered and self.inner[depth] in self.doubtful):
                return
            depth -= numbered

    def handle_data(self, data: str) -> None:
        if not self.skips:
            self.parts.append(data)

    def finish(self) -> list[Line]:
        self.close()
        self.end_line()
        return self.lines

    # --- the tree of numbered elements; an element's number is above its parent's

    def below(self, chosen) -> list[bool]:
        """Of each element whether it or one around it is ``chosen``, a test of a number."""
        out = [bool(chosen(0))]
        for number in range(1, len(self.parents)):
            out.append(out[self.parents[number]] or bool(chosen(number)))
        return out

    def sums(self, lines: list[Line], values) -> list[float]:
        """The sum over the lines in each element."""
        out = [0.0] * len(self.parents)
        for (_, _, number), value in zip(lines, values):
            out[number] += value
        for number in range(len(out) - 1, 0, -1):
            out[self.parents[number]] += out[number]
        return out


def smoothed(values: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights inside count."""
    reach = max(1, int(3 * spread))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / spread) ** 2)
    inside = np.convolve(np.ones(len(values)), weights, "full")[reach : reach + len(values)]
    return np.convolve(values, weights, "full")[reach : reach + len(values)] / inside


def _ratios(lines: list[Line]) -> tuple[np.ndarray, np.ndarray]:
    """Length and smoothed ratio of each line."""
    sizes = np.fromiter((len(text) for text, _, _ in lines), float, len(lines))
    return sizes, smoothed(sizes / np.fromiter((n for _, n, _ in lines), float, len(lines)))


def left_out(parser: Lines, lines: list[Line]) -> set[int]:
    """Doubtful elements without the page's only article, main or h1 and without most of its text of high ratio."""
    out = set(parser.doubtful)
    within = parser.below(parser.doubtful.__contains__)
    marked = False
    for kinds in (MAIN, frozenset(["h1"])):
        # the outermost and the innermost element of these kinds around each element, 0 for none
        first, last = [0], [0]
        for number in range(1, len(parser.parents)):
            parent, own = parser.parents[number], number if parser.kinds[number] in kinds else 0
            first.append(first[parent] or own)
            last.append(own or last[parent])
        held = {number for _, _, number in lines if first[number]}
        outside = any(not within[parser.parents[first[number]]] for number in held)
        marked |= outside and kinds is MAIN
        seen: set[int] = set()
        for number in () if outside else held:
            above = parser.parents[last[number]]
            while above and above not in seen:
                seen.add(above)
                above = parser.parents[above]
        out -= seen
    if not marked:
        sizes, ratios = _ratios(lines)
        high = ratios >= (sizes * ratios).sum() / sizes.sum() * (1 - 1e-9)
        held_text = parser.sums(lines, sizes * high)
        out -= {n for n in out if 2 * held_text[n] > held_text[0] and parser.kinds[n] not in LINKS}
    return out


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    lines = parser.finish()
    if parser.doubtful and lines:
        gone = parser.below(left_out(parser, lines).__contains__)
        lines = [line for line in lines if not gone[line[2]]]
    if not lines:
        return ""
    sizes, ratios = _ratios(lines)
    content = ratios >= SHARE * ratios.mean()
    held = parser.sums(lines, sizes * content)
    # an article or main element with more than half of the content, the deepest one, and other articles
    # with content
    regions = [n for n, size in enumerate(held) if 2 * size > held[0] and parser.kinds[n] in MAIN]
    if regions:
        kept = {max(regions)} | {n for n, size in enumerate(held) if size and parser.kinds[n] == "article"}
        inside = parser.below(kept.__contains__)
        return "\n\n".join(text for text, _, number in lines if inside[number])
    # or else the deepest section with nearly all of the content and an h1 if there is one, and all other content
    in_title = parser.below(lambda n: parser.kinds[n] == "h1")
    titled = parser.sums(lines, [in_title[number] for _, _, number in lines])
    large = [n for n, size in enumerate(held) if size >= NEARLY * held[0] and parser.kinds[n] not in ("h1", "blockquote")]
    region = max(n for n in large if not titled[0] or titled[n])
    inside = parser.below(lambda n: n == region)
    return "\n\n".join(text for (text, _, number), chosen in zip(lines, content) if chosen or inside[number])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py()) for html in batch["html"]]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per page: page_id, url, text and n_chars, its length in characters."""
    columns = ((id_column, "page_id", "long"), (url_column, "url", "string"), (html_column, "html", "string"))
    return pages.select(*(F.col(c).cast(kind).alias(name) for c, name, kind in columns)).mapInArrow(
        X.tidy(_texts), "page_id long, url string, text string, n_chars long"
    )
