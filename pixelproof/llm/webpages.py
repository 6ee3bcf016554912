"""Main text of web pages by the distribution of text over line blocks.

A page's markup is stripped into lines, one for each block of the layout; lines that belong to menus,
notices and the like by their element hold no text. The lengths of lines are summed over sliding
windows. Where the sum surges above the threshold a region starts, where it dives to nothing the region
ends, and the text between is kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements that start a line, elements without an end, elements that never hold article text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav noscript ol option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "aside button canvas dialog footer form head iframe input menu nav noscript object option script select style svg "
    "template textarea title".split()
)
# Words that mark an element as not of the article, when they are a part of its class, id or role.
MARKS = frozenset(
    "ad ads adv advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright discussion disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination paywall popup privacy promo promoted promotion "
    "related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar "
    "widget".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
CLOSED_BY = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}}


@dataclass
class Line:
    text: str
    inside: int  # the number of the outermost article or main element it stands in; 0: none
    length: int  # characters that aren't link text


#: What an article or main element cannot lie in, so that it ends what it is found in: a form around the whole page,
#: or an element that was never closed.
ENDED_BY = {"main": ("form", "nav", "header", "aside"), "article": ("form", "nav", "header")}


def marked(parts: list[str], inside: int) -> bool:
    """Whether a name such as ``site-footer`` or ``adBox`` marks; ``has-sidebar`` speaks of something else.

    Inside an article a header is the article's own: ``entry-header`` holds its headline.
    """
    ends = {p for p in (parts[0], parts[-1]) if not (inside and p == "header")} if parts else set()
    return bool(parts) and parts[0] not in ("has", "with", "no", "without") and not MARKS.isdisjoint(ends)


class Lines(HTMLParser):
    """The lines of a page. Every open element is known, so what stands in a dropped element adds nothing."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.words: list[str] = []
        self.length = 0
        self.inside = 0  # of the line at hand: where the first of its text stands
        self.articles = 0  # outermost article and main elements so far
        self.open: list[tuple[str, str, int]] = []  # name, the element that drops it or none, inside
        self.times: Counter[str] = Counter()  # how often each name is open

    def end_line(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.lines.append(Line(text, self.inside, self.length))
        self.words, self.length, self.inside = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        while self.open and tag in CLOSED_BY.get(self.open[-1][0], ()):
            self.cut(len(self.open) - 1)
        if tag == "body":
            self.close("head")
        if tag == "br":
            self.words.append(" ")
        if tag in VOID:
            return
        _, dropped, inside = self.open[-1] if self.open else ("", "", 0)
        if dropped in ENDED_BY.get(tag, ()):
            dropped = ""
        if not dropped and self.is_dropped(tag, dict(attrs), inside):
            dropped = tag if tag in DROPPED or tag == "header" else "marked"
        self.times[tag] += 1
        if not inside and tag in ("article", "main"):
            self.articles += 1
            inside = self.articles
        self.open.append((tag, dropped, inside))

    @staticmethod
    def is_dropped(tag: str, attrs: dict[str, str | None], inside: int) -> bool:
        if tag in DROPPED or tag == "header" and not inside or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        if tag in ("html", "body", "main"):
            return False
        if (attrs.get("role") or "").lower() in ROLES or "display:none" in (attrs.get("style") or "").replace(" ", ""):
            return True
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
        return any(marked([part.lower() for part in PART.findall(name)], inside) for name in names)

    def cut(self, at: int) -> None:
        """Close the elements from ``at`` on."""
        self.times.subtract(name for name, *_ in self.open[at:])
        del self.open[at:]

    def close(self, tag: str) -> None:
        """Close the innermost element of a name, if there is one, and those in it: each is looked at once."""
        if self.times[tag] > 0:
            at = len(self.open) - 1
            while self.open[at][0] != tag:
                at -= 1
            self.cut(at)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.close(tag)

    def handle_data(self, data: str) -> None:
        _, dropped, inside = self.open[-1] if self.open else ("", "", 0)
        if dropped:
            return
        self.words.append(data)
        if not data.isspace():
            self.inside = self.inside or inside
        if not self.times["a"]:
            self.length += len(data.strip())


def lines_of(page: str) -> list[Line]:
    parser = Lines()
    try:
        parser.feed(page)
        HTMLParser.close(parser)
    except (AssertionError, ValueError):  # a declaration that the parser gives up on: what came before it stands
        pass
    parser.end_line()
    return parser.lines


@dataclass(frozen=True)
class Settings:
    window: int = 3  # lines
    surge: int = 40  # characters in a window that start a region


def kept(lengths: np.ndarray, settings: Settings) -> np.ndarray:
    """Which lines stand between the surges and dives of the sums over sliding windows.

    Sums rise from nothing and dive to nothing when a whole window has no text. Between those points the text
    stays if some window surges past the threshold. A page where none does is one of little text: all stays.
    """
    n, w = len(lengths), settings.window
    sums = np.convolve(lengths, np.ones(w, np.int64))[w - 1 :] if n else lengths  # sums[i]: lines i to i + w - 1
    edges = np.flatnonzero(np.diff(np.concatenate([[0], sums > 0, [0]])))
    out = np.zeros(n, bool)
    for start, end in edges.reshape(-1, 2):
        if sums[start:end].max() >= settings.surge:
            out[start + int(np.argmax(lengths[start:end] > 0)) : end] = True
    return out if out.any() else np.ones(n, bool)


def main_text(page: str | None, settings: Settings | None = None) -> str:
    """The blocks kept, joined by line feeds; null, empty and text-free pages give an empty text.

    Where the page marks articles, those that hold a line between surge and dive are taken whole: the windows find
    the element, and its ends are the ends of the text. Link text is text there: it says nothing against a headline
    or a list.
    """
    lines = lines_of(page or "")
    lengths = [len(x.text) if x.inside else x.length for x in lines]
    keep = kept(np.array(lengths, np.int64), settings or Settings())
    marks = any(x.inside for x in lines)
    found = {x.inside for x, k in zip(lines, keep, strict=True) if k and x.inside}
    if marks and not found:  # text surges outside of them only: they are what the page says it is about
        keep = kept(np.array([n if x.inside else 0 for n, x in zip(lengths, lines, strict=True)], np.int64), settings or Settings())
        found = {x.inside for x, k in zip(lines, keep, strict=True) if k and x.inside}
    return "\n".join(x.text for x, k in zip(lines, keep, strict=True) if (x.inside in found if marks else k))


@F.pandas_udf(StringType())
def extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The main text of a column of pages."""
    for batch in pages:
        yield pd.Series([main_text(x) for x in batch], dtype=object)
