"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one per block of text, with an empty line for every
further block boundary. The lengths of a few neighbouring lines are summed in a
sliding window. Where the sums leave zero is a surge point, where they return to
it a dive point; the lines between the two are kept if the sums rise high enough.

Link text weighs nothing, nor do elements that name themselves as something else
than the article. Where a page marks its article, only lines inside weigh.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.words import chunks

#: Lines of a window.
WINDOW = 3
#: Characters a window must reach between a surge and a dive, or a quarter of the
#: highest window where that is less.
LEAST_PEAK = 80

# Element names of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
_RAW = set("script style title textarea xmp iframe noembed noframes".split())
_DROPPED = set(
    "head script style noscript template title textarea iframe object svg canvas audio video map "
    "nav aside footer form button select dialog menu xmp noembed noframes".split()
)
_MAIN = {"article", "main"}
# Elements that end when the same begins again (or the other of the pair).
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
# Words in class, id or role that say what an element is.
_MARKS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside complementary widget "
    "footer contentinfo copyright disclaimer masthead topbar toolbar share sharing social related "
    "recommended comments comment commentlist reply replies respond disqus discussion pagination "
    "pager search dialog alert form".split()
)
# What a marked main part may be instead of the page's article.
_MAIN_MARKS = set("ad ads advert sponsored comment reply related teaser".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<rest>(?:[^<>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>",
    re.DOTALL,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_HIDDEN = re.compile(
    r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""",
    re.IGNORECASE,
)
_NEGATED = re.compile(r"(?:no|not|has|with|without|is)[-_]", re.IGNORECASE)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_MARKED = re.compile(r"<(?:article|main)[\s>]", re.IGNORECASE)


class Line(NamedTuple):
    text: str
    #: Characters that count for the distribution.
    weight: int
    in_main: bool


def _is_dropped(name: str, rest: str, in_main: bool, marks: bool) -> bool:
    """Whether an element is left out with all it holds."""
    # Inside the article a header holds its title.
    if name in _DROPPED or (name == "header" and not in_main):
        return True
    if not marks or not rest or name in ("body", "html") or name in _INLINE:
        return False
    if _HIDDEN.search(rest):
        return True
    words = [
        word
        for _, value in _NAMED.findall(rest)
        for word in value.strip("\"'").split()
        if not _NEGATED.match(word)
    ]
    if name in _MAIN:
        return any(word.lower() in _MAIN_MARKS for word in words)
    said = {part.lower() for word in words for part in _PART.findall(word)}
    return bool(said & _MARKS) or (not in_main and "header" in said)


def strip_markup(html: str, marks: bool = True) -> list[Line]:
    """The lines of a page: texts of blocks and, between blocks, empty lines.

    Without ``marks``, only an element's name can leave it out, not its class.
    """
    lines: list[Line] = []
    parts: list[str] = []
    linked = main = dropped = 0
    open_elements: list[tuple[str, bool]] = []  # name, whether it is dropped
    opened: Counter[str] = Counter()
    at = 0

    def end_line() -> None:
        nonlocal parts, linked
        text = " ".join(unescape("".join(parts)).split())
        mostly_links = not main and 2 * linked > len(text)
        lines.append(Line(text, 0 if mostly_links else len(text), main > 0))
        parts, linked = [], 0

    def close(count: int) -> None:
        nonlocal main, dropped
        for _ in range(count):
            name, gone = open_elements.pop()
            opened[name] -= 1
            dropped -= gone
            main -= name in _MAIN and not gone

    def say(text: str) -> None:
        nonlocal linked
        if dropped or not text:
            return
        parts.append(text)
        if opened["a"]:
            linked += len(" ".join(unescape(text).split()))

    while at < len(html):
        found = _TOKEN.search(html, at)
        if found is None:
            break
        say(html[at : found.start()])
        at = found.end()
        if found["name"] is None:
            continue
        name = found["name"].lower()
        if found["end"]:
            if name not in _INLINE and not dropped:
                end_line()
            if opened[name]:
                close(next(i for i, (n, _) in enumerate(reversed(open_elements), 1) if n == name))
            continue
        if name == "br":
            say(" ")
            continue
        if name == "body" and open_elements and open_elements[-1][0] == "head":
            close(1)
        gone = _is_dropped(name, found["rest"], main > 0, marks)
        # What is left out ends a line but makes no gap.
        if name not in _INLINE and not dropped and (parts or not gone):
            end_line()
        if open_elements and open_elements[-1][0] in _SIBLINGS.get(name, ()):
            close(1)
        if name in _VOID or found["rest"].endswith("/"):
            continue
        if name in _RAW:
            # Nothing is markup in there but its own end.
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, at)
            at = stop.start() if stop else len(html)
        open_elements.append((name, gone))
        opened[name] += 1
        dropped += gone
        main += name in _MAIN and not gone
    say(html[at:])
    end_line()
    return lines


def _weighted(html: str) -> list[Line]:
    """Lines as the distribution sees them.

    Where a page marks its main part, the lines elsewhere are empty, and within
    it boundaries between blocks leave no gap. If class names left out all of
    the main part, or of the page, they are not believed.
    """
    marked = _MARKED.search(html) is not None

    def is_main(line: Line) -> bool:
        return line.weight > 0 and line.in_main >= marked

    lines = strip_markup(html)
    if not any(map(is_main, lines)):
        lines = strip_markup(html, marks=False)
    if not marked or not any(map(is_main, lines)):
        return lines
    outside = Line("", 0, False)
    return [line if line.in_main else outside for line in lines if line.text or not line.in_main]


def text_runs(weights: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, highest window sum) of each stretch of windows above zero.

    A window begins at its line; surge is the first line with a weight, dive
    follows the last.
    """
    runs = []
    surge = peak = 0
    last = -window
    recent: deque[int] = deque(maxlen=window)
    for at, weight in enumerate(weights):
        if weight and at - last > window:
            if peak:
                runs.append((surge, last + 1, peak))
            surge, peak = at, 0
        if weight:
            last = at
        recent.append(weight)
        peak = max(peak, sum(recent))
    if peak:
        runs.append((surge, last + 1, peak))
    return runs


def main_text(html: str | None, window: int = WINDOW, least_peak: int = LEAST_PEAK) -> str:
    """The main text of a page, its blocks joined by line feeds."""
    lines = _weighted(html or "")
    runs = text_runs([line.weight for line in lines], window)
    enough = min(least_peak, max((peak for _, _, peak in runs), default=0) / 4)
    kept = [
        line.text
        for surge, dive, peak in runs
        if peak >= enough or lines[surge].in_main
        for line in lines[surge:dive]
        if line.text
    ]
    return "\n".join(kept)


def extract_text(
    pages: DataFrame, window: int = WINDOW, least_peak: int = LEAST_PEAK
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null or empty html gives the empty text, as does a page without text.
    Repeated rows are extracted each for itself; page_id and url are returned as
    they are, null or not. An empty table gives an empty result. A page is read
    whole, in one pass over its markup. Only the three columns are read, so
    others cannot clash. Runs with equal peaks are kept or left alike.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, "html")):
            texts = [main_text(html, window, least_peak) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema}
    out = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(extract, out)
