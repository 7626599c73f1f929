"""Main text of web pages by the distribution of line blocks.

Markup is stripped into lines, one per block element. Each line weighs as much text
as it can hold of an article: nothing in menus, headers, footers, side bars,
notices, adverts, forms and comments, and, where the page marks its article,
nothing outside it. Weights are summed over a sliding window of lines; main text
begins where the sum surges and ends where it has dived to nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import ship_package

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
#: Elements without text of the page; the first two run to its end if they are not closed.
_RAW = {
    tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE)
    for tag in "script style title noscript template svg math iframe object canvas textarea select".split()
}
_TO_THE_END = frozenset(("script", "style"))
_SELF_CLOSED = re.compile(r"(?:^|[\s\"']|(?:^|\s)[^\s=]+)/\s*\Z")
#: Elements that end a line of text where they begin and end.
_BLOCK = frozenset(
    "address article aside blockquote body br button caption dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that are closed by their own tag only; the others end with their line.
_CONTAINER = frozenset(
    "a article aside body blockquote button dialog details div dl fieldset figure footer form header html label main menu nav ol"
    " section span table tbody tr ul".split()
)
_NOT_TEXT = frozenset("aside button dialog footer form menu nav".split())
_ARTICLE = frozenset(("article", "main"))
#: Elements whose name and attributes say nothing about their text.
_NEVER = frozenset("html body main article".split())
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
#: Class, id or role names of what is not the article.
_OTHER = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar side footer masthead cookie cookies consent notice notices alert popup modal newsletter subscribe signup"
    " login search share sharing social related recommended comment comments respond reply replies disqus pagination pager toolbar"
    " widget complementary contentinfo skip".split()
)
#: Words that say nothing beside those: a name of several words must have no others.
_NEUTRAL = frozenset(
    "area articles bar block bottom box button buttons container content form global icons inner item items left link links list lists main"
    " page post posts primary right secondary section sections site sub text top wrap wrapper".split()
)
#: Words that say it as the first or last of any name, but for one that says what a page has or lacks.
_EDGES = frozenset("ad ads advert adverts advertisement advertising nav navbar navigation menu breadcrumb breadcrumbs".split())
_ABOUT = frozenset("has no with without is not".split())


@dataclass(frozen=True)
class BlockRules:
    window: int = 3  # lines summed
    surge: int = 86  # weight a window needs to begin text
    marked: int = 86  # weight a line gains in a marked article, and loses beside it
    link_cost: float = 2.0  # weight lost per linked character, but in a marked article
    menu_share: float = 0.8  # linked characters per character from which a line is a menu's, and ends text


def _names_other(name: str, in_article: bool) -> bool:
    parts = [x for x in re.split(r"[^a-z]+", name) if x]
    other = [x for x in parts if x in _OTHER or x == "header" and not in_article]
    if not other or not _ABOUT.isdisjoint(parts):
        return False
    return parts[0] in _EDGES or parts[-1] in _EDGES or all(x in other or x in _NEUTRAL for x in parts)


def _other(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is not the article by its tag, its names or as hidden."""
    if tag in _NEVER:
        return False
    if tag in _NOT_TEXT or (tag == "header" and not in_article):
        return True
    if not attrs:
        return False
    for m in _ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" and value != "false" or name == "style" and _NO_DISPLAY.search(value):
            return True
        # The id of a heading or another line is an anchor made of its words.
        if name in ("class", "role") or name == "id" and tag in _CONTAINER:
            if any(_names_other(x, in_article) for x in value.split()):
                return True
    return False


def page_lines(page: str) -> tuple[list[tuple[str, int, bool]], bool]:
    """(text, linked characters, in the article) of each line; whether an article is marked.

    Lines of other elements are there with an empty text, so they count as a gap. An
    element that holds more than half of the page's text is not judged, but by its
    tag if that is a menu's, footer's or dialog's.
    """
    found: list[tuple[str, int, int, tuple[int, ...]]] = []  # text, linked, open articles, open judged elements
    buffer: list[str] = []
    linked = articles = links = 0
    judged: list[bool] = []  # of each judged element: whether it may be the article by its share
    opened: list[int] = []  # the judged elements that are open
    stack: list[tuple[str, bool]] = []  # tag, whether it is judged
    passing = -1  # a judged line element, which ends with its line

    def end_line() -> None:
        nonlocal linked, passing
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                found.append((text, linked, articles, (*opened, passing) if passing >= 0 else tuple(opened)))
            buffer.clear()
        linked, passing = 0, -1

    at, unclosed = 0, set()
    while m := _TOKEN.match(page, at):
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m[0].startswith("<!") or m[0].startswith("<?"):
                if m["cdata"]:
                    buffer.append(html.escape(m["cdata"], quote=False))
                continue
            buffer.append(m[0])
            if links:
                linked += len(m[0])
            continue
        tag, attrs = tag.lower(), m["attrs"] or ""
        if tag in _RAW:
            if not m["close"] and tag not in unclosed and not _SELF_CLOSED.search(attrs):
                if end := _RAW[tag].search(page, at):
                    at = end.end()
                elif tag in _TO_THE_END:
                    break
                else:
                    unclosed.add(tag)
            continue
        if tag in _BLOCK:
            end_line()
        if m["close"]:
            if any(t == tag for t, _ in stack):
                while stack:
                    t, bad = stack.pop()
                    if bad:
                        opened.pop()
                    articles -= t in _ARTICLE
                    links -= t == "a"
                    if t == tag:
                        break
            continue
        if tag in _VOID or attrs.rstrip().endswith("/") and tag not in _CONTAINER:
            continue
        bad = _other(tag, attrs, articles > 0)
        if bad:
            judged.append(tag not in _NOT_TEXT or tag == "form")
        if tag in _CONTAINER:
            stack.append((tag, bad))
            if bad:
                opened.append(len(judged) - 1)
            articles += tag in _ARTICLE
            links += tag == "a"
        elif bad:
            passing = len(judged) - 1
    end_line()

    total, held = 0, [0] * len(judged)
    for text, _, _, inside in found:
        total += len(text)
        for i in inside:
            held[i] += len(text)
    other = {i for i, size in enumerate(held) if not judged[i] or 2 * size <= total}
    lines = [(text if other.isdisjoint(inside) else "", linked, articles > 0) for text, linked, articles, inside in found]
    return lines, any(text and inside for text, _, inside in lines)


def line_weights(lines: list[tuple[str, int, bool]], rules: BlockRules) -> tuple[list[int], list[int]]:
    """Weights by which lines begin the text, and by which they let it last.

    A mark on more of the page than lies beside it weighs for its lines and against the
    others; it does not decide alone. Without one, a line with more than a few words
    of its own does not end the text, however many are linked.
    """
    plain = [max(0, int(len(text) - rules.link_cost * linked)) for text, linked, _ in lines]
    inside = sum(len(text) for text, _, article in lines if article)
    if inside and inside >= sum(w for w, (_, _, article) in zip(plain, lines, strict=True) if not article):
        weights = [
            (len(text) + rules.marked if text else 0) if article else max(0, weight - rules.marked)
            for weight, (text, _, article) in zip(plain, lines, strict=True)
        ]
        return weights, weights
    return plain, [len(text) if linked < rules.menu_share * len(text) else 0 for text, linked, _ in lines]


def surge_and_dive(weights: list[int], lasting: list[int], rules: BlockRules) -> list[tuple[int, int]]:
    """The runs of lines (first, after the last) that are text.

    A run begins with a line of weight whose window sums up to a surge, and lasts until
    the window from a line on has dived to nothing. On a page whose windows are all
    short of a surge, any weight begins it.
    """
    sums, ahead = _window_sums(weights, rules.window), _window_sums(lasting, rules.window)
    need = rules.surge if sums and max(sums) >= rules.surge else 1
    runs, i, n = [], 0, len(weights)
    while i < n:
        if sums[i] < need or not weights[i]:
            i += 1
            continue
        first = i
        while i < n and ahead[i]:
            i += 1
        if i > first:
            runs.append((first, i))
        else:
            i += 1
    return runs


def main_text(page: str, rules: BlockRules = BlockRules()) -> str:
    """The main text, one line per block; empty if there is none."""
    lines = page_lines(page)[0]
    weights, lasting = line_weights(lines, rules)
    kept = [i for first, end in surge_and_dive(weights, lasting, rules) for i in range(first, end)]
    # Beside a marked article, a line without weight is no text even where a window reaches over it.
    return "\n".join(lines[i][0] for i in kept if lines[i][0] and (weights[i] or weights is not lasting))


def _window_sums(weights: list[int], k: int) -> list[int]:
    """The sum of the window of ``k`` lines that begins at each line."""
    total, sums = sum(weights[:k]), []
    for i, weight in enumerate(weights):
        sums.append(total)
        total += (weights[i + k] if i + k < len(weights) else 0) - weight
    return sums


def extract_pages(
    pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", rules: BlockRules = BlockRules()
) -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` (code points) of every row.

    A null, empty or textless page has the empty text. Rows are kept one for one,
    repeated ones too; other columns are left out; an empty table gives no rows.
    Whole pages are read, whatever their length; nothing is shuffled.
    """
    ship_package(pages.sparkSession)
    narrow = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.coalesce(F.col(page), F.lit("")).alias("_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(p, rules) for p in part.column(2).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["_key", "_url", "text", "n_chars"])

    kinds = [narrow.schema[c].dataType.simpleString() for c in ("_key", "_url")]
    found = narrow.mapInArrow(run, f"_key {kinds[0]}, _url {kinds[1]}, text string, n_chars long")
    return found.withColumnsRenamed({"_key": key, "_url": url})
