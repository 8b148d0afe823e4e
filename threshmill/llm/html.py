"""Main text of web pages by line-block distribution (operator 1).

Markup is stripped to lines, one for each block of the page, in page order. The mass of a line is its text that is
no link and stands where an article may stand. Sums of mass over sliding windows of ``WINDOW`` lines rise at a surge
point and fall to nothing at a dive point; the lines between them are the text. One rule holds on every page: a surge
is a line with mass whose window reaches ``SURGE_CHARS``, or ``SURGE_SHARE`` of the fullest window if that is less.
Elements that cannot be article (menus, forms, scripts, adverts, notices, reader comments and the like, by their tag,
role, class or id) leave lines without mass, so the distribution dives there. Where the page marks an article or main
element, lines outside it have no mass, and a line in it that has text outside links weighs its whole text and ``MARKED``
characters more. The windows decide there as elsewhere, but a dive that the article rises from again is part of it. So a
run of ``WINDOW`` or more lines of links alone is left out as a whole before an article's text or after it, and stays as a
whole within. Shorter runs weigh as text does. A mark without text
outside links is none.

A class or id does not bar by words that say what an element has or lacks (``has-sidebar``), nor an element round the
main element. Where no article stands outside barred elements, those round the least deeply barred one are open too,
unless they hold other people's texts or there is more text outside than in it. Where a page has no text for a surge
but in elements barred by words alone, the one with the greatest mass is open, unless it holds comments or adverts.

A page is read once from begin to end, in time in proportion to its length whatever its markup.

Defined results: a null, empty or text-free page gives an empty text; a tag that does not end is none, and its angle
bracket begins text; a quote that does not end is a character like any other; repeated pages have equal texts; all other
columns of the input are kept, and those named ``text`` or ``n_chars`` are replaced; of an empty table no rows come.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared

WINDOW = 3
#: Characters in a window that make a surge, or share of the page's fullest window.
SURGE_CHARS, SURGE_SHARE = 80, 0.2
#: Characters that a line of a marked article weighs more if it has text outside links: a whole window of marks alone makes no surge.
MARKED = 26

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BARRED = frozenset("head nav aside footer form script style noscript template iframe object svg math canvas audio video button select textarea menu dialog option".split())
_RAW = frozenset("script style textarea title noscript iframe template xmp".split())
_BARRED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert status".split())
#: Words of class or id names (split at anything but letters) that bar an element.
_BARRED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations teaser widget pagination pager comment comments commentlist disqus respond reply replies skip copyright".split()
)
#: Of these words, those of elements that hold articles other than the page's own.
_OTHERS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted related recommended recommendations teaser widget comment comments commentlist disqus respond reply replies".split())
#: Of those, the words of texts that are never the page's own.
_NEVER = _OTHERS - frozenset("promo promotion promoted related recommended recommendations teaser widget".split())
#: A word after one of these tells of a part, not of the element.
_OF_PARTS = re.compile(r"\b(?:has|have|with|without|no)[\s_-]+[a-z]+(?![a-z])", re.I)
_CLOSED_BY = {"p": _BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_TO_TAG_END = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _barred(tag: str, attributes: str, within_article: bool) -> int:
    """0, or for a barred element why: 1 by what it is, 2 by a word, 3 by a word for articles other than the page's own, 4 by one for texts that never are."""
    if tag in _BARRED or tag == "header" and not within_article:
        return 1
    if not attributes:
        return 0
    found = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return 1
        if name == "role" and value.lower() in _BARRED_ROLES:
            return 1
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            words = {w for name in value.split() for w in _SPLIT.sub(" ", _OF_PARTS.sub(" ", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name)).lower()).split()}
            if not _NEVER.isdisjoint(words):
                found = 4
            elif not _OTHERS.isdisjoint(words):
                found = max(found, 3)
            elif not _BARRED_WORDS.isdisjoint(words):
                found = max(found, 2)
    return found


class _Page:
    """What one reading of a page found."""

    def __init__(self):
        #: (text, own characters outside links, is in an article, is in a main element) of each line; barred ones are empty.
        self.lines: list[tuple[str, int, int, int]] = []
        #: Of main elements and articles that only words bar, the places of the barred elements round them; articles
        #: among other people's texts are left out.
        self.mains: list[tuple[int, ...]] = []
        self.articles: list[tuple[int, ...]] = []
        #: Characters outside links in the outermost elements that only words bar, by place.
        self.barred_mass: dict[int, int] = {}

    def mass(self) -> int:
        return sum(n for _, n, *_ in self.lines)


def lines_of(html: str) -> list[tuple[str, int, int, int]]:
    """The page's lines, after opening what only words bar and the rest of the page speaks for."""
    page = _parsed(html, frozenset())
    articles = page.articles
    opened = frozenset(place for bars in page.mains for place in bars)
    if opened:
        page = _parsed(html, opened)
        articles = page.articles
    if articles and not any(n for _, n, article, main in page.lines if article or main):
        depth = min(map(len, articles))
        opened |= {place for bars in articles if len(bars) == depth for place in bars}
        wider = _parsed(html, opened)
        if sum(n for _, n, article, _ in wider.lines if article) >= page.mass():
            return wider.lines
    if page.barred_mass and page.mass() < SURGE_CHARS:
        place, mass = max(page.barred_mass.items(), key=lambda x: x[1])
        if mass >= SURGE_CHARS:
            return _parsed(html, opened | {place}).lines
    return page.lines


def _tags(html: str):
    """(text before, markup's place, tag or None, whether it closes, attributes, place after) of each piece of markup, and what follows the last.

    A generator that takes, by send, the place from where to go on.
    """
    size, at, begin = len(html), 0, 0
    gone = set()  # quotes and ends that do not come again
    while True:
        place = html.find("<", at)
        if place < 0:
            yield html[begin:], size, None, False, "", size
            return
        if html.startswith("<!--", place):
            end = html.find("-->", place + 4)
            tag, closes, attributes, after = None, False, "", size if end < 0 else end + 3
        elif html.startswith("<![CDATA[", place):
            end = html.find("]]>", place)
            tag, closes, attributes, after = "", False, html[place + 9 : size if end < 0 else end], size if end < 0 else end + 3
        elif html.startswith(("<!", "<?"), place):
            end = html.find(">", place)
            tag, closes, attributes, after = None, False, "", size if end < 0 else end + 1
        else:
            m = _TAG.match(html, place)
            after = m.end() if m else -1
            while m and ">" not in gone:
                after = _TO_TAG_END.match(html, after).end()
                if after == size:
                    gone.add(">")
                elif html[after] == ">":
                    break
                else:
                    quote = html[after]
                    end = -1 if quote in gone else html.find(quote, after + 1)
                    if end < 0:
                        gone.add(quote)
                    after = max(end, after) + 1
            if not m or ">" in gone:
                at = place + 1
                continue
            tag, closes, attributes, after = m[2].lower(), bool(m[1]), html[m.end() : after], after + 1
        at = begin = (yield html[begin:place], place, tag, closes, attributes, after) or after


def _parsed(html: str, opened: frozenset[int]) -> _Page:
    """Reads a page; words do not bar the elements at the places ``opened``."""
    page = _Page()
    lines = page.lines
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, int]] = []
    blocks: list[int] = []  # places in the stack of block elements
    open_tags: Counter[str] = Counter()
    places: list[tuple[int, int]] = []  # (place, kind) of the open barred elements
    kinds: Counter[int] = Counter()
    article = main = links = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join(unescape("".join(text)).split())
            lines.append((words, max(0, len(words) - linked), article, main))
            text.clear()
            linked = 0

    def leave() -> str:
        nonlocal article, main, links
        tag, bar = stack.pop()
        open_tags[tag] -= 1
        if blocks and blocks[-1] == len(stack):
            blocks.pop()
        if bar:
            kinds[places.pop()[1]] -= 1
        article -= tag == "article"
        main -= tag == "main"
        links -= tag == "a"
        return tag

    def say(piece: str) -> None:
        nonlocal linked
        if not piece:
            return
        if not places:
            text.append(piece)
            if links:
                linked += len(piece.strip())
        elif not kinds[1] and not kinds[4] and not links:
            page.barred_mass[places[0][0]] = page.barred_mass.get(places[0][0], 0) + len(piece.strip())

    tags = _tags(html)
    found = next(tags, None)
    while found is not None:
        before, place, tag, closes, attributes, after = found
        say(before)
        go_on = None
        if tag == "":  # character data
            say(attributes)
        elif tag is not None and not closes:
            if tag in _BLOCKS:
                flush()
                while stack and tag in _CLOSED_BY.get(stack[-1][0], ()):
                    leave()
                if blocks and blocks[-1] < len(stack) - 1 and tag in _CLOSED_BY.get(stack[blocks[-1]][0], ()):
                    depth = blocks[-1]  # open inline elements in an open paragraph
                    while len(stack) > depth:
                        leave()
            elif tag == "br":
                say(" ")
            if tag not in _VOID:
                if places and tag in ("article", "main") and not kinds[1]:
                    if tag == "main":
                        page.mains.append(tuple(p for p, _ in places))
                    elif not kinds[3] and not kinds[4]:
                        page.articles.append(tuple(p for p, _ in places))
                bar = _barred(tag, attributes, article > 0)
                if bar > 1 and place in opened:
                    bar = 0
                if bar and not places:
                    if tag not in _BLOCKS:
                        say(" ")
                    else:
                        lines.append(("", 0, article, main))
                if tag in _BLOCKS:
                    blocks.append(len(stack))
                stack.append((tag, bar))
                open_tags[tag] += 1
                if bar:
                    places.append((place, bar))
                    kinds[bar] += 1
                article += tag == "article"
                main += tag == "main"
                links += tag == "a"
                if tag in _RAW:
                    close = _RAW_END[tag].search(html, after)
                    if tag not in _BARRED and tag != "title":
                        say(html[after : close.start() if close else len(html)])
                    go_on = close.end() if close else len(html)
                    leave()
        elif tag is not None:
            if tag in _BLOCKS:
                flush()
            if open_tags[tag]:
                while leave() != tag:
                    pass
        try:
            found = tags.send(go_on)
        except StopIteration:
            found = None
    flush()
    return page


def main_lines(lines: list[tuple[str, int, int, int]]) -> list[int]:
    """Indices of the lines between surge and dive points."""
    articles, mains = (sum(n for _, n, *marks in lines if marks[i]) for i in (0, 1))
    mark = 2 if articles and articles * 2 >= mains else 3 if mains else None
    inside = [bool(line[0]) and (mark is None or bool(line[mark])) for line in lines]
    mass = [line[1] if here else 0 for line, here in zip(lines, inside)]
    if mark is not None:
        texts = [i for i, own in enumerate(mass) if own]
        for begin, end in zip([-1, *texts], [*texts, len(lines)]):  # runs of links between lines with text
            links = [i for i in range(begin + 1, end) if inside[i]]
            if len(links) < WINDOW:
                for i in links:
                    mass[i] = len(lines[i][0])
        mass = [len(line[0]) + MARKED if own else 0 for line, own in zip(lines, mass)]
    sums, total = [0] * len(mass), 0
    for i in range(len(mass) - 1, -1, -1):
        total += mass[i] - (mass[i + WINDOW] if i + WINDOW < len(mass) else 0)
        sums[i] = total
    least = min(SURGE_CHARS, SURGE_SHARE * max(sums, default=0))
    kept, i = [], 0
    while i < len(sums):
        if sums[i] > least and mass[i]:  # surge
            j = i
            while j < len(sums) and sums[j]:  # until the dive
                j += 1
            kept += [k for k in range(i, j) if inside[k]]
            i = j
        i += 1
    if mark is not None and kept:
        kept = [k for k in range(kept[0], kept[-1] + 1) if inside[k]]
    return kept


def extract(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    lines = lines_of(html)
    return "\n".join(lines[i][0] for i in main_lines(lines))


def with_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` (code points) to pages; a page at a time, without a shuffle."""
    shared.small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def run(html):
        return html.map(extract, na_action=None)

    return pages.withColumn("text", run(F.coalesce(F.col(html_col), F.lit("")))).withColumn("n_chars", F.length("text").cast("long"))


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the main text of all ``pages``."""
    return with_main_text(shared.table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
