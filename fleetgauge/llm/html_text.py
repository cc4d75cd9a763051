"""Main text of web pages by line-block distribution.

1. Strip: markup goes, and with it elements that never hold the article (scripts, styles, menus, headers, footers,
   sidebars, forms, notices, adverts, comment sections), by tag, role, or a name in their class or id.  What is left is a
   list of lines, one per block of running text.
2. Distribute: a line's height is the sum of the text lengths over a window of lines around it, links not counted.
   Several lines in a row that are nothing but links are a menu and go; headings and single such lines stay.  Lines
   that stand inside ``article`` or ``main`` carry the page's own statement that they are text: if there are any, only they
   can be chosen, and a line's window ends where its group does.
3. Surge and dive: the text begins where the height rises above the threshold and ends where it falls below it, low
   lines between included.  It grows at both ends over the lines of the containers that hold its high lines, so
   headings and one-word paragraphs at its edges stay.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import batches, columns, table

# Fixed values of the markup language: elements without content, elements whose content is not markup, blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math select object canvas".split())
BLOCK = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr
ul""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Elements that hold lines together.  Inside article and main, sections and cells are parts of the one text.
GROUPS, OUTER_GROUPS = set("div center".split()), set("div center section article main td th".split())
# Elements that are no part of an article, wherever they stand.
ASIDE = set("nav footer aside form button label menu dialog head".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar form alertdialog".split())
# A p or li that opens while another is open closes it.
CLOSES = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
          "th": {"td", "th", "tr"}, "option": {"option"}}
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|comment|comments|"
    r"consent|cookie|cookies|copyright|disqus|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|"
    r"notice|notices|overlay|pager|pagination|popup|promo|promoted|promotion|recommended|related|replies|respond|share|sharing|"
    r"sidebar|sidenav|social|sponsor|sponsored|subscribe|subscription|toolbar|topbar|widget)(?=$|[\s_-])", re.I)
# Inside article and main only names that are no words of an article count by their parts, the others as whole classes.
_SURE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|breadcrumb|breadcrumbs|disqus|gdpr|navbar|newsletter|"
    r"pager|pagination|popup|promo|promoted|sidebar|sidenav|sponsored|topbar)(?=$|[\s_-])", re.I)
_WHOLE = set("""banner comment comments consent cookie cookies copyright footer menu modal nav navigation notice notices overlay
promotion recommended related replies respond share sharing social sponsor subscribe subscription toolbar widget""".split())
# Words that no section of an article is named after, and names of boxes about an article.
_COMMENTS = set("comment comments cookie cookies consent modal overlay replies respond toolbar widget".split())
_BOX = re.compile(
    r"(?:^|[\s_-])(?:comments?|replies|consent|cookies?|copyright|notices?|related|recommended|share|sharing|social|sponsor|subscribe|"
    r"subscription)[_-](?:area|bar|banner|block|box|buttons?|container|form|icons|links|list|panel|popup|thread|widget|wrap|"
    r"wrapper)(?=$|[\s_-])|(?:^|\s)(?:page|reader|site|user)[_-](?:comments?|notices?|replies)(?=$|[\s_-])|"
    r"(?:^|\s)(?:cookies?|consent|privacy)[_-](?:notice|message|hint|info|policy|settings|warning)(?=$|[\s_-])", re.I)
PHRASES = set("a abbr b bdi bdo cite code dfn em i kbd mark q s samp small span strong sub sup time u var".split())
_OTHERS = re.compile(r"(?:^|[\s_-])(?:ad|advert|comment|promo|promoted|recommended|related|reply|sponsored|teaser)(?=$|[\s_-])", re.I)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|"
                  r"<(/?)([a-zA-Z][^\s/>]*)[^<>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WINDOW, THRESHOLD = 3, 60


def _named(tag: str, name: str, value: str, inside: bool) -> bool:
    """Whether a class or id tells that an element is no part of the article."""
    if tag in ("body", "html", "article", "main"):
        return False
    if not inside:
        return _NAMES.search(value) is not None
    # Headings and their sections are named after their words.
    if tag in HEADINGS or tag == "header" or name == "id" and tag == "section":
        return False
    if name == "class":
        if _SURE.search(value) or tag not in PHRASES and _BOX.search(value):
            return True
        # A section of an article may have such a word as its subject, beside other words.
        classes = set(value.split())
        return not classes.isdisjoint(_COMMENTS) or classes != set() and classes <= _WHOLE if tag == "section" else (
            tag not in PHRASES and not classes.isdisjoint(_WHOLE))
    return value in ("comments", "disqus_thread") or _SURE.fullmatch(value) is not None or (
        tag == "div" and _BOX.fullmatch(value) is not None)


def _unwanted(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of the article."""
    if tag in ASIDE or tag == "header" and not inside:
        return True
    if not attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name in ("class", "id"):
            if _named(tag, name, value, inside):
                return True
            if tag == "article" and _OTHERS.search(value):  # comments and teasers may be articles of their own
                return True
        elif name == "role":
            if value in ROLES:
                return True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


class Line(NamedTuple):
    """A block of running text."""

    text: str
    links: int  # length of its links, as in the text
    bare: bool  # nothing but links
    inside: bool  # stands inside article or main
    heading: str  # the heading's tag, else empty
    path: tuple[int, ...]  # the groups around it, outermost first


def lines(page: str) -> list[Line]:
    """The blocks of running text outside unwanted elements.  A group of a single line is that line's own block."""
    out: list[Line] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements; whether unwanted; whether a group
    path: list[int] = []
    parts: list[str] = []
    spans: list[tuple[int, int]] = []  # the parts within each link
    at = unwanted = inside = linked = groups = 0

    def folded(some: list[str]) -> str:
        return " ".join(references.unescape("".join(some)).split())

    def flush() -> None:
        text = folded(parts)
        if text:
            links = [folded(parts[start:end]) for start, end in spans]
            rest = "".join(folded(parts[end:start]) for (_, end), (start, _) in
                           zip([(0, 0), *spans], [*spans, (len(parts), 0)], strict=True)) if any(links) else text
            bare = any(links) and not any(c.isalnum() for c in rest)
            heading = next((tag for tag, _, _ in reversed(stack) if tag in HEADINGS), "")
            out.append(Line(text, min(len(text), sum(map(len, links))), bare, inside > 0, heading, tuple(path)))
        parts.clear()
        spans.clear()

    def pop() -> None:
        nonlocal unwanted, inside, linked
        tag, bad, group = stack[-1]
        if tag in BLOCK:
            flush()
        stack.pop()
        if group:
            path.pop()
        unwanted -= bad
        inside -= tag in ("article", "main")
        linked -= tag == "a"

    while at < len(page):
        found = _TAG.search(page, at)
        text = page[at:found.start() if found else len(page)]
        if text and not unwanted:
            parts.append(text)
            if linked and spans and spans[-1][1] == len(parts) - 1:
                spans[-1] = spans[-1][0], len(parts)
            elif linked:
                spans.append((len(parts) - 1, len(parts)))
        if not found:
            break
        at = found.end()
        close, tag, attributes = found[1], found[2], found[3] or ""
        if tag is None:
            if found[5] is None:  # a comment or declaration
                continue
            break  # the page ends within a tag
        tag = tag.lower()
        if close:
            if any(name == tag for name, _, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag in BLOCK and not unwanted:
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            if tag in ("br", "hr") and not unwanted:
                parts.append(" ")
                if tag == "hr":
                    flush()
            continue
        for depth in range(len(stack) - 1, -1, -1):
            name = stack[depth][0]
            if tag in CLOSES.get(name, ()):
                while len(stack) > depth:
                    pop()
                break
            if name in BLOCK and name not in ("p",):
                break
        if tag in BLOCK:
            flush()
        bad, group = _unwanted(tag, attributes, inside > 0), tag in (GROUPS if inside else OUTER_GROUPS)
        stack.append((tag, bad, group))
        if group:
            groups += 1
            path.append(groups)
        unwanted += bad
        inside += tag in ("article", "main")
        linked += tag == "a"
    while stack:
        pop()
    flush()
    held = Counter(group for line in out for group in line.path)
    return [line._replace(path=tuple(group for group in line.path if held[group] > 1)) for line in out]


def _menus(found: list[Line]) -> list[bool]:
    """Whether each line is one of several in a row that are nothing but links.  Headings are none."""
    links = [line.bare and not line.heading for line in found]
    return [x and (i > 0 and links[i - 1] or i + 1 < len(links) and links[i + 1]) for i, x in enumerate(links)]


def main_text(page: str) -> str:
    """The lines between surge and dive, joined by an empty line."""
    found = lines(page)
    if not found:
        return ""
    container = any(line.inside for line in found)
    free = [not menu and (line.inside or not container) for line, menu in zip(found, _menus(found), strict=True)]
    own = [0 if container and not line.inside else len(line.text) - line.links for line in found]

    def heights(within: bool) -> list[int]:
        """Sums over the window; within: of lines in the line's own group only, nested groups included."""
        return [sum(own[j] for j in range(max(0, i - WINDOW // 2), min(len(own), i + WINDOW // 2 + 1))
                    if not within or found[j].path[:len(line.path)] == line.path) for i, line in enumerate(found)]

    firm = [h >= THRESHOLD and o > 0 and f for h, o, f in zip(heights(True), own, free, strict=True)]
    kept = firm if container else [h >= THRESHOLD and o > 0 and f for h, o, f in zip(heights(False), own, free, strict=True)]
    if any(kept):
        # Low lines belong to the text if their group holds high ones.  Inside article and main so do lines whose group
        # has such a group within and the page's title; elsewhere headings above such a group.
        same = {line.path for line, high in zip(found, firm, strict=True) if high}
        around = {path[:n] for path in same for n in range(0 if container else 1, len(path))}
        kept = [f and (k or line.path in same and (container or not line.bare or line.heading != "")
                       or (container or line.heading != "") and line.path in around
                       or container and line.heading == "h1") for line, f, k in zip(found, free, kept, strict=True)]
        # From the first surge to the last dive, over low lines between.
        first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
        kept = [first <= i <= last and f for i, f in enumerate(free)]
    else:
        kept = free
    return "\n\n".join(line.text for line, k in zip(found, kept, strict=True) if k)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty pages and pages without text have an empty text.  Pages that break off keep what they have.
    Repeated rows are extracted each.  No rows give no rows.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def work(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for record in records:
            for page_id, url, page in columns(record, "page_id", "url", "html"):
                text = main_text(page)
                yield page_id, url, text, len(text)

    return rows.mapInArrow(lambda records: batches(_OUT, work(records), 2_000),
                           "page_id long, url string, text string, n_chars long")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
