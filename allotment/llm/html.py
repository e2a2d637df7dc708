"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of four languages, element names of HTML, and
# words that names of page furniture start with or consist of.
STOP_WORDS = frozenset(
    "the of and to in is that it for was on are with as be this by from at or an not have his they which you were "
    "le la les de du des et un une dans que qui est pas sur pour par avec au aux ce il elle ne se son plus "
    "der die das und ist in den von zu mit sich auf für nicht ein eine als auch es an werden aus er hat dass "
    "el los las y en del se con por para una su al lo como más pero sus este o fue ha".split()
)
HIDDEN = frozenset("head title script style noscript template textarea select option button svg math iframe object canvas audio video map".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
CONTAINERS = frozenset(
    "article main section div nav header footer aside form menu dialog ul ol dl table blockquote figure details fieldset".split()
)
BLOCKS = CONTAINERS | frozenset(
    "body p h1 h2 h3 h4 h5 h6 li dt dd tr caption thead tbody tfoot pre hr address figcaption summary center legend".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
# A class or id token is furniture if it is made of these words alone, one of NAMES among them.
NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner promo promotion cookie cookies consent gdpr notice notices popup modal "
                  "sidebar sidenav menu menus nav navbar navigation header footer masthead breadcrumb breadcrumbs share sharing social related "
                  "recommended widget widgets toolbar pagination pager login signup newsletter subscribe subscription sponsor sponsored sponsors "
                  "comment comments replies reply disqus hidden".split())
BESIDE = frozenset("site page main top bottom left right side box bar block list section area wrapper container inner outer form links link item items "
                   "body content text title global primary secondary sub js ui".split())
# Elements that may stand in the head; any other one begins the body.
HEAD = frozenset("head title base link meta style script noscript template".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.S,
)
_RAW = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in ("script", "style", "textarea", "title", "noscript", "iframe")}
_NAMED = re.compile(r"(?:^|[\s/\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I | re.S)
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^\W\d_][.!?](?:\s|\Z)")


@dataclass
class Rules:
    """Limits of the block rules, in characters or shares."""

    short: int = 70
    long: int = 200
    links: float = 0.5
    few_stops: float = 0.08
    many_stops: float = 0.2


@dataclass
class Block:
    text: str
    linked: int
    region: int  # number of the article or main element that holds it, 0 for none
    furniture: bool
    heading: bool
    named: int = 0  # number of the element whose class or id alone makes it furniture, 0 for none


def blocks(html: str) -> Iterator[Block]:
    """The page's text blocks in order, each with its share of links and where it stands."""
    parts: list[str] = []
    stack: list[tuple[str, int, bool, int]] = []  # open containers: name, region, furniture, which name makes it so
    linked, in_link, heading, regions, elements = 0, False, False, 0, 0
    hidden: str | None = None
    depth = 0

    def flush() -> Iterator[Block]:
        nonlocal parts, linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                region, furniture, named = stack[-1][1:] if stack else (0, False, 0)
                yield Block(text, linked, region, furniture, heading, named)
        parts, linked = [], 0

    at = 0
    while at < len(html):
        tag = _TAG.search(html, at)
        start = tag.start() if tag else len(html)
        if start > at and hidden is None:
            parts.append(html[at:start])
            linked += (start - at) * in_link
        if tag is None:
            break
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if hidden == "head" and name not in HEAD and not tag["end"]:
            hidden = None
        if hidden is not None:
            depth += (name == hidden) * (-1 if tag["end"] else 1)
            if depth <= 0 or name in ("body", "article", "main"):
                hidden = None
            if name not in ("body", "article", "main"):
                continue
        if not tag["end"] and name in HIDDEN:
            raw = _RAW.get(name)
            if raw is not None:
                close = raw.search(html, at)
                at = close.start() if close else len(html)
            elif not tag["rest"].rstrip(">").endswith("/"):
                hidden, depth = name, 1
            continue
        if name == "a":
            in_link = not tag["end"]
        elif name == "br":
            parts.append(" ")
        elif name in ("td", "th"):
            parts.append(" ")
        elif name in BLOCKS:
            yield from flush()
            in_link = False
            heading = not tag["end"] and len(name) == 2 and name[0] == "h"
            if name in CONTAINERS:
                if not tag["end"]:
                    region, furniture, named = stack[-1][1:] if stack else (0, False, 0)
                    article = name in ("article", "main")
                    first = article and not _holds(stack, "article") and not _holds(stack, "main")
                    if article:
                        if first:  # an open menu ends where the article begins
                            furniture, named = False, 0
                        regions += 1
                        region = region if region and name == "article" and _holds(stack, "article") else regions
                    if not furniture and not first:
                        furniture = _is_furniture(name, tag["rest"], region)
                        if not furniture and _is_named(tag["rest"], region):
                            elements += 1
                            furniture, named = True, elements
                    stack.append((name, region, furniture, named))
                else:
                    depth_of = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
                    if depth_of is not None:
                        del stack[depth_of:]
    yield from flush()


def _holds(stack: list[tuple[str, int, bool, int]], name: str) -> bool:
    return any(entry[0] == name for entry in stack)


def _is_furniture(name: str, attributes: str, region: int) -> bool:
    """Whether an element is no part of an article by its name or role."""
    if name in FURNITURE or (name == "header" and not region):
        return True
    return any(
        kind.lower() == "role" and ROLES & set("".join(values).lower().split()) for kind, *values in _NAMED.findall(attributes)
    ) if "=" in attributes else False


def _is_named(attributes: str, region: int) -> bool:
    """Whether a whole token of an element's class or id names furniture."""
    if "=" not in attributes:
        return False
    for kind, *values in _NAMED.findall(attributes):
        if kind.lower() == "role":
            continue
        for token in unescape("".join(values)).split():
            words = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())) - {""}
            if words <= NAMES | BESIDE and words & NAMES and not (region and words & NAMES <= {"header"}):
                return True
    return False


def _without_false_names(page: list[Block]) -> list[Block]:
    """On a page without an article, an element that holds most of the text is no furniture for its class or id."""
    if any(b.region for b in page):
        return page
    sizes: dict[int, int] = {}
    for block in page:
        sizes[block.named] = sizes.get(block.named, 0) + len(block.text)
    most = {n for n, size in sizes.items() if n and size * 2 > sum(sizes.values())}
    return [replace(b, furniture=False, named=0) if b.named in most else b for b in page]


def _foreign(text: str) -> bool:
    """Whether most letters are of scripts that the stop words are not written in."""
    letters = [c for c in text if c.isalpha()]
    return sum(c > "\u024f" for c in letters) * 2 > len(letters)


def _first_pass(page: list[Block], rules: Rules) -> list[bool | None]:
    """True for text, False for furniture, None for blocks that are too short or mixed to tell."""
    regions = {b.region for b in page if b.region and not b.furniture}
    links = [min(b.linked / len(b.text), 1.0) for b in page]
    short_links = [bool(b.region) and not b.heading and share > rules.links and len(b.text) < rules.short for b, share in zip(page, links)]
    marks: list[bool | None] = []
    for k, block in enumerate(page):
        size = len(block.text)
        words = _WORD.findall(block.text.lower())
        stops = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
        if block.furniture or (regions and not block.region):
            marks.append(False)
        elif links[k] > rules.links:
            # In an article only runs of short linked blocks are lists of links.
            alone = not any(short_links[max(k - 1, 0) : k] + short_links[k + 1 : k + 2])
            marks.append(None if block.region and (not short_links[k] or alone) else False)
        elif size < rules.short or block.heading:
            marks.append(True if _foreign(block.text) and not block.heading and size * 2 >= rules.short else None)
        elif block.region or _foreign(block.text):
            marks.append(True)
        elif stops >= rules.many_stops or (size >= rules.long and stops >= rules.few_stops):
            marks.append(True)
        else:
            told = stops >= rules.few_stops or (size >= rules.long and _SENTENCE.search(block.text))
            marks.append(None if told else False)
    return marks


def _second_pass(page: list[Block], marks: list[bool | None]) -> list[bool]:
    """Undecided blocks take the mark of the nearest decided neighbour of their region.

    Furniture is no neighbour. Of two equally near ones that differ the later one counts:
    a heading goes with what follows. Without such a neighbour a block is text if it
    stands in an article, or if no block of the page is certain to be text.
    """
    decided: dict[int, list[int]] = {}
    certain = any(marks)
    for k, block in enumerate(page):
        if marks[k] is not None and not block.furniture:
            decided.setdefault(block.region, []).append(k)
    result, after = [], {region: 0 for region in decided}
    for k, block in enumerate(page):
        if marks[k] is not None:
            result.append(bool(marks[k]))
            continue
        near = decided.get(block.region)
        if not near:
            result.append(bool(block.region) or not certain)
            continue
        while after[block.region] < len(near) and near[after[block.region]] < k:
            after[block.region] += 1
        later = near[after[block.region]] if after[block.region] < len(near) else None
        earlier = near[after[block.region] - 1] if after[block.region] else None
        nearest = earlier if later is None or (earlier is not None and k - earlier < later - k) else later
        result.append(bool(marks[nearest]))
    return result


def main_text(html: str | None, rules: Rules = Rules()) -> str:
    """The article of a page, its blocks joined by line ends; empty if there is none."""
    page = _without_false_names(list(blocks(html or "")))
    kept = _second_pass(page, _first_pass(page, rules))
    return "\n".join(block.text for block, keep in zip(page, kept) if keep)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", rules: Rules = Rules()) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row of ``pages``.

    Pass one decides blocks by where they stand (menus, headers, footers, sidebars,
    notices, adverts, forms, comments, by element, role and whole tokens of class and id;
    articles) and by length, link density and stop-word density, scripts without listed stop
    words by length and links alone; short, mixed and heading blocks stay open, as do long
    ones with sentences of other languages. Pass two gives these the mark of the nearest
    decided neighbour. Inside an article only furniture and lists of links fall out. An
    article, or without one an element with most of the text, is no furniture by its class
    or id. Head and body need no tags. Character references are decoded,
    white space inside a block becomes one space, blocks are joined by one line end.
    A NULL or empty page and a page without text give an empty text. Unclosed tags,
    comments and elements end with the page; an article ends what was open before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py(), rules) for h in batch["html"]], pa.string())
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], texts], ["page_id", "url", "text"])

    slim = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    done = slim.mapInArrow(run, "page_id long, url string, text string")
    return done.withColumn("n_chars", F.length("text").cast("long"))
