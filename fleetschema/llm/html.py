"""Main text of web pages by consensus paths of hosts.

Each page's containers are scored by the prose they hold. A page votes with its
scores for generalised tag-class paths (digits and position left out); Spark
sums the votes by host and path, map-side first, and every page of the host is
then extracted anew from the container that the host's best path names. A page
that lacks the path is extracted from its own best container.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.llm.common import col, extended, free, map_batches
from fleetschema.staging import stage

# Fixed values of HTML: elements without content, and elements whose start or end parts blocks of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: text up to the end tag is no markup
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: never part of the main text
DROPPED = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript template nav aside footer form button select option "
    "input label fieldset dialog menu svg math canvas object embed audio video map search head".split()
)
#: may hold the main text
CONTAINER = frozenset("article main section div td body blockquote center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: an open element ends when one of these starts inside it
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
CLOSED_BY = {t: [k for k, v in CLOSES.items() if t in v] for t in frozenset().union(*CLOSES.values())}
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
#: whole words of class and id names that mark what is not the article
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay sidebar side aside rail menu menus nav "
    "navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar comment comments "
    "reply replies discussion disqus respond reviews share sharing social related recommended recommendations newsletter "
    "subscribe subscription signup login search widget widgets skip hidden sr".split()
)
#: words that go with a mark and leave it one, and words that make a name say something else
WITH_MARKS = frozenset(
    "area bar bars block body bottom box button buttons col column container content dropdown el element entry footer form "
    "group head header icon icons inner item items label left link links list main menu message meta navigation outer panel "
    "post posts right row section site slot small text title toggle top unit wide wrap wrapper".split()
)
NOT_MARKS = frozenset("has with without no not is".split())
#: containers inside so many others go by the path of the last one that is named
DEEPEST = 100
#: a block of an article's own header that is no heading is prose from this length on, else a byline or date
PROSE = 80

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    # nothing is given back, so a tag is read once; a quote without an end is a character
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


def _attributes(text: str) -> dict[str, str]:
    return {
        (m[1] or m[5]).lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)
    }


def _unwanted(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether an element is menu, advert, comment and the like. ``inside``: it stands in an article."""
    if tag in DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role", "").lower() in ROLES or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if tag == "header":
        return not inside
    return any(map(_marked, f"{attributes.get('class', '')} {attributes.get('id', '')}".split()))


def _marked(name: str) -> bool:
    """Whether a class or id names menu, advert and the like: its last word does, or its first with nothing of its own behind it."""
    words = [w.lower() for w in _WORD.findall(name)]
    if not words or NOT_MARKS & set(words):
        return False
    return words[-1] in MARKS or (words[0] in MARKS and all(w in MARKS or w in WITH_MARKS for w in words))


class Node:
    """An open or closed container: its path, the prose below it and the blocks between its tags."""

    __slots__ = ("path", "score", "first", "last")

    def __init__(self, path: str, first: int):
        self.path, self.first, self.last, self.score = path, first, first, 0.0


def parse(page: str) -> tuple[list[str], list[Node]]:
    """The page's text blocks, unwanted elements left out, and its containers in page order.

    A block is the text between two block-level tags; line breaks and other white
    space in it are one space. Broken markup is read on: end tags that match no
    open element count for nothing, elements that are never closed end with what
    holds them, unwanted ones too. Every character is read once.
    """
    blocks: list[str] = []
    nodes: list[Node] = []
    stack: list[tuple[str, str, Node | None, bool, bool]] = []  # tag, path, container, article or main around, left out
    open_nodes: list[Node] = []
    open_tags: Counter[str] = Counter()
    piece: list[str] = []
    linked = [0]  # characters inside links of the block that is being read
    hidden = headings = 0

    def flush() -> None:
        if piece:
            text = " ".join(html.unescape("".join(piece)).split())
            piece.clear()
            # of an article's own header the headings and prose stay
            if text and (not open_tags["header"] or headings or len(text) >= PROSE):
                blocks.append(text)
                prose = max(0, len(text) - 2 * linked[0])
                # long blocks with sentence signs are prose; each container gets half of what the one inside it gets
                worth = prose * (1.0 if len(text) > 80 else 0.5) + 10 * sum(text.count(s) for s in ".,;!?")
                for up, node in enumerate(reversed(open_nodes[-48:])):
                    node.score += worth * 0.5**up
        linked[0] = 0

    def close(down_to: int) -> None:
        nonlocal hidden, headings
        while len(stack) > down_to:
            tag, _, node, _, out = stack.pop()
            open_tags[tag] -= not out
            every_tag[tag] -= 1
            hidden -= out
            headings -= tag in HEADINGS and not out
            if node is not None:
                node.last = len(blocks)
                open_nodes.pop()

    every_tag: Counter[str] = Counter()  # those that are left out, too

    def text(s: str) -> None:
        piece.append(s)
        if open_tags["a"]:
            linked[0] += len(s)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            if not hidden:
                text(page[at:])
            break
        if m.start() > at and not hidden:
            text(page[at : m.start()])
        at = m.end()
        if m[2] is None:  # comment or declaration
            continue
        tag = m[2].lower()
        if m[1]:
            if (tag in BLOCK or tag == "p") and not hidden:
                flush()
            for k in range(len(stack) - 1, -1, -1) if every_tag[tag] else ():
                if stack[k][0] == tag:
                    close(k)
                    break
                if stack[k][0] in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html", "td", "th"):
                    break
            continue
        if tag == "br":
            if not hidden:
                piece.append(" ")
            continue
        if tag in BLOCK:
            if not hidden:
                flush()
            for k in range(len(stack) - 1, -1, -1) if every_tag["p"] else ():  # a block ends an open paragraph and what is open in it
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in BLOCK:
                    break
            for k in range(len(stack) - 1, -1, -1) if any(every_tag[t] for t in CLOSED_BY.get(tag, ())) else ():
                if tag in CLOSES.get(stack[k][0], ()):
                    close(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "main", "body"):
                    break
        if tag in VOID:
            continue
        if tag in RAW:
            at = _raw_end(page, tag, at)
            continue
        alone = m[3].rstrip().endswith("/")
        attributes = _attributes(m[3]) if m[3] and not hidden else {}
        inside = bool(stack) and stack[-1][3]
        up = stack[-1][1] if stack else ""
        every_tag[tag] += 1
        if hidden or _unwanted(tag, attributes, inside):
            if alone:
                every_tag[tag] -= 1
                continue
            hidden += 1
            stack.append((tag, up, None, inside, True))
            continue
        if alone and tag not in BLOCK:
            every_tag[tag] -= 1
            continue
        if tag in CONTAINER:
            classes = ".".join(sorted({_DIGITS.sub("", c) for c in attributes.get("class", "").split()} - {""}))
            path = f"{up}>{tag}.{classes}" if classes else f"{up}>{tag}"
            path = path if len(open_nodes) < DEEPEST else up
            node = Node(path, len(blocks))
            nodes.append(node)
            open_nodes.append(node)
        else:
            path, node = up, None
        open_tags[tag] += 1
        headings += tag in HEADINGS
        stack.append((tag, path, node, inside or tag in ("article", "main"), False))
    flush()
    close(0)
    return blocks, nodes


def _raw_end(page: str, tag: str, at: int) -> int:
    m = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
    return m.end() if m else len(page)


def votes(page: str | None) -> list[tuple[str, float]]:
    """(path, score) of the page's containers; a path's score is that of its best container, as a share of the page's best."""
    best: dict[str, float] = {}
    for node in parse(page)[1] if page else ():
        if node.score > best.get(node.path, 0.0):
            best[node.path] = node.score
    top = max(best.values(), default=0.0)
    # an article or main element says itself what it is
    said = {p: s / top + (1.0 if p.rsplit(">", 1)[-1].split(".")[0] in ("article", "main") else 0.0) for p, s in best.items()}
    return sorted(said.items())


def main_text(page: str | None, path: str | None) -> str:
    """The blocks of the best container on ``path``, or else of the page's own best, joined by empty lines."""
    if not page:
        return ""
    blocks, nodes = parse(page)
    filled = [n for n in nodes if n.last > n.first]
    chosen = [n for n in filled if n.path == path]
    if not chosen:
        own = {p: s for p, s in votes(page)}
        top = max(own.values(), default=None)
        chosen = [n for n in filled if own.get(n.path) == top]
    if not chosen:
        return "\n\n".join(blocks)  # no container at all: bare text
    # containers side by side on one path (sections of an article, several articles) belong together
    out, reached = [], 0
    for n in sorted(chosen, key=lambda n: n.first):
        out += blocks[max(n.first, reached) : n.last]
        reached = max(reached, n.last)
    return "\n\n".join(out)


def host_of(url: Column) -> Column:
    """The host in lower case without its port; '' where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame, url: str, page: str) -> DataFrame:
    """(host, path): the path with most votes of each host; of equal ones the first by name."""

    def vote(batch: pa.RecordBatch) -> list[pa.Array]:
        hosts, paths, scores = [], [], []
        for k in range(batch.num_rows):
            host = batch.column(0)[k].as_py()
            for path, score in votes(batch.column(1)[k].as_py()):
                hosts.append(host)
                paths.append(path)
                scores.append(round(score * 1000))  # whole numbers add up the same in any order
        return [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64())]

    read = pages.select(host_of(col(url)).alias("host"), col(page).alias("page"))
    cast = map_batches(read, T.StructType.fromDDL("host string, path string, score long"), vote)
    sums = cast.groupBy("host", "path").agg(F.sum("score").alias("score"))
    best = sums.groupBy("host").agg(F.min_by("path", F.struct((-F.col("score")).alias("s"), "path")).alias("path"))
    return stage(best, "host-paths")


def extract_main_text(df: DataFrame, url: str = "url", page: str = "html", name: str = "text") -> DataFrame:
    """Every row of ``df`` with the page's main text.

    NULL or empty html gives the empty text; pages without a host (NULL urls too)
    vote together as host ''; rows may repeat; an empty table gives no rows; the
    added column takes an underscore where the input has its name.
    """
    name = free(df.columns, name)
    paths = host_paths(df, url, page).select(F.col("host").alias("__host"), F.col("path").alias("__path"))
    joined = df.withColumn("__of", host_of(col(url))).join(paths, F.col("__of") == F.col("__host"), "left")
    joined = joined.select(*map(col, df.columns), "__path")
    at = df.columns.index(page)

    def extract(batch: pa.RecordBatch) -> list[pa.Array]:
        pages, chosen = batch.column(at), batch.column(batch.num_columns - 1)
        texts = [main_text(pages[k].as_py(), chosen[k].as_py()) for k in range(batch.num_rows)]
        return [*batch.columns[:-1], pa.array(texts, pa.string())]

    return map_batches(joined, extended(df, T.StructField(name, T.StringType())), extract)
