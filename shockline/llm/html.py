"""Main text of web pages by nearest-URL differencing (operator 10).

A page is cut into blocks of text. Each page is paired with the page of its host whose URL path is
nearest (near it in path order, longest common beginning); the longest common subsequence of the
two pages' lines is what the site repeats, and is deleted; all other lines stay. Inside an article or main
element a line goes only if it is in that of every near page, and those are three at least, as articles may
share a line by what they say. A page that shares more than half of the article is a copy of it: it says
nothing about the lines inside. Lines of marked menus, headers, footers, sidebars, notices, adverts,
forms and comments take no part and go in any case; a class or id marks by its whole name, and, comments
apart, never an element that holds most of the article, or of a page without one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_input, table, written

# A tag's quotes hold its end only behind an equals sign, as browsers read it.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)((?>[^>\"'=]+|=\s*(?:\"[^\"]*\"|'[^']*')|[\"'=])*+)>|[^<]+|<", re.S)
#: The same with tags that end at the next sign, in quotes or not.
PLAIN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<", re.S)
TAG = re.compile(r"</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"""([^\s=/]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
SPACE = re.compile(r"\s+")
#: Neighbours in path order that a page may be compared with, on each side.
NEAR = 3
#: Pairs of lines from which on it pays to leave out first what can't be common.
LARGE = 1 << 16
#: Near pages that must all have a line of an article for it to go.
WITNESSES = 3
# Element names of the HTML standard, and what sites call their furniture.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "button", "canvas", "audio", "video", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "nobr"}
FURNITURE = {"nav", "footer", "aside", "menu", "dialog", "head"}
OWN = {"article", "main"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar"}
# A class or id marks an element if all parts of the name are of these words, and one is of the first kind.
MARK = r"(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|footer|masthead|sidebar|widget\w*|cookies?\w*|consent|gdpr|notices?|newsletter|subscribe|popup|modal|overlay|share|sharing|social|related|recommend\w*|comments?|commentlist|respond|replies|disqus|toolbar|pagination|pager|skip)"
PLACE = r"(?:bar|box|wrap|wrapper|container|list|area|section|items?|links?|block|unit|slot|holder|panel|icons?|buttons?|btns?|form|top|bottom|left|right|inner|outer|site|page|posts?|articles?|entry|global|main|primary|secondary|tertiary|mobile|desktop|google|email|\d+(?:x\d+)?)"
MARKS = re.compile(rf"(?:^|\s)(?:{PLACE}[_-]+)*{MARK}(?:[_-]+(?:{MARK}|{PLACE}))*(?:$|\s)", re.I)
# Readers' comments go by these, whatever their length.
COMMENT = r"(?:comments?|commentlist|commenters?|disqus|replies|respond|feedback)"
COMMENTS = re.compile(rf"(?:^|\s)(?:(?:{PLACE}|user|reader|readers|visitor|customer|guest)[_-]+)*{COMMENT}(?:[_-]+(?:{MARK}|{PLACE}|thread|feed|count|text|body))*(?:$|\s)", re.I)


def furniture(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, bool]:
    """Whether the element is furniture, whether only its name says so, and whether that is a name of readers' comments."""
    if tag in FURNITURE or tag == "header" and not inside:
        return True, False, False
    if tag in ("html", "body"):
        return False, False, False
    named, found = tag == "form", [(name.lower(), value.strip("\"'")) for name, value in ATTRIBUTE.findall(attributes or "")]
    comments = any(name in ("class", "id") and COMMENTS.search(value) for name, value in found)
    if comments or tag in OWN:
        return False, comments, comments
    for name, value in found:
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in ROLES:
            return True, False, False
        named = named or name in ("class", "id") and bool(MARKS.search(value)) or name == "role" and value.lower() == "form"
    return False, named, False


#: Elements of a site look alike.
known_furniture = lru_cache(1 << 15)(furniture)


def blocks(html: str | None) -> list[tuple[str, bool, bool]]:
    """The page's lines in order: text, whether an article or main element holds it, whether furniture does.

    An element that is marked by its name alone is none if it holds most of the articles' text, or of the page's where
    there is no article. Readers' comments inside of an article go at any length, and beside one as well. The page is read once, and closing an element takes as many steps as it
    closes, so pages of any length and nesting take time in proportion.
    """
    out: list[tuple[str, bool, bool, int]] = []
    text: list[str] = []
    top = (False, False, 0)
    stack: list[tuple[str, bool, bool, int]] = []  # element, holds own text, furniture, the marked element around
    blocks_open: list[int] = []  # places in the stack of what isn't inline
    open_tags: Counter[str] = Counter()
    over, always = [0], [False]  # of marked elements: the one around; whether they are comments inside of an article
    comment = [False]
    own, junk, mark = top

    def close() -> None:
        if text and (line := SPACE.sub(" ", unescape("".join(text))).strip()):
            out.append((line, own, junk, mark))
        text.clear()

    def leave(k: int) -> None:
        """Close the elements from this place in the stack on."""
        nonlocal own, junk, mark
        for x in stack[k:]:
            open_tags[x[0]] -= 1
        del stack[k:]
        while blocks_open and blocks_open[-1] >= k:
            blocks_open.pop()
        own, junk, mark = stack[-1][1:] if stack else top

    at, html, token = 0, html or "", TOKEN
    last = html.rfind(">")
    while at < len(html):
        if at > last:  # no tag any more
            if not html.startswith(("<!", "<?"), at):
                text.append(html[at:])
            break
        m = token.match(html, at)
        if token is TOKEN and not m[1] and TAG.match(html, at):
            # quotes that hold all ends up to the end of the page: from here on they aren't heeded, so the page is read once
            token = PLAIN
            m = token.match(html, at)
        at = m.end()
        piece, tag = m[0], (m[1] or "").lower()
        if not tag:
            if not piece.startswith(("<!", "<?")):
                text.append(piece)
            continue
        if piece[1] == "/":
            if tag not in INLINE:
                close()
            if open_tags[tag] > 0:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                leave(k)
            continue
        if tag in RAW:
            if tag not in INLINE and tag not in ("svg", "math", "button", "select"):
                close()
            if piece[-2] != "/":
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                at = html.find(">", end.end() - 1) + 1 if end else len(html)
                at = at or len(html)
            continue
        if tag not in INLINE:
            close()
        if tag in VOID or tag in INLINE and not m[2]:
            continue
        if tag in ("p", "li") and blocks_open and stack[blocks_open[-1]][0] == tag:  # these end an open one of their kind
            leave(blocks_open[-1])
        sure, named, comments = (known_furniture if len(m[2]) < 200 else furniture)(tag, m[2], own)
        junk = junk or sure
        if named and not junk:
            over.append(mark)
            comment.append(comments)
            always.append(comments and own)
            mark = len(over) - 1
        own = own or tag in OWN
        if tag not in INLINE:
            blocks_open.append(len(stack))
        open_tags[tag] += 1
        stack.append((tag, own, junk, mark))
    close()
    # characters that each marked element holds: of lines in articles, and of all lines
    held = np.zeros((len(over), 2), np.int64)
    for line, own, junk, mark in out:
        if not junk:
            held[mark] += own * len(line), len(line)
    for k in range(len(over) - 1, 0, -1):
        held[over[k]] += held[k]
    (articles, every), gone = held[0].tolist(), [False] * len(over)
    for k in range(1, len(over)):
        a, n = held[k].tolist()
        most = not always[k] and (2 * a > articles if articles else n == every if comment[k] else 2 * n > every)
        gone[k] = gone[over[k]] or not most
    return [(line, own, junk or gone[mark]) for line, own, junk, mark in out]


def host_and_path(url: str | None) -> tuple[str, str]:
    rest = (url or "").split("://", 1)[-1]
    host, _, path = rest.partition("/")
    return host.lower(), re.split(r"[?#]", path)[0].rstrip("/")


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in a of a longest common subsequence of two lists of line hashes, in memory that grows with a alone.

    Equal beginnings and ends are taken first; what lies between is split in the middle again and again.
    """
    lo, n = 0, min(len(a), len(b))
    while lo < n and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < n - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    ends = [np.arange(lo), np.arange(len(a) - hi, len(a))]
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if not len(a) or not len(b):
        return np.concatenate(ends)
    if len(a) == 1:
        return np.concatenate([ends[0], np.array([lo] if (b == a[0]).any() else [], int), ends[1]])

    if len(a) * len(b) > LARGE:  # lines that the other page lacks are in no common subsequence
        places, other = lo + np.flatnonzero(np.isin(a, b)), b[np.isin(b, a)]
        if len(places) < len(a) or len(other) < len(b):
            return np.concatenate([ends[0], places[common_lines(a[places - lo], other)], ends[1]])

    def lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        row = np.zeros(len(y) + 1, np.int64)
        for v in x:
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (y == v)))
        return row

    mid = len(a) // 2
    cut = int(np.argmax(lengths(a[:mid], b) + lengths(a[mid:][::-1], b[::-1])[::-1]))
    inner = np.concatenate([common_lines(a[:mid], b[:cut]), mid + common_lines(a[mid:], b[cut:])])
    return np.concatenate([ends[0], lo + inner, ends[1]])


def unmarked(html: str | None) -> list[tuple[str, bool]]:
    """The page's lines without furniture: text, whether an article or main element holds it."""
    return [(text, own) for text, own, junk in blocks(html) if not junk]


def compared(lines: list[tuple[str, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines, and their lengths, negative inside an article."""
    hashes = [xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) >> 1 for t, _ in lines]
    return np.array(hashes, np.int64), np.array([-len(t) if own else len(t) for t, own in lines], np.int32)


def repeated(own: np.ndarray, lengths: np.ndarray, near: list[np.ndarray]) -> np.ndarray:
    """Places of the lines that the site repeats, by the near pages that aren't copies.

    A page is a copy if no line or at most half of the article is left. Outside of an article the nearest page that
    isn't a copy decides, or else the first one that leaves some line. Articles may share a line by what they say, so
    inside of one a line goes if all near pages have it, and those are WITNESSES at least.
    """
    inside, outside, other, seen, n = np.minimum(lengths, 0), None, np.empty(0, np.int64), np.zeros(len(own), np.int64), 0
    for lines in near:
        at = np.flatnonzero(np.isin(own, lines))
        at = at[common_lines(own[at], lines[np.isin(lines, own)])]
        if len(at) == len(own):
            continue
        if 2 * inside[at].sum() >= inside.sum():  # both are negative, or there is no article
            outside = at[lengths[at] > 0] if outside is None else outside
            seen[at] += 1
            n += 1
        elif not len(other):
            other = at[lengths[at] > 0]
    gone = other if outside is None else outside
    return np.union1d(gone, np.flatnonzero((seen == n) & (lengths < 0))) if n >= WITNESSES else gone


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages.

    Null or empty html gives an empty text; pages of any length are read whole. A null url has the empty host
    and path. An empty table gives an empty result. Of neighbours that are equally near the earlier comes first. Repeated rows give
    a row each. Further columns are ignored. Pages of a host with the very same lines are compared once,
    at the first of their paths, and all get its result; so a neighbour always differs. What is left is
    dealt out by ranges of host and path, so a host of any size is spread over tasks; the pages at the
    borders of the ranges take their neighbours, three on each side, from a small table of a row a range.
    """
    rows = as_input(pages, {"page_id": "long", "url": "string", "html": "string"}).withColumn("h", F.xxhash64("html"))

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            where = [host_and_path(u) for u in b["url"]]
            found = [compared(unmarked(x)) for x in b["html"]]
            same = [xxhash.xxh64_intdigest(h.tobytes() + n.tobytes()) >> 1 for h, n in found]
            yield b.drop(columns="html").assign(host=[x[0] for x in where], path=[x[1] for x in where], same=same, hashes=[x[0] for x in found], lengths=[x[1] for x in found])

    def differences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            shared = []
            columns = (b[c] for c in ("host", "path", "hashes", "lengths", "left", "before", "after", "right"))
            for host, path, own, lengths, left, before, after, right in zip(*columns, strict=True):
                sides = (pages_of(left) + pages_of(before))[: -NEAR - 1 : -1], (pages_of(after) + pages_of(right))[:NEAR]
                near = [(-common_start(path, x["path"]), k, x["hashes"]) for side in sides for k, x in enumerate(side) if x["host"] == host]
                near.sort(key=lambda x: x[:2])
                shared.append(repeated(own, lengths, [np.asarray(x[2], np.int64) for x in near]))
            yield b[["host", "same"]].assign(shared=shared)

    def pages_of(found: Iterable | None) -> list:
        return [] if found is None else [x for x in found if x is not None]

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            gone = [set() if k is None else set(k) for k in b["shared"]]
            text = [" ".join(t for at, (t, _) in enumerate(unmarked(x)) if at not in k) for x, k in zip(b["html"], gone, strict=True)]
            yield b[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    key = "page_id long, url string, h long"
    cut = written(rows.mapInPandas(lines, f"{key}, host string, path string, same long, hashes array<long>, lengths array<int>"), "page_lines")
    distinct = cut.groupBy("host", "same").agg(F.min("path").alias("path"), F.first("hashes").alias("hashes"), F.first("lengths").alias("lengths"))
    order = ["host", "path", "same"]
    sorted_rows = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows = written(sorted_rows.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "page_order")
    page, inside = F.struct("host", "path", "hashes"), Window.partitionBy("part").orderBy("at")
    near = sorted_rows.withColumn("before", F.array(*(F.lag(page, k).over(inside) for k in range(NEAR, 0, -1))))
    near = near.withColumn("after", F.array(*(F.lead(page, k).over(inside) for k in range(1, NEAR + 1))))
    first, last = F.slice(F.concat(F.array(page), "after"), 1, NEAR), F.slice(F.concat("before", F.array(page)), -NEAR, NEAR)
    ends = near.groupBy("part").agg(F.min_by(first, "at").alias("first"), F.max_by(last, "at").alias("last"))
    by_part = Window.orderBy("part")  # one row a range
    ends = ends.select("part", F.lag("last").over(by_part).alias("left"), F.lead("first").over(by_part).alias("right"))
    near = near.join(ends, "part").select(*order, "hashes", "lengths", "left", "before", "after", "right")
    # written, so that the join has exchanges of its own and lines that very many pages have are split
    found = written(near.mapInPandas(differences, "host string, same long, shared array<long>").where("size(shared) > 0"), "line_shared")
    found = written(cut.select("page_id", "url", "h", "host", "same").join(found, ["host", "same"]).drop("host", "same"), "page_shared")
    found = found.dropDuplicates(["page_id", "url", "h"])
    same = F.col("p.page_id").eqNullSafe(F.col("s.page_id")) & F.col("p.url").eqNullSafe(F.col("s.url")) & F.col("p.h").eqNullSafe(F.col("s.h"))
    joined = rows.alias("p").join(found.alias("s"), same, "left").select("p.page_id", "p.url", "p.html", "s.shared")
    return joined.mapInPandas(texts, "page_id long, url string, text string, n_chars long")


def common_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
