"""Main text of web pages: markup where it is plain, nearest-URL page differencing for what it leaves open."""

from __future__ import annotations

import hashlib
import html as _html
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, join_hot, mapped, slices

#: Elements whose content is never text, and those that are page furniture wherever they stand.
_SKIP = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "select", "textarea", "head"}
_FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"}
_BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li",
    "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "nav", "footer", "aside", "form", "fieldset", "menu", "dialog", "legend", "optgroup", "option",
}
_EDGES = _BLOCK | _FURNITURE
_INLINE = {"p", "b", "i", "em", "strong", "u", "font", "span", "a", "small", "s", "code"}
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",)}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "alertdialog"}
#: Words of class or id that name furniture.
_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "newsletter", "subscribe", "nav", "navbar",
    "navigation", "menu", "sidebar", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "comment", "comments", "disqus", "replies", "reply", "respond", "share", "sharing", "social", "related", "recommended",
    "recommendations", "popup", "modal", "widget", "widgets", "toolbar", "pagination", "pager", "skip", "login", "signup", "search",
}
#: Words that say nothing of their own beside such a word.
_PLAIN = {
    "site", "page", "main", "top", "bottom", "left", "right", "list", "box", "bar", "link", "links", "button", "buttons", "container", "wrapper", "wrap", "block", "section", "area", "slot", "item", "items", "inner", "outer",
    "global", "primary", "secondary", "user", "reader", "form", "policy", "posts", "articles", "stories", "news", "more", "js", "ui", "fixed", "sticky", "col", "row", "thread", "icons", "media", "text", "message",
}
#: Names that inside an article may be those of its own heading.
_HEADING = {"header", "masthead", "banner"}
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg"}


#: Kinds of blocks: text for sure, text unless differencing tells it is furniture, and all others.
SURE, OPEN, REST = 0, 1, 2


def _named(value: str, article: bool) -> int:
    """What a class or id says of its element: REST if it is a name of furniture, alone or among words that say nothing, OPEN
    if such a name is only a part of it or may be that of the article's heading, else SURE."""
    found = SURE
    for name in value.lower().split():
        words = [w for w in re.split(r"[_-]+", name) if w]
        mine = [w for w in words if w in _NAMES]
        if not mine:
            continue
        if all(w in _NAMES or w in _PLAIN or w.isdigit() for w in words) and not (article and _HEADING.issuperset(mine)):
            return REST
        found = OPEN
    return found


def blocks(page: str) -> list[tuple[str, bool, int, int]]:
    """(text, in a marked article, kind by markup, place) of each block of text, in order; place: a hash of the elements around it.

    A block is what stands between the borders of block elements; line breaks and white space in it become one space.
    Unclosed and misnested elements end with the element around them. References are decoded where they stand, so none
    begins in one element and ends in another. Furniture in the middle of a block is left out of it.
    """
    out: list[tuple[str, bool, int, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, int, int, int]] = []  # element, in an article, kind, place, kind of the block that it is in
    open_: Counter = Counter()
    article, kind, place, whole = outside = (False, SURE, 0, SURE)

    def say(text: str) -> None:
        if kind != REST or whole == REST:
            parts.append(text)

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, article, whole, place))
            parts.clear()

    pos, end = 0, len(page)
    while pos < end:
        at = page.find("<", pos)
        if at < 0:
            say(_html.unescape(page[pos:]))
            break
        if at > pos:
            say(_html.unescape(page[pos:at]))
        m = _TOKEN.match(page, at)
        if not m:
            say("<")
            pos = at + 1
            continue
        pos = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if page.startswith("<![CDATA[", at):
                say(page[at + 9 : pos - 3])
            continue
        if m[1] or m[4]:
            if name == "br":
                parts.append(" ")
            if not open_[name]:
                if name == "p":
                    flush()
                continue
            depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
            if not _EDGES.isdisjoint(x[0] for x in stack[depth:]):
                flush()
            open_.subtract(x[0] for x in stack[depth:])
            del stack[depth:]
            article, kind, place, whole = stack[-1][1:] if stack else outside
            continue
        attrs = (m[3] if m[2] else m[6]) or ""
        if name in _RAW or name in _SKIP and name != "head":
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, pos)
            if attrs.rstrip().endswith("/") and name == "svg":
                continue
            pos = close.end() if close else end
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in _VOID:
            if name == "hr":
                flush()
            continue
        if name in _EDGES:
            flush()
            while stack and stack[-1][0] in _INLINE and open_["p"]:
                open_[stack.pop()[0]] -= 1
            same = _SAME.get(name, ())
            while stack and stack[-1][0] in same:
                open_[stack.pop()[0]] -= 1
        article, kind, place, whole = stack[-1][1:] if stack else outside
        mine = REST if name in _FURNITURE and not (name == "header" and article) or name == "head" else kind
        if attrs and mine != REST:
            for a in _ATTR.finditer(attrs):
                key, value = a[1].lower(), (a[2] or "").strip("\"'")
                if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "role" and value.lower() in _ROLES):
                    mine = REST
                elif key in ("class", "id") and name not in ("html", "body", "article", "main"):
                    mine = max(mine, _named(value, article))
        main = article or name in ("article", "main") or bool(attrs and re.search(r"""role\s*=\s*["']?(main|article)\b""", attrs, re.I))
        if name in _EDGES:
            place, whole = zlib.crc32(name.encode(), place), mine
        article, kind = main, mine
        stack.append((name, article, kind, place, whole))
        open_[name] += 1
    flush()
    return out


def candidates(page: str) -> tuple[list[tuple[str, int]], list[tuple[str, int]], bool]:
    """((text, kind) of each block, (text, place) of each, whether an article is marked).

    With a marked article the blocks outside of it are REST, and those inside are as markup says. Without, all blocks that
    markup doesn't call furniture are OPEN.
    """
    found = blocks(page)
    marked = any(a and k != REST for _, a, k, _ in found)
    kinds = [REST if k == REST or marked and not a else k if marked else OPEN for _, a, k, _ in found]
    return [(t, k) for (t, *_), k in zip(found, kinds)], [(t, p) for t, _, _, p in found], marked


def _last_row(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The lengths of the longest common subsequences of x with all beginnings of y."""
    best = np.zeros(len(y) + 1, dtype=np.int32)
    for v in x:
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], np.where(y == v, best[:-1] + 1, 0)))
    return best


def _aligned(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Places in x of a longest common subsequence, in memory that grows with x and y, not with their product: x is halved, y
    is cut where both halves' lengths sum up to most, and both parts go on alone."""
    out: list[int] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a == 1:
            if (y[c:d] == x[a]).any():
                out.append(a)
            continue
        mid = (a + b) // 2
        cut = c + int((_last_row(x[a:mid], y[c:d]) + _last_row(x[mid:b][::-1], y[c:d][::-1])[::-1]).argmax())
        todo += [(mid, b, cut, d), (a, mid, c, cut)]
    return out


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in a of a longest common subsequence of a and b."""
    lead = 0
    while lead < min(len(a), len(b)) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = np.array(a[lead : len(a) - tail], dtype=np.int64), np.array(b[lead : len(b) - tail], dtype=np.int64)
    x_at, y = np.flatnonzero(np.isin(x, y)), y[np.isin(y, x)]
    places = x_at[_aligned(x[x_at], y)] + lead if len(x_at) else []
    return [*range(lead), *map(int, places), *range(len(a) - tail, len(a))]


#: Pages of which at least this share of the longer one's characters is common are copies, which tell nothing of furniture.
COPY = 0.8
#: Pages of a host that a line must be on, at one place, to be furniture; all of them, if the host has fewer.
SUPPORT = 3
#: At a place where no more than one in so many of a page's open lines recur, the page's own text stands.
OWN = 3


def _line(text: str, place: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, salt=place.to_bytes(4, "little")).digest(), "little", signed=True)


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("line", pa.int64()), ("place", pa.int64())]))
_BLOCKS_DDL = "array<struct<text: string, line: long, place: long>>"


def _parsed(it):
    """Each page's blocks that may be text with the line of those that are open, and the lines and sizes of all its blocks."""
    for batch in slices(it, column="html"):
        found = [candidates(page or "") for page in batch.column("html").to_pylist()]
        lines = [[_line(t, p) for t, p in places] for _, places, _ in found]
        own = [[{"text": t, "line": x if k == OPEN else None, "place": p} for (t, k), (_, p), x in zip(kinds, places, line) if k != REST] for (kinds, places, _), line in zip(found, lines)]
        open_ = [[x for (_, k), x in zip(kinds, line) if k == OPEN] for (kinds, _, _), line in zip(found, lines)]
        sizes = [[len(t) for t, _ in kinds] for kinds, _, _ in found]
        columns = [pa.array(own, _BLOCKS), pa.array(open_, pa.list_(pa.int64())), pa.array(lines, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "url", "host", "path")] + columns, ["id", "url", "host", "path", "blocks", "open", "lines", "sizes"])


_PAGE = pa.schema([("part", pa.int32()), ("side", pa.int32()), ("mark", pa.int64()), ("host", pa.string()), ("lines", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("open", pa.list_(pa.int64())), ("shared", pa.list_(pa.int64()))])
_PAGE_DDL = "part int, side int, mark long, host string, lines array<long>, sizes array<int>, open array<long>, shared array<long>"


def _pair(a: dict, b: dict) -> tuple[list[tuple[dict, list[int]]], bool]:
    """(what two pages of a host share of each one's open lines, whether they are copies)."""
    at = common(a["lines"], b["lines"])
    if sum(a["sizes"][i] for i in at) >= COPY * max(sum(a["sizes"]), sum(b["sizes"])):
        return [], True
    x = {a["lines"][i] for i in at}
    return [(p, got) for p in (a, b) if (got := [y for y in dict.fromkeys(p["open"]) if y in x])], False


class _Walk:
    """Pages in order: each is paired with the nearest before it on its host that isn't its copy, as far as a run of copies
    shares one such page."""

    def __init__(self):
        self.last = self.base = None

    def step(self, page: dict) -> list[tuple[dict, list[int]]]:
        if self.last is None or self.last["host"] != page["host"]:
            self.last, self.base = page, None
            return []
        out, copies = _pair(self.last, page)
        if not copies:
            self.base = self.last
        elif self.base is not None:
            out = [(p, x) for p, x in _pair(self.base, page)[0] if p is page]
        self.last = page
        return out


def _rows(found: list[tuple[dict, list[int]]], ends: list[tuple[int, int, dict]] = ()) -> pa.RecordBatch:
    rows = [{"mark": p["mark"], "host": p["host"], "shared": x} for p, x in found] + [{**p, "part": part, "side": side} for part, side, p in ends]
    return pa.RecordBatch.from_pylist(rows, schema=_PAGE)


def _neighbours(it):
    """In a sorted partition: the open lines that each page shares with its partners; and the partition's first and last page."""
    from pyspark import TaskContext

    part, walk, first = TaskContext.get().partitionId(), _Walk(), None
    for batch in it:
        found = []
        for page in batch.select(["mark", "host", "lines", "sizes", "open"]).to_pylist():
            first = first or page
            found += walk.step(page)
        yield _rows(found)
    if first is not None:
        yield _rows([], [(part, 0, first), (part, 1, walk.last)])


def _across(it):
    """Over the partitions' first and last pages in order: what the last of one shares with the first of the next that has any."""
    last = None
    for batch in it:
        found = []
        for page in batch.to_pylist():
            if page["side"] == 0 and last is not None and last["host"] == page["host"] and last["mark"] != page["mark"]:
                found += _pair(last, page)[0]
            last = page
        yield _rows(found)


def _furniture(parsed: DataFrame) -> DataFrame | None:
    """(mark, gone): of each page, by the hash of its host and lines, the open lines that are furniture; none if no page has such."""
    mark = F.xxhash64("host", "lines").alias("mark")
    pages = parsed.groupBy("host", mark).agg(F.min(F.struct("path", "lines", "sizes", "open")).alias("page")).select("host", "mark", "page.*")
    pages = durable(pages, "pages-classes")
    order = pages.repartitionByRange("host", "path", "mark").sortWithinPartitions("host", "path", "mark")
    found = durable(order.transform(mapped, _neighbours, _PAGE_DDL), "pages-pairs")
    ends = found.where("part IS NOT NULL").repartition(1).sortWithinPartitions("part", "side")  # two rows a partition
    every = found.where("part IS NULL").select("host", "mark", "shared").unionByName(ends.transform(mapped, _across, _PAGE_DDL).select("host", "mark", "shared"))
    shared = durable(every.select("host", "mark", F.explode("shared").alias("line")).distinct(), "pages-shared")
    if shared.isEmpty():
        return None
    lines = pages.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    support = durable(lines.join(shared.select("host", "line").distinct(), ["host", "line"], "left_semi").groupBy("host", "line").agg(F.count("*").alias("n")), "pages-support")
    told = join_hot(shared, support.withColumn("rows", F.col("n")), ["host", "line"], "rows", support.agg(F.sum("n")).first()[0])
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages"), F.sum(F.size("lines")).alias("rows"))
    told = join_hot(told, hosts, ["host"], "rows", pages.agg(F.sum(F.size("lines"))).first()[0]).where(F.col("n") >= F.least("pages", F.lit(SUPPORT)))
    return told.groupBy("mark").agg(F.collect_set("line").alias("gone"))


def _cut(it):
    """Pages' blocks without those that are gone."""
    for batch in it:
        left = []
        for blocks_, gone in zip(batch.column("blocks").to_pylist(), batch.column("gone").to_pylist()):
            gone = set(gone or ())
            every, recur = Counter(b["place"] for b in blocks_ if b["line"] is not None), Counter(b["place"] for b in blocks_ if b["line"] in gone)
            left.append([b for b in blocks_ if b["line"] not in gone or OWN * recur[b["place"]] <= every[b["place"]]])
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(left, _BLOCKS)], ["id", "url", "blocks"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: id, url, text (blocks joined by two line feeds, empty if none), n_chars.

    Markup decides what it can: where it names an article, blocks outside are furniture, and so are menus, headers, forms,
    notices and the like by element, role or name wherever they stand. What it leaves open - blocks of pages without a
    marked article, and blocks in an article under a name that only in part is one of furniture - is decided by
    differencing: all pages, marked ones too, are sorted by host and path; each is aligned with the nearest before and
    after it that aren't its copies, by a longest common subsequence of its blocks (text and place in the page); an
    open block that is shared goes if at least SUPPORT pages of the host have it at that place, or all where there are
    fewer, and if more than one in OWN of the page's open blocks at that place are such: elsewhere stands the page's own
    text. So what articles share by chance stays, and so does all text under a marked article's plain elements.

    Pages of a host with equal blocks count as one, and a pair whose common blocks hold COPY of the longer one's characters
    deletes nothing. In a run of such copies each meets the page before the run; where a host begins with one, all but its
    last keep their open furniture. Pages are parsed once, where they are read, into a durable table; hashes of blocks are
    sorted and compared; only open blocks are joined.

    Null html is empty; null urls have the empty host and path. Rows that repeat a page share its furniture. A page
    without a partner keeps all its open blocks. No rows in, no rows out; other columns are ignored.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host, path = F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"), path.alias("path"))
    kind = pages.schema[id_col].dataType.simpleString()
    parsed = durable(base.transform(mapped, _parsed, f"id {kind}, url string, host string, path string, blocks {_BLOCKS_DDL}, open array<long>, lines array<long>, sizes array<int>"), "pages-parsed")
    gone = _furniture(parsed.select("host", "path", "lines", "sizes", "open"))
    done = parsed.select("id", "url", "blocks")
    if gone is not None:
        open_ = parsed.where("size(open) > 0").withColumn("mark", F.xxhash64("host", "lines")).join(gone, "mark", "left")
        cut = open_.select("id", "url", "blocks", "gone").transform(mapped, _cut, f"id {kind}, url string, blocks {_BLOCKS_DDL}")
        done = parsed.where("size(open) = 0").select("id", "url", "blocks").unionByName(cut)
    text = F.array_join("blocks.text", "\n\n")
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"), F.length(text).cast("long").alias("n_chars"))
