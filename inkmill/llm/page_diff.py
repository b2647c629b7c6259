"""Main text of web pages by nearest-URL page differencing.

A page becomes lines: the text of each block, in page order, with what its markup says of it. Outlines of all pages,
hashes of their lines, are sorted by host and URL path, so a page stands next to its nearest URLs. It is paired with the
nearest of them that is no copy of it: of up to REACH different pages to either side, and the next whose longest line is
another, the first that shares at most half of the page's text, or else the one that shares least. The lines of both
are aligned by longest common subsequence, and shared lines are deleted. Markup protects and adds:
- lines of the page's own article element stay though shared, unless a name around them is in doubt: one that only in
  part is that of a menu, advert or the like (share-price). Differencing decides on those, and on all lines of pages
  without an article element;
- what markup names for certain as menu, header, footer, sidebar, notice, advert, form, script or comment is dropped,
  since in many pages these parts differ from one page to the next and no differencing can find them; so is what stands
  outside the largest article.
Sorted partitions give each other the pages at their edges, so pairs don't depend on where the sort is cut. A host that
holds a third of all pages is only a long run in the sort, which range partitioning cuts anywhere. Only outlines are
sorted; pages meet their shared lines in one join.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import read_texts, slices, staged

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Elements whose content is no markup, and those that have no content.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "head", "tr", "tbody", "thead", "tfoot", "option", "legend", "caption"}
DROP = set("nav aside footer form menu dialog search button select svg math canvas object audio video map head".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe subscription signup share sharing social related recommended recommendations sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "pagination pager comment comments disqus replies reply respond footer masthead topbar toolbar widget widgets notice notices alert alerts login search skip "
    "outbrain taboola teaser teasers".split()
)
#: Words that don't change what a name with one of NAMES says.
NEUTRAL = set(
    "area bar block bottom box btn button buttons col column container content footer global group header icons inner item items left link links list main mobile "
    "module outer page panel post posts primary right row secondary section site slot small top unit wrap wrapper".split()
)
MAIN_NAMES = {"articlebody", "entrycontent", "postcontent", "articlecontent", "articletext", "storybody", "maincontent", "postbody", "entrybody"}


#: Different pages that are looked at to either side, those among which they are looked for, and pages that wait for the
#: next whose longest line is another.
REACH, LOOK, WAITING = 3, 8, 200_000
#: Pages in a sorted partition, about; it must hold many times LOOK.
PART_ROWS = 4096


@dataclass
class Line:
    text: str
    article: int  # number of the outermost article-like element it is in, 0 for none
    main: bool
    drop: bool
    doubt: bool = False


@dataclass
class Open:
    tag: str
    article: int
    main: bool
    drop: bool
    doubt: bool = False


@dataclass(eq=False)
class Outline:
    """Hashes and lengths of a page's lines; ghosts stand in for pages of the partition next to this one."""

    key: tuple
    host: str
    path: str
    lines: list[int]
    sizes: list[int]
    ghost: bool = False

    def __post_init__(self):
        self.longest = self.lines[max(range(len(self.sizes)), key=self.sizes.__getitem__)] if self.lines else 0
        self.whole = (self.host, hash(tuple(self.lines)))


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def lines(html: str) -> list[Line]:
    """The blocks of a page that have text. Unclosed and stray tags are read as browsers read them, near enough."""
    out: list[Line] = []
    stack = [Open("", 0, False, False)]
    text: list[str] = []
    count = 0

    def flush():
        if text:
            if said := " ".join(entities.unescape("".join(text)).split()):
                top = stack[-1]
                out.append(Line(said, top.article, top.main, top.drop, top.doubt))
            text.clear()

    def close(i: int):
        if any(o.tag in BLOCK for o in stack[i:]):
            flush()
        del stack[i:]

    at = 0
    while True:
        m = _TOKEN.search(html, at)
        text.append(html[at : m.start() if m else len(html)])
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m.group().startswith("<![CDATA["):
                text.append(entities.escape(m.group()[9:-3]))
            continue
        if m["end"] or m["end2"]:
            if tag == "p" and not any(o.tag == "p" for o in stack):
                flush()
            # a stray end tag doesn't close the article around it
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in ("article", "main", "table") and tag not in ("article", "main", "table", "body", "html"):
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = len(html) if not end else max(html.find(">", end.start()) + 1, end.end())
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag in CLOSES_P or tag in ("li", "dt", "dd", "tr", "option"):
            same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",)}.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in same or (stack[i].tag == "p" and tag in CLOSES_P):
                    close(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in ("td", "th"):
            text.append(" ")
        if tag in VOID or (m["attrs"] or m["attrs2"] or "").endswith("/") and tag not in BLOCK:
            continue
        top, raw = stack[-1], m["attrs"] or m["attrs2"] or ""
        article, main, drop, doubt = top.article, top.main, top.drop, top.doubt
        names: set[str] = set()
        if raw.strip():
            a = _attributes(raw)
            said = f"{a.get('class', '')} {a.get('id', '')}".split()
            parts = [{p.lower() for p in _PART.findall(s)} for s in said]
            names = set().union(*parts)
            # a name says so for certain if all its words do
            named = any(p & NAMES and p <= NAMES | NEUTRAL for p in parts)
            joined = {re.sub(r"[^a-z]", "", s.lower()) for s in said} | {a.get("itemprop", "").lower()}
            if a.get("role") == "main":
                main = True
            if tag not in ("html", "body") and not (joined & MAIN_NAMES):
                doubt = doubt or bool(names & NAMES)
                if a.get("role") in ROLES or "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")) or named:
                    drop = True
            if not drop and not article and joined & MAIN_NAMES:
                count += 1
                article = count
            if a.get("role") == "article" and not article:
                count += 1
                article = count
        if tag in DROP or tag == "header" and not article or names & {"header"} and not article and not names & {"article", "entry", "post"} and tag not in ("html", "body"):
            drop = True
        if tag == "article" and not article and not drop:
            count += 1
            article = count
        stack.append(Open(tag, article, main or tag == "main", drop, doubt))
    flush()
    return out


def _rows(a: list[int], b: list[int]):
    """Bit-parallel LCS: after each element of a, the bits of b where the length of the LCS does not grow."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """LCS length of a with each prefix of b."""
    v = (1 << len(b)) - 1
    for v in _rows(a, b):
        pass
    out, n = [0], 0
    for bit in reversed(bin(v)[2:].zfill(len(b))) if b else ():
        n += bit == "0"
        out.append(n)
    return out


#: Bits that the trace of an alignment may take before it is halved.
TRACE_BITS = 1 << 26


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence, in order; memory is bounded by halving a where need be."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    ends = [(len(a) - k, len(b) - k) for k in range(hi, 0, -1)]
    both = set(a[lo : len(a) - hi]) & set(b[lo : len(b) - hi])
    ia = [i for i in range(lo, len(a) - hi) if a[i] in both]
    ib = [j for j in range(lo, len(b) - hi) if b[j] in both]
    mid: list[tuple[int, int]] = []
    if ia and ib:
        x, y = [a[i] for i in ia], [b[j] for j in ib]
        if len(x) > 1 and len(x) * len(y) > TRACE_BITS:
            h = len(x) // 2
            up, down = _lengths(x[:h], y), _lengths(x[h:][::-1], y[::-1])
            k = max(range(len(y) + 1), key=lambda j: up[j] + down[len(y) - j])
            pairs = common(x[:h], y[:k]) + [(i + h, j + k) for i, j in common(x[h:], y[k:])]
        else:
            rows, pairs = list(_rows(x, y)), []
            i, j = len(x) - 1, len(y) - 1
            while i >= 0 and j >= 0:
                if rows[i] >> j & 1:
                    j -= 1
                elif i and not rows[i - 1] >> j & 1:
                    i -= 1
                else:
                    pairs.append((i, j))
                    i, j = i - 1, j - 1
            pairs.reverse()
        mid = [(ia[i], ib[j]) for i, j in pairs]
    return [(k, k) for k in range(lo)] + mid + ends


def main_text(found: list[Line], shared: set[int]) -> str:
    """The page's text without the lines it shares with its pair, and without what markup names as no part of the
    article; lines of the article itself stay, but for shared ones in doubt."""
    size: dict[int, int] = {}
    for x in found:
        if x.article and not x.drop:
            size[x.article] = size.get(x.article, 0) + len(x.text)
    best = max(size, key=lambda k: (size[k], -k)) if size else 0
    main = not best and any(x.main and not x.drop for x in found)
    gone = lambda i, x: i in shared and (not best or x.doubt)
    kept = [x.text for i, x in enumerate(found) if not x.drop and not gone(i, x) and (x.article == best if best else x.main or not main)]
    return "\n".join(kept)


def shared_lines(page: Outline, near: Iterable[Outline]) -> list[int]:
    """Lines that ``page`` shares with its pair: the first of ``near`` that shares at most half of its text, else the one
    that shares least; none where that is a copy."""
    whole, least, most = sum(page.sizes), [], 0
    for k, other in enumerate(near):
        found = [i for i, _ in common(page.lines, other.lines)]
        size = sum(page.sizes[i] for i in found)
        if 2 * size <= whole:
            return found
        if not k or size < most:
            least, most = found, size
    return least if most < whole else []


def _affinity(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def neighbours(page: Outline, side: Iterable[Outline], other: Outline | None) -> Iterator[Outline]:
    """Of the pages to one side, nearest first, REACH that differ from the page and each other; then ``other``, the next
    whose longest line is another."""
    seen = {page.whole}
    for near in [*islice(side, LOOK), *[other] * (other is not None)]:
        if near.host == page.host and page.host and near.whole not in seen and (len(seen) <= REACH or near is other):
            seen.add(near.whole)
            yield near


class Before:
    """The last pages, nearest first, as far as a later page may be paired with them: a run of equal lines is its last
    page, and beyond LOOK of them only the nearest whose longest line is another is kept."""

    def __init__(self):
        self.held: deque[Outline] = deque()

    def other(self, page: Outline) -> Outline | None:
        return next((x for x in self.held if x.longest != page.longest), None)

    def add(self, page: Outline) -> None:
        if self.held and self.held[0].whole == page.whole:
            self.held.popleft()
        self.held.appendleft(page)
        if len(self.held) > LOOK + 1:
            far = [x for x in islice(self.held, LOOK, None) if x.longest != page.longest][:1]
            near = any(x.longest != page.longest for x in islice(self.held, LOOK))
            self.held = deque([*islice(self.held, LOOK), *far * (not near)])


def paired(pages: Iterable[Outline]) -> Iterator[tuple[Outline, list[int]]]:
    """(page, its shared lines) for pages in order of host and path; a page waits until what follows settles its pair."""
    before, queue, head, scan = Before(), [], 0, 0

    def settled(ended: bool) -> bool:
        """Whether the pages after queue[head] are known as far as they matter; scan gets to the first whose longest
        line, or host, is another."""
        nonlocal scan
        page = queue[head]
        if scan <= head or queue[scan - 1].longest != page.longest or queue[scan - 1].host != page.host:
            scan = head + 1
        while scan < len(queue) and queue[scan].longest == page.longest and queue[scan].host == page.host:
            scan += 1
        known = queue[-1].host != page.host or scan < len(queue) and len(queue) - head > LOOK
        return ended or known or len(queue) - head > WAITING

    def told(ended: bool) -> Iterator[tuple[Outline, list[int]]]:
        nonlocal head, scan
        while head < len(queue) and settled(ended):
            page = queue[head]
            if not page.ghost:
                after = queue[scan] if scan < len(queue) else None
                sides = [neighbours(page, before.held, before.other(page)), neighbours(page, queue[head + 1 : head + 1 + LOOK], after)]
                near = sorted(((-_affinity(x.path, page.path), k, i, x) for i, side in enumerate(sides) for k, x in enumerate(side)), key=lambda x: x[:3])
                yield page, shared_lines(page, (x[3] for x in near))
            before.add(page)
            head += 1
        if head > 1 << 14:
            del queue[:head]
            scan, head = max(scan - head, 0), 0

    for page in pages:
        queue.append(page)
        yield from told(False)
    yield from told(True)


ORDER = ["host", "path", "url", "page_id", "mark"]
OUTLINE = "host string, path string, url string, page_id long, mark long, lines array<long>, sizes array<int>"


def _outlines(batches):
    for whole in batches:
        for batch in slices(whole, "html"):
            found = [lines(h or "") for h in batch.column("html").to_pylist()]
            hashes = pa.array([[xxhash.xxh3_64_intdigest(x.text.encode("utf-8", "surrogatepass")) >> 1 for x in page] for page in found], pa.list_(pa.int64()))
            sizes = pa.array([[len(x.text) for x in page] for page in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ORDER), hashes, sizes], [*ORDER, "lines", "sizes"])


def _pages(batches) -> Iterator[tuple[tuple, Outline]]:
    for batch in batches:
        ghosts = batch.column("ghost").to_pylist() if "ghost" in batch.schema.names else [False] * batch.num_rows
        parts = batch.column("part").to_pylist() if "part" in batch.schema.names else [0] * batch.num_rows
        for host, path, url, page_id, mark, found, sizes, ghost, part in zip(*(batch.column(c).to_pylist() for c in (*ORDER, "lines", "sizes")), ghosts, parts):
            yield part, Outline((host, path, url, page_id, mark), host or "", path or "", found, sizes, ghost)


def _numbered(batches):
    """Outlines of a sorted partition with its number, and those at its edges once more for the partitions beside it."""
    part, first, last = TaskContext.get().partitionId(), [], Before()
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([False] * n), pa.array([part] * n, pa.int32())], [*batch.schema.names, "ghost", "part"])
        for _, page in _pages([batch]):
            last.add(page)
            if len(first) <= LOOK or all(x.longest == first[0].longest for x in first) and page.longest != first[0].longest:
                first.append(page)
    rows = [(*x.key, x.lines, x.sizes, True, to) for some, to in ((first, part - 1), (last.held, part + 1)) for x in some]
    if rows:
        kinds = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.bool_(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*ORDER, "lines", "sizes", "ghost", "part"])


def _shared(batches):
    """(page_id, url, mark, shared) of pages that share lines with their pair; rows come sorted by partition and order."""
    rows: list[tuple] = []

    def packed():
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["page_id", "url", "mark", "shared"])

    for _, group in groupby(_pages(batches), key=lambda x: x[0]):
        for page, found in paired(x for _, x in group):
            if found:
                _, _, url, page_id, mark = page.key
                rows.append((page_id, url, mark, np.array(found, np.int32).tobytes()))
                if len(rows) >= 5000:
                    yield packed()
                    rows.clear()
    if rows:
        yield packed()


def _extract(batches):
    for whole in batches:
        for batch in slices(whole, "html"):
            out = [main_text(lines(h or ""), set(np.frombuffer(s or b"", np.int32).tolist())) for h, s in zip(*(batch.column(c).to_pylist() for c in ("html", "shared")))]
            cols = [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])


def _keyed(pages: DataFrame) -> DataFrame:
    url = F.lower(F.coalesce(F.col("url").cast("string"), F.lit("")))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    path = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    # runs of digits are padded so that neighbours in the sort are neighbours in number
    padded = F.regexp_replace(F.regexp_replace(path, r"([0-9]+)", "00000000$1"), r"0+([0-9]{9})(?![0-9])", "$1")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"), padded.alias("path"))
    return rows.withColumn("mark", F.xxhash64("page_id", "url", "html"))


def shared_with_nearest(pages: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(page_id, url, mark, shared): for pages that share lines with their pair, the lines' numbers as 32-bit integers."""
    seen = staged(_keyed(pages).mapInArrow(_outlines, OUTLINE), "outlines")
    ranged = seen.repartitionByRange(seen.count() // part_rows + 1, *ORDER).sortWithinPartitions(*ORDER)
    edged = ranged.mapInArrow(_numbered, OUTLINE + ", ghost boolean, part int")
    dealt = edged.repartition("part").sortWithinPartitions("part", *ORDER, "ghost")
    return dealt.mapInArrow(_shared, "page_id long, url string, mark long, shared binary")


def extract(pages: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null html counts as empty and gives an empty text; a null or malformed URL has no host and so no neighbour;
    repeated rows come out as often as they go in, each with the same text; an empty table gives no rows. Pages of any
    length are read whole; further columns, whatever their names, are not read. Where a page has an article element
    (or one so named) its text is that of the largest of them; else of main; else of all blocks.
    """
    rows = _keyed(pages)
    found = shared_with_nearest(pages, part_rows).select(F.coalesce("page_id", F.lit(0)).alias("i"), F.col("mark").alias("m"), "shared").dropDuplicates(["i", "m"])
    both = rows.join(found, (F.coalesce("page_id", F.lit(0)) == F.col("i")) & (F.col("mark") == F.col("m")), "left").select("page_id", "url", "html", "shared")
    return both.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op5_page_text(spark, sf_dir: str) -> DataFrame:
    return extract(read_texts(spark, f"{sf_dir}/pages.parquet"))
