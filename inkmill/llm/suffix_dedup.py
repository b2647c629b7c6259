"""Removal of long repeated byte strings, with suffix arrays built by two-stage sorting.

Every byte covered by a SPAN-byte string that also starts anywhere else in the corpus goes. One suffix array over
the corpus can't be held anywhere, so the corpus is first cut down to where such strings can be:

1. Of each SPAN-byte window the leftmost smallest GRAM-byte hash is its anchor. Equal windows have their anchor at
   the same offset, so it is enough to look, for every anchor, at the other places with the same anchor bytes.
2. A piece is an anchor with the bytes of all windows whose anchor it is, so every window is in one piece. A piece
   that occurs twice as a whole is repeated as a whole; that needs only its digest and a count, however many copies.
3. Pieces with the same anchor but different bytes remain. A window lies at least half to the left or half to the
   right of its anchor, so two such pieces share a window only if they agree on HALF bytes to one side. One example
   of each piece that has such a partner goes, group by group, into blocks; over each block a suffix array is built:
   suffixes smaller than their successors are sorted directly, the others induced by bucket scans, and adjacent
   common prefixes of SPAN bytes tell the repeated windows.
4. A group of more than GROUP different pieces (a passage within very many texts) would not fit a block. Its windows
   are taken CELL at a time: where the bytes common to a cell's windows occur once, none is repeated; where the bytes
   they cover together occur twice, all are; the windows of the cells between are counted one by one. Digests and
   counts do it, in linear time and without any pairs.

What is found for a piece is carried to all its occurrences, and a document's spans are united and cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import documents, slices, staged, texts

SPAN, GRAM = 400, 64
REACH = SPAN - GRAM  # bytes to either side of an anchor that a window can hold
HALF = REACH // 2
GROUP, CELL = 24, 16
#: Bytes in one suffix array, and in one task.
BLOCK, TASK = 1 << 18, 1 << 21
#: Bytes whose anchors are found at once.
CHUNK = 1 << 21

_rng = np.random.default_rng(20240)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def doubled(x: np.ndarray, levels: int) -> list[np.ndarray]:
    """Hashes of all substrings of 1, 2, 4, ... 2**levels bytes."""
    out = [_BYTE[x]]
    for k in range(levels):
        h, step = out[-1], 1 << k
        g = h[: max(len(h) - step, 0)] * _MUL[k]
        g += h[step:]
        g ^= g >> np.uint64(29)
        g *= _MUL[k + 8]
        out.append(g)
    return out


def anchors(x: np.ndarray, end: np.ndarray, stop: int) -> tuple[np.ndarray, ...]:
    """(anchor, its hash, first and last window start) for the windows of x that start before ``stop`` and end by
    end[i], the end of position i's document."""
    if len(x) < SPAN:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
    h = doubled(x, GRAM.bit_length() - 1)[-1]
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    window, size = REACH + 1, 1
    while size * 2 <= window:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if last := window - size:
        least = np.minimum(least[: len(least) - last], least[last:])
    at = (least[:stop] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.arange(len(at)) + SPAN <= end[: len(at)])
    at = at[start]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], h[at[first]], start[first], start[np.append(first[1:], len(at)) - 1] if len(at) else start


def _hashes(batches):
    """Anchor rows of each document."""
    digest64 = xxhash.xxh3_64_intdigest
    for whole in batches:
        for batch in slices(whole):
            raws = [t.encode("utf-8", "surrogatepass") for t in texts(batch)]
            size = np.array([len(r) for r in raws], np.int64)
            buf = b"".join(raws)
            ends = np.cumsum(size)
            starts = ends - size
            x, end = np.frombuffer(buf, np.uint8), np.repeat(ends, size)
            found = []
            for a in range(0, max(len(x), 1), CHUNK):
                b = min(len(x), a + CHUNK + SPAN - 1)
                at, h, low, high = anchors(x[a:b], end[a:b] - a, CHUNK)
                found.append((at + a, h, low + a, high + a))
            at, h, low, high = (np.concatenate(f) for f in zip(*found))
            # a chunk may begin with windows of its predecessor's last anchor
            first = np.flatnonzero(np.diff(at, prepend=-1))
            high = high[np.append(first[1:], len(at)) - 1] if len(at) else high
            at, h, low = at[first], h[first], low[first]
            owner = np.searchsorted(ends, at, "right")
            rows = list(zip(at.tolist(), low.tolist(), high.tolist()))
            piece = [digest64(buf[p : q + SPAN], seed=c - p) >> 1 for c, p, q in rows]
            left = [digest64(buf[c - HALF : c + GRAM]) & 0x7FFFFFFF if c - p >= HALF else -1 for c, p, _ in rows]
            right = [digest64(buf[c : c + GRAM + HALF]) & 0x7FFFFFFF if c - q < HALF else -1 for c, _, q in rows]
            pick = pa.array(owner)
            i32 = lambda v: pa.array(np.asarray(v, np.int32))
            cols = [batch.column("doc_id").take(pick), batch.column("mark").take(pick), i32(at - starts[owner]), i32(at - low), i32(at - high)]
            cols += [pa.array(h.view(np.int64)), pa.array(piece, pa.int64()), i32(left), i32(right)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "mark", "at", "far", "near", "anchor", "piece", "left", "right"])


def suffix_array(text: bytes, depth: int = SPAN) -> np.ndarray:
    """Suffixes of ``text`` in order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(text)
    x = np.frombuffer(text, np.uint8)
    # a suffix is smaller than its successor if the next different byte is larger; at the end it is larger
    change = np.flatnonzero(np.diff(x.astype(np.int16)))
    rises = np.append(x[1:][change] > x[:-1][change], False)
    small = rises[np.searchsorted(change, np.arange(n), "left")]
    direct = np.flatnonzero(small).tolist()
    keys = [text[i : i + depth] for i in direct]
    direct = np.array(direct, np.int64)[sorted(range(len(keys)), key=keys.__getitem__)]
    del keys
    count = np.bincount(x, minlength=256)
    tail = np.cumsum(count)
    fill = tail - count  # where the next induced suffix of a bucket goes
    sa = np.zeros(n, np.int64)
    smalls = np.bincount(x[direct], minlength=256)
    for c, part in zip(np.flatnonzero(smalls), np.split(direct, np.cumsum(smalls[smalls > 0])[:-1])):
        sa[tail[c] - smalls[c] : tail[c]] = part

    def induce(batch: np.ndarray) -> None:
        j = batch - 1
        j = j[(j >= 0)]
        j = j[~small[j]]
        if not len(j):
            return
        c = x[j]
        j = j[np.argsort(c, kind="stable")]
        sizes = np.bincount(c, minlength=256)
        some, at = np.flatnonzero(sizes), 0
        for d in some.tolist():
            k = int(sizes[d])
            sa[fill[d] : fill[d] + k] = j[at : at + k]
            fill[d] += k
            at += k

    if n:
        induce(np.array([n]))
    for c in np.flatnonzero(count).tolist():
        low = int(tail[c] - count[c])
        while low < fill[c]:  # a bucket may go on inducing into itself
            high = int(fill[c])
            induce(sa[low:high])
            low = high
        induce(sa[tail[c] - smalls[c] : tail[c]])
    return sa


def adjacent_prefixes(text: bytes, sa: np.ndarray, depth: int = SPAN) -> np.ndarray:
    """Length of the common prefix of each suffix and its predecessor in ``sa``, up to at least ``depth``."""
    levels = doubled(np.frombuffer(text, np.uint8), depth.bit_length() - 1)
    a, b = sa[1:], sa[:-1]
    out = np.zeros(len(sa), np.int64)
    n = out[1:]
    for k in range(len(levels) - 1, -1, -1):
        h = levels[k]
        p, q = a + n, b + n
        inside = np.maximum(p, q) < len(h)
        same = np.zeros(len(n), bool)
        same[inside] = h[p[inside]] == h[q[inside]]
        n += same << k
    return out


def repeated_windows(spans: list[bytes], places: np.ndarray) -> list[np.ndarray]:
    """For each span the starts of its SPAN-byte windows that also occur at another place; places[i] tells where
    span i begins, and two windows at one place (of overlapping spans) are no repeat."""
    text = b"\xff".join(spans) + b"\xff"
    size = np.array([len(s) for s in spans])
    first = np.cumsum(size + 1) - (size + 1)
    sa = suffix_array(text)
    prefix = adjacent_prefixes(text, sa)
    owner = np.searchsorted(first, sa, "right") - 1
    offset = sa - first[owner]
    valid = offset + SPAN <= size[owner]
    same = (prefix >= SPAN) & valid
    same[1:] &= valid[:-1]
    for i in np.flatnonzero(same).tolist():  # hashes told the prefixes; the bytes decide
        same[i] = text[sa[i] : sa[i] + SPAN] == text[sa[i - 1] : sa[i - 1] + SPAN]
    run = np.cumsum(~same) - 1
    place = places[owner] + offset
    heads = np.flatnonzero(~same)
    low, high = np.minimum.reduceat(place, heads), np.maximum.reduceat(place, heads)
    hit = (low < high)[run] & valid
    out: list[list[int]] = [[] for _ in spans]
    for i, o in zip(owner[hit].tolist(), offset[hit].tolist()):
        out[i].append(o)
    return [np.sort(np.array(o, np.int64)) for o in out]


def united(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal intervals; touching ones are one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(s[1:] > e[:-1])
    return list(zip(s[np.append(0, cut + 1)].tolist(), e[np.append(cut, len(e) - 1)].tolist()))


def _cut_pieces(batches):
    """The bytes of the windows, to the side that is asked for, of the pieces wanted from each document; of repeated
    rows one will do."""
    seen = set()
    for whole in batches:
        for batch in slices(whole):
            rows = []
            for doc, mark, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "mark", "text", "wanted"))):
                if (doc, mark) in seen:
                    continue
                seen.add((doc, mark))
                raw = (text or "").encode("utf-8", "surrogatepass")
                for w in wanted:
                    # offsets of the anchor in the windows: from HALF on to one side, below it to the other
                    far, near = (w["far"], max(w["near"], HALF)) if w["side"] == 0 else (min(w["far"], HALF - 1), w["near"])
                    rows.append((w["side"], w["anchor"], w["key"], w["piece"], doc, mark, w["at"] - far, far, raw[w["at"] - far : w["at"] - near + SPAN], w["full"]))
            if rows:
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in CUT.split(", ")])


CUT = "side int, anchor long, key int, piece long, doc_id long, mark long, start long, before int, bytes binary, full boolean"


def _blocks(batches):
    """Repeated spans of pieces, (anchor, piece, from, to) relative to the anchor; rows come sorted by group."""

    def found(rows):
        if len({r[3] for r in rows}) < 2:
            return
        docs: dict = {}
        places = np.array([(docs.setdefault((r[4], r[5]), len(docs)) << 40) + r[6] for r in rows], np.int64)
        for r, starts in zip(rows, repeated_windows([r[8] for r in rows], places)):
            for a, b in united(starts, starts + SPAN):
                yield r[1], r[3], a - r[7], b - r[7]

    def packed(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["anchor", "piece", "low", "high"])

    held, size, last = [], 0, None
    for whole in batches:
        for row in zip(*(whole.column(c).to_pylist() for c in ("side", "anchor", "key", "piece", "doc_id", "mark", "start", "before", "bytes"))):
            if size >= BLOCK and row[:3] != last:
                if out := list(found(held)):
                    yield packed(out)
                held, size = [], 0
            last = row[:3]
            held.append(row)
            size += len(row[8])
    if held and (out := list(found(held))):
        yield packed(out)


def _two(raw: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(raw)
    return d >> 65, d & ((1 << 63) - 1)


CELLS = "anchor long, piece long, side int, low int, n int, i1 long, i2 long, o1 long, o2 long, ip long, op long"


def _cells(batches):
    """For each cell of windows of a piece: digests of the bytes that any window of the cell holds, and of those that
    the piece's windows in it cover together, and hashes of the two places."""
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 3, *[pa.int64()] * 6]
    names = [x.split()[0] for x in CELLS.split(", ")]
    for whole in batches:
        for batch in slices(whole, "bytes"):
            parts = []
            for side, anchor, piece, doc, mark, start, before, raw in zip(*(batch.column(c).to_pylist() for c in ("side", "anchor", "piece", "doc_id", "mark", "start", "before", "bytes"))):
                # o: the anchor's offset in a window; cells are cut at fixed offsets, so those of different pieces are alike
                o, last = before, before - (len(raw) - SPAN)
                while o >= last:
                    c = o // CELL * CELL
                    to = max(last, c)
                    p, q = before - o, before - to  # window starts
                    inner, outer = raw[before - c : before - c - CELL + 1 + SPAN], raw[p : q + SPAN]
                    place = [xxhash.xxh3_64_intdigest(repr((doc, mark, start + k))) >> 1 for k in (before - c, p)]
                    parts.append((anchor, piece, side, -o, q - p + 1, *_two(inner + c.to_bytes(2, "big")), *_two(outer), *place))
                    o = to - 1
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*parts), kinds)], names)


WINDOWS = "w1 long, w2 long, place long, anchor long, piece long, low int"


def _windows(batches):
    """A digest of every window of the cells wanted from a piece, with its place and where it starts."""
    for whole in batches:
        for batch in slices(whole, "bytes"):
            parts = []
            for anchor, piece, doc, mark, start, before, raw, wanted in zip(*(batch.column(c).to_pylist() for c in ("anchor", "piece", "doc_id", "mark", "start", "before", "bytes", "wanted"))):
                for w in wanted:
                    for low in range(w["low"], w["low"] + w["n"]):
                        k = before + low
                        place = xxhash.xxh3_64_intdigest(repr((doc, mark, start + k))) >> 1
                        parts.append((*_two(raw[k : k + SPAN]), place, anchor, piece, low))
            if parts:
                kinds = [pa.int64()] * 5 + [pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*parts), kinds)], ["w1", "w2", "place", "anchor", "piece", "low"])


def _twice(rows: DataFrame, a: str, b: str, place: str) -> DataFrame:
    """The digests (a, b) that occur at more than one place."""
    return rows.groupBy(a, b).agg(F.min(place).alias("__p"), F.max(place).alias("__q")).filter("__p < __q").select(a, b)


def full_groups(cut: DataFrame) -> DataFrame:
    """(anchor, piece, low, high) of repeated windows in groups of any size, by digests and counts."""
    cells = staged(cut.mapInArrow(_cells, CELLS), "cells")
    live = cells.join(_twice(cells, "i1", "i2", "ip"), ["i1", "i2"], "left_semi")
    live = staged(live.join(_twice(cells, "o1", "o2", "op").withColumn("done", F.lit(True)), ["o1", "o2"], "left"), "live-cells")
    done, open_ = live.filter("done"), live.filter("done is null")
    # a window of an open cell may have its like in a cell that is done: one example of each such cell is looked at
    kept = ["anchor", "piece", "side", "low", "n"]
    example = done.groupBy("o1", "o2", "i1", "i2").agg(F.min(F.struct(*kept)).alias("e")).join(open_.select("i1", "i2").distinct(), ["i1", "i2"], "left_semi").select("e.*")
    wanted = open_.select(*kept).unionByName(example).groupBy("anchor", "piece", "side").agg(F.collect_list(F.struct("low", "n")).alias("wanted"))
    windows = staged(cut.join(wanted, ["anchor", "piece", "side"]).mapInArrow(_windows, WINDOWS), "windows")
    counted = windows.join(_twice(windows, "w1", "w2", "place"), ["w1", "w2"], "left_semi").select("anchor", "piece", "low", (F.col("low") + SPAN).alias("high"))
    return done.select("anchor", "piece", "low", (F.col("low") + F.col("n") - 1 + SPAN).alias("high")).unionByName(counted)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, low, high): byte spans of ``docs(doc_id, text, mark)`` that repeated windows cover."""
    rows = staged(docs.mapInArrow(_hashes, "doc_id long, mark long, at int, far int, near int, anchor long, piece long, left int, right int"), "anchors")
    pieces = rows.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("copies"))
    shared = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("all")).filter(F.col("all") > 1).select("anchor", "kinds")
    known = pieces.join(shared, "anchor")
    again = staged(rows.join(known, ["anchor", "piece"]), "repeated")
    whole = again.filter("copies > 1").select("doc_id", "mark", (F.col("at") - F.col("far")).alias("low"), (F.col("at") - F.col("near") + SPAN).alias("high"))
    # one example of each piece that has others with the same anchor, for each side it can share
    kept = ["doc_id", "mark", "at", "far", "near", "left", "right"]
    example = again.filter("kinds > 1").groupBy("anchor", "piece").agg(F.min(F.struct(*kept)).alias("e")).select("anchor", "piece", "e.*")
    sides = example.select("anchor", "piece", "doc_id", "mark", "at", "far", "near", F.posexplode(F.array("left", "right")).alias("side", "key")).filter("key >= 0")
    sides = staged(sides, "examples")
    groups = sides.groupBy("side", "anchor", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("side", "anchor", "key", (F.col("n") > GROUP).alias("full"))
    groups = staged(groups, "groups")  # read back, both sides of the join are plain exchanges, which a hot group's rows can be split over
    wanted = sides.join(groups, ["side", "anchor", "key"]).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("side", "anchor", "key", "piece", "at", "far", "near", "full")).alias("wanted"))
    own = docs.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "text")
    cut = own.join(wanted, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark"))).select("doc_id", "mark", "text", "wanted").mapInArrow(_cut_pieces, CUT)
    cut = staged(cut, "pieces")
    order = ["side", "anchor", "key"]
    size = cut.filter("not full").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK + 1)
    blocks = cut.filter("not full").repartition(parts, *order).sortWithinPartitions(*order, "piece", "doc_id").mapInArrow(_blocks, "anchor long, piece long, low int, high int")
    found = blocks.unionByName(full_groups(cut.filter("full"))).distinct()
    partly = again.filter("kinds > 1 and copies = 1").select("anchor", "piece", "doc_id", "mark", "at").join(found, ["anchor", "piece"])
    return whole.unionByName(partly.select("doc_id", "mark", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high")))


def _cut_spans(keep: bool):
    def mapped(batches):
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    runs = united(np.array([s["low"] for s in spans], np.int64), np.array([s["high"] for s in spans], np.int64)) if spans else []
                    at, rest = 0, []
                    for a, b in runs:
                        rest.append(raw[at:a])
                        at = b
                    left = b"".join([*rest, raw[at:]])
                    row = (len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest())
                    rows.append((*row, left, runs) if keep else row)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64()))]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed"]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], names[: len(cols) + 1])

    return mapped


def remove_repeats(docs: DataFrame, keep: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with keep also kept and removed.

    Null text counts as empty. Rows with the same doc_id and text are two documents that repeat each other. Texts
    under SPAN bytes keep all; longer ones are read whole. An empty table gives no rows. Null ids are ids like any
    other. Further columns, whatever their names, are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    # repeated rows have the same spans, so a set holds them once, however many rows there are
    spans = repeated_spans(rows).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "d", "mark": "m"})
    both = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left").select("doc_id", "text", "spans")
    more = ", kept binary, removed array<array<long>>" if keep else ""
    return both.mapInArrow(_cut_spans(keep), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + more)


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))
