"""Near copies by true similarity: texts whose sets of 5-word shingles have a Jaccard index of at least 4/5.

SimHash comes first: fingerprints of ``inkmill.llm.simhash`` within RADIUS bits are found by its generalised pigeonhole
search, verified on the whole sets, and what is linked is one component. In a full bucket each text is verified against
the one of the least fingerprint. No radius of 64 bits finds every pair: at 4/5 fingerprints differ by about ten bits, with
a wide spread, so an exact way for the rest follows, over the pairs of texts that are not yet one component.

This is a prefix filter. A set of n shingles has a prefix, its first n - ceil(4n/5) + 1 shingles in an order
that all sets share; of two sets that are similar enough the first common shingle is in both prefixes, and in that of
the smaller set among the first n - ceil(8n/9) + 1. The order is that of the hashes, but shingles of many texts come
last, so lines that many texts share hardly ever bring texts together; which shingles go last (at most HEAVY, found in
one of SAMPLE texts) changes the work, never the result. Prefixes are dealt once by shingle, sorted, and read in one pass that holds at most BUCKET
rows: candidates come out of it and are verified on the whole sets.
A shingle of more than BUCKET texts would cost the square of its texts. Each of its texts is first verified against
one of them, the centre, which one of CENTRES orders decides by the shingle, so a text meets several centres; then only
texts of different components remain. They are compared by parity bitmaps, whose differences are never more than those
of the sets, in cells of about CELL texts, and only pairs that pass come out, once each. So a group of near copies that
its centres link costs in proportion to its size; in one that they don't link, whose texts are hardly similar, every two
texts are compared, but no pairs are emitted. No pair is left out. The shingles that go last are dealt by a hash of the
text as well, to SALTS tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import freed, fresh, slices, staged, texts, tidied
from inkmill.llm.components import FEW, components
from inkmill.llm.simhash import fingerprint, searched

WORDS, SEED, BUCKET = 5, 42, 32
#: Differing bits within which fingerprints are searched, and partitions: 3 x 22 probes a fingerprint at thresholds 1, 1, 1.
RADIUS, PARTS = 5, 3
#: Shingles that can go last, and bits of the filter in front of the verification: both of a fixed size.
HEAVY, FILTER = 1 << 20, 1 << 23
#: One text in SAMPLE shows which shingles go last: those that SHOWN of these texts have. COUNTED are counted at once.
SAMPLE, SHOWN, COUNTED = 8, 2, 1 << 20
#: Tasks that a shingle that goes last is dealt to, and orders that decide the centre.
SALTS, CENTRES = 16, 16
#: Texts of a shingle that a task compares at once.
CELL = 1024
FIRST, LAST = 1, 2


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased n-word shingles; a shorter text is one shingle, a wordless one none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    buf = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(buf[a:b], SEED) for a, b in zip(starts, ends[min(n, len(words)) - 1 :].tolist())], dtype=np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """A Jaccard index of at least 4/5, in whole numbers."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * common >= 4 * (len(a) + len(b))


def among(found: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Which of ``found`` are in ``heavy``; both sorted."""
    at = np.searchsorted(heavy, found)
    at[at == len(heavy)] = 0
    return heavy[at] == found if len(heavy) else np.zeros(len(found), bool)


def prefix(found: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, int]:
    """The prefix of a set in the order that all sets share, and how many at its end go last."""
    n = len(found)
    size = n - -(-4 * n // 5) + 1 if n else 0
    last = among(found, heavy)
    light = found[~last][:size]
    return np.concatenate([light, found[last][: size - len(light)]]), size - len(light)


def _node(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


@tidied
def _counted(batches) -> Iterator[pa.RecordBatch]:
    """Shingles with how many texts have them, COUNTED at a time."""

    def told(held):
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    held, size = [], 0
    for whole in batches:
        for batch in slices(whole):
            for t in texts(batch):
                held.append(shingles(t))
                size += len(held[-1])
                if size >= COUNTED:
                    yield told(held)
                    held, size = [], 0
    if held:
        yield told(held)


def _keyed(heavy):
    """Fingerprints and prefixes of texts, with the size of the set; kind is FIRST where the shingle is among those that
    decide for the smaller set of a pair, and LAST where it is one of those that go last."""

    @tidied
    def mapped(batches):
        for whole in batches:
            for batch in slices(whole):
                given = texts(batch)
                sets = [shingles(t) for t in given]
                found = [prefix(s, heavy.value) for s in sets]
                keys = [k for k, _ in found]
                flat = np.concatenate(keys)
                # by place in the prefix: whether it is among the first of a smaller set, and whether it goes last
                kind = np.concatenate([(np.arange(len(k)) < len(s) + (-8 * len(s)) // 9 + 1) * FIRST + (np.arange(len(k)) >= len(k) - n) * LAST for s, (k, n) in zip(sets, found)])
                ends = pa.array(np.cumsum([0, *map(len, keys)]).astype(np.int32))
                columns = [pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32())]
                columns.append(pa.array(np.array([fingerprint(t) for t in given], np.uint64).view(np.int64)))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (flat.view(np.int64), kind.astype(np.int8))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), *columns, *lists], ["doc_id", "mark", "node", "size", "fp", "keys", "kinds"])

    return mapped


MET = "u long, v long, h long, size int, first boolean, centre boolean"


def _met(bucket: int):
    """Of prefix rows sorted by shingle and salt: pairs (u, v) that meet at a shingle of few texts, and the texts
    (u) of each other shingle that is h, paired with the first of them, its centre."""

    def pairs(u, v):
        n = len(u)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.bool_())] * 2], MET_NAMES)

    def members(h, node, size, kind, centre):
        alone = node == centre[0]
        near = ~alone & (5 * np.minimum(size, centre[1]) >= 4 * np.maximum(size, centre[1]))
        columns = [pa.array(node), pa.array(np.full(len(node), centre[0]), mask=~near), pa.array(np.full(len(node), h)), pa.array(size.astype(np.int32)), pa.array(kind & FIRST > 0), pa.array(alone)]
        return pa.RecordBatch.from_arrays(columns, MET_NAMES)

    def few(node, size, kind, start, count):
        for k in np.unique(count):
            at = start[count == k][:, None]
            i, j = np.triu_indices(k, 1)
            a, b = (at + i).ravel(), (at + j).ravel()
            small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            first = np.where(size[a] <= size[b], kind[a], kind[b]) & np.where(size[b] <= size[a], kind[b], kind[a]) & FIRST > 0
            some = first & (5 * small >= 4 * large)
            yield node[a[some]], node[b[some]]

    @tidied
    def mapped(batches):
        held = [np.zeros(0, np.int64)] * 5  # rows of the last shingle so far
        full = None  # the shingle and salt that is being passed on, and its centre
        for batch in _and_end(batches):
            if batch is not None:
                held = [np.concatenate([x, batch.column(c).to_numpy()]) for x, c in zip(held, ("h", "salt", "node", "size", "kind"))]
            new = np.append(True, (np.diff(held[0]) != 0) | (np.diff(held[1]) != 0) | (np.diff(held[2]) != 0))[: len(held[0])]
            held = [x[new] for x in held]  # equal sets are one text
            h, salt, node, size, kind = held
            if not len(h):
                continue
            if full:
                n = int(np.argmin(np.append((h == full[0]) & (salt == full[1]), False)))
                if n:
                    yield members(h[0], node[:n], size[:n], kind[:n], full[2])
                h, salt, node, size, kind = held = [x[n:] for x in held]
                if not len(h):
                    continue
                full = None
            start = np.flatnonzero(np.append(True, (np.diff(h) != 0) | (np.diff(salt) != 0)))
            count = np.diff(start, append=len(h))
            many = (count > bucket) | (kind[start] & LAST > 0)
            whole = np.ones(len(start), bool)
            whole[-1] = batch is None or many[-1]
            for i in np.flatnonzero(many).tolist():
                at = slice(start[i], start[i] + count[i])
                full = (h[start[i]], salt[start[i]], (node[start[i]], size[start[i]]))
                yield members(full[0], node[at], size[at], kind[at], full[2])
            full = full if many[-1] else None
            some = whole & ~many & (count > 1)
            if some.any() and len(found := list(few(node, size, kind, start[some], count[some]))):
                yield pairs(*map(np.concatenate, zip(*found)))
            held = [x[len(h) if whole[-1] else start[-1] :] for x in held]

    return mapped


MET_NAMES = [x.split()[0] for x in MET.split(", ")]


def _and_end(batches):
    yield from batches
    yield None


def rough(found: np.ndarray) -> bytes:
    """The upper 16 bits of a set's hashes, in order, as differences: a quarter of it, and easily packed."""
    return np.diff((found >> np.uint64(48)).astype(np.uint16), prepend=np.uint16(0)).tobytes()


def maybe_similar(a: bytes, b: bytes) -> bool:
    """Never false for similar sets: upper bits in common are at least as many as hashes in common."""
    x, y = (np.bincount(np.cumsum(np.frombuffer(s, np.uint16), dtype=np.uint16), minlength=1 << 16) for s in (a, b))
    return 9 * int(np.minimum(x, y).sum()) >= 4 * (len(a) + len(b)) // 2


def _surely_similar(a: bytes, b: bytes) -> bool:
    return similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))


def _packed_sets(wanted, pack):
    @tidied
    def mapped(batches):
        for whole in batches:
            marks = whole.column("mark").to_numpy(zero_copy_only=False)
            at = marks & (FILTER - 1)
            for batch in slices(whole.filter(pa.array(wanted.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1))):
                sets = [shingles(t) for t in texts(batch)]
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), pa.array([pack(s) for s in sets], pa.binary())], ["node", "hashes"])

    return mapped


def _passed(test):
    def mapped(batches):
        for whole in batches:
            for batch in slices(whole, "a"):
                a, b = (batch.column(c).to_pylist() for c in ("a", "b"))
                yield batch.select(["u", "v"]).filter(pa.array(map(test, a, b), pa.bool_()))

    return mapped


def _close(a: Column, b: Column) -> Column:
    """Sizes that a Jaccard index of 4/5 allows."""
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def parity(found: np.ndarray) -> bytes:
    """Bits that tell whether an odd number of hashes falls on them, twice as many as hashes at least: two sets differ
    in at least as many hashes as their bitmaps in bits. Halves folded together are the bitmap of half the size."""
    bits = 1 << max(6, (2 * len(found) - 1).bit_length()) if len(found) else 64
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sign: bytes, size: int) -> np.ndarray:
    """A bitmap of ``size`` bytes, as words."""
    x = np.frombuffer(sign, np.uint64)
    while len(x) * 8 > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _apart(batches):
    """Pairs of texts of different components that share a shingle and whose bitmaps don't tell them apart, each at the
    least shingle they share; rows come sorted by cell."""

    def compared(rows):
        h = rows[0][0]
        block, node, root, size = (np.array(c, np.int64) for c in list(zip(*rows))[3:7])
        signs, shared = [r[7] for r in rows], [np.frombuffer(r[8], np.int64) for r in rows]
        length, place = np.array([len(x) for x in signs]), np.arange(len(rows))
        alone = rows[0][1] == rows[0][2]
        for n in np.unique(length).tolist():
            longer = np.flatnonzero(length >= n)
            words = np.stack([folded(signs[i], n) for i in longer])
            for i in np.flatnonzero(length == n).tolist():
                some = (root[longer] != root[i]) & ((length[longer] > n) | (place[longer] > i)) & (alone | (block[longer] != block[i]))
                some &= 5 * np.minimum(size[longer], size[i]) >= 4 * np.maximum(size[longer], size[i])
                at = np.flatnonzero(some)
                apart = np.bitwise_count(words[at] ^ folded(signs[i], n)).sum(1, dtype=np.int64)
                for j in longer[at[9 * apart <= size[longer[at]] + size[i]]].tolist():
                    if np.intersect1d(shared[i], shared[j], assume_unique=True)[0] == h:
                        yield node[i], node[j]

    def packed(found):
        u, v = (np.array(x, np.int64) for x in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for _, rows in groupby(_rows_of(batches, "h", "lo", "hi", "block", "node", "root", "size", "sign", "shared"), key=lambda r: r[:3]):
        if found := list(compared(list(rows))):
            yield packed(found)


def _flat_lists(batches):
    for batch in batches:
        lists = [np.array(x, np.int64).tobytes() for x in batch.column("hs").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(lists, pa.binary())], ["node", "shared"])


def _rows_of(batches, *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _packed(some: DataFrame, nodes: DataFrame, rows: DataFrame, pack, name: str) -> DataFrame:
    """(node, hashes) with the packed sets of ``some(node)``. Other texts are left out before anything is dealt, by a
    filter on the hash of the text; what else gets through it goes with the join."""
    at = F.shiftright(F.col("e.mark").bitwiseAND(F.lit(FILTER - 1)), 3).alias("at")
    bits = nodes.join(some, "node", "left_semi").groupBy(at).agg(F.expr("bit_or(shiftleft(1, cast(e.mark & 7 as int)))").alias("b")).toPandas()
    wanted = np.zeros(FILTER >> 3, np.uint8)
    wanted[bits["at"].to_numpy(np.int64)] = bits["b"].to_numpy(np.int64)
    sets = rows.mapInArrow(_packed_sets(rows.sparkSession.sparkContext.broadcast(wanted), pack), "node long, hashes binary")
    return staged(sets.join(some, "node", "left_semi").groupBy("node").agg(F.first("hashes").alias("hashes")), name)


def _tested(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, pack, test, name: str) -> DataFrame:
    """The pairs (u, v) whose packed sets pass the test."""
    some = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    sets = _packed(some, nodes, rows, pack, name + "-sets")
    freed(rows.sparkSession)
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v")
    return staged(both.select("u", "v", "a", "b").mapInArrow(_passed(test), "u long, v long"), name)


def _similar_pairs(pairs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar by their whole sets; most others are told by a quarter of each hash."""
    pairs = staged(pairs.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "candidates")
    likely = _tested(pairs, nodes, rows, rough, maybe_similar, "likely")
    return _tested(likely, nodes, rows, np.ndarray.tobytes, _surely_similar, "similar")


def by_fingerprint(nodes: DataFrame, rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(node, root) of the texts that similar pairs with fingerprints within RADIUS bits link: all pairs that meet in a
    bucket of at most ``bucket`` fingerprints, of at most ``bucket`` texts each. In a fuller one texts are verified
    against that of the least fingerprint, and of more texts with one fingerprint the least stands for them."""
    fps = nodes.groupBy("fp").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n"))
    sized = staged(nodes.select("fp", "node", "size").join(fps, "fp"), "fingerprints")
    found = searched(sized.filter("node = least").select("fp"), RADIUS, PARTS, bucket)
    named = lambda x: sized.filter((F.col("n") <= bucket) | (F.col("node") == F.col("least"))).select(F.col("fp").alias(x), F.col("node").alias(x + "n"), F.col("size").alias(x + "s"))
    same = sized.select(F.col("fp").alias("v"), F.col("node").alias("un"), F.col("size").alias("us")).join(named("v"), "v")
    met = found.join(named("u"), "u").join(named("v"), "v").select("un", "us", "vn", "vs").unionByName(same.select("un", "us", "vn", "vs"))
    met = met.filter((F.col("un") != F.col("vn")) & _close(F.col("us"), F.col("vs"))).select(F.least("un", "vn").alias("u"), F.greatest("un", "vn").alias("v"))
    return components(_tested(staged(met.distinct(), "fingerprint-pairs"), nodes, rows, np.ndarray.tobytes, _surely_similar, "near"), few=FEW)


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) of texts that are not of one component."""
    for x in ("u", "v"):
        pairs = pairs.join(roots.select(F.col("node").alias(x), F.col("root").alias(x + "r")), x, "left")
    return pairs.filter(F.coalesce("ur", "u") != F.coalesce("vr", "v")).select("u", "v")


def _most(shown: DataFrame, most: int) -> np.ndarray:
    """The shingles h of shown(h, n) with the largest counts, about ``most`` of them, sorted; of a count that is cut
    through, a share by hash. The driver gets a number for each count, then only these shingles."""
    capped = shown.select("h", F.least("n", F.lit(1 << 16)).alias("n"))
    left, whole = most, F.lit(False)
    for n, k in sorted(((r.n, r.k) for r in capped.groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True):
        if k > left:
            whole = whole | ((F.col("n") == n) & (F.pmod(F.xxhash64("h"), F.lit(1000)) < 1000 * left // k))
            break
        whole, left = F.col("n") >= n, left - k
    return np.sort(capped.filter(whole).select("h").toPandas()["h"].to_numpy(np.int64).view(np.uint64))


def _rooted(rows: DataFrame, bucket: int, most: int) -> DataFrame:
    """node, root and e, the least row of each distinct set; sets in one component have one root."""
    spark = rows.sparkSession
    shown = rows.filter(F.pmod(F.shiftright("mark", 8), F.lit(SAMPLE)) == 0).mapInArrow(_counted, "h long, n long")
    often = _most(staged(shown.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= SHOWN), "shown"), most)
    keyed = staged(rows.mapInArrow(_keyed(spark.sparkContext.broadcast(often)), "doc_id long, mark long, node long, size int, fp long, keys array<long>, kinds array<tinyint>"), "prefixes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    nodes = staged(keyed.groupBy("node").agg(F.min(order).alias("e"), F.first("size").alias("size"), F.min("fp").alias("fp"), F.count(F.lit(1)).alias("copies")), "nodes")
    # of equal sets one is dealt; read back, the few that have copies are as small as their files say
    copied = staged(nodes.filter("copies > 1").select("node", "e"), "copied")
    once = keyed.join(copied, "node", "left").filter(F.col("e").isNull() | F.col("e").eqNullSafe(order))
    flat = once.select("node", "size", F.explode(F.arrays_zip("keys", "kinds")).alias("k")).select(F.col("k.keys").alias("h"), "node", "size", F.col("k.kinds").cast("int").alias("kind"))
    flat = flat.withColumn("salt", F.when(F.col("kind") >= LAST, F.pmod("node", F.lit(SALTS)).cast("int")).otherwise(0))
    dealt = flat.repartition("h", "salt").sortWithinPartitions("h", "salt", F.xxhash64("node", F.pmod("h", F.lit(CENTRES))), "node")
    met = staged(dealt.mapInArrow(_met(bucket), MET), "met")
    freed(spark)
    full = met.filter("h is not null").select("h", F.col("u").alias("node"), "size", "first", "centre")
    tops = full.filter("centre")
    top = tops.groupBy("h").agg(F.min(F.struct("node", "size")).alias("l"))
    linked = tops.join(top, "h").filter(_close(F.col("size"), F.col("l.size"))).select(F.col("node").alias("u"), F.col("l.node").alias("v"))
    near = staged(by_fingerprint(nodes, rows, bucket), "near")
    edges = _similar_pairs(_across(met.filter("v is not null").select("u", "v").unionByName(linked), near), nodes, rows)
    edges = edges.unionByName(near.select(F.col("node").alias("u"), F.col("root").alias("v")))
    roots = staged(components(edges, few=FEW), "roots")
    freed(spark)
    # full shingles: what is not yet one component is compared across components
    held = full.join(roots, "node", "left").select("h", "node", "size", F.coalesce("root", "node").alias("root"))
    open_ = held.groupBy("h").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("n")).filter("a <> b")
    members = staged(held.join(open_.select("h", (F.ceil(F.col("n") / CELL)).cast("int").alias("blocks")), "h"), "open")
    if not members.isEmpty():
        shared = members.groupBy("node").agg(F.sort_array(F.collect_set("h")).alias("hs"))
        shared = shared.mapInArrow(_flat_lists, "node long, shared binary")
        signs = _packed(members.select("node").distinct(), nodes, rows, parity, "signs").withColumnRenamed("hashes", "sign")
        block = F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block")
        cells = members.select("h", "node", "root", "size", block, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        cells = cells.select("*", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).join(shared, "node").join(signs, "node")
        across = cells.repartition("h", "lo", "hi").sortWithinPartitions("h", "lo", "hi", "node").mapInArrow(_apart, "u long, v long")
        roots = components(edges.unionByName(_similar_pairs(across, nodes, rows)), few=FEW)
    return nodes.select("node", "e").join(roots, "node", "left").select("e", F.coalesce("root", "node").alias("root"))


def drop_near_copies(docs: DataFrame, bucket: int = BUCKET, heavy: int = HEAVY) -> DataFrame:
    """The documents that stay, with all columns: of each group linked by similar pairs the row with the smallest doc_id.

    Texts with equal sets are one node, wordless and null ones too. Null ids come after all others; among rows of one
    doc_id the hash of the text decides; of rows that agree in both, one stays. An empty table gives no rows. Texts of
    any length are compared whole. Further columns may have any name.
    """
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"))
    least = _rooted(rows, bucket, heavy).groupBy("root").agg(F.min("e").alias("e"))
    none, at, mark = key = fresh(docs, "none", "at", "mark")
    stay = least.select(F.col("e.none").alias(none), F.coalesce("e.doc_id", F.lit(0)).alias(at), F.col("e.mark").alias(mark))
    keyed = docs.withColumns({none: doc_id.isNull(), at: F.coalesce(doc_id, F.lit(0)), mark: F.xxhash64(F.coalesce(text, F.lit("")))})
    # repeated rows are one before anything is dealt
    return keyed.dropDuplicates(key).join(stay, key, "left_semi").select(docs.columns)
