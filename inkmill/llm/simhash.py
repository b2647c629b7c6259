"""SimHash near-dedup, linked by a generalised pigeonhole search.

Fingerprints: lower-cased words, 3-word shingles with repeats, XXH64 (seed 42), majority bit. Equal fingerprints
are one node. The 64 bits are grouped so that correlated bits share a partition, and a dynamic programme gives
each partition a threshold t (-1: not probed) with sum(t) = radius - partitions + 1, the least sum under which
two fingerprints within the radius must agree within t on some partition, at the least estimated candidate count.
A node probes every key within t of its own in each partition; candidates are verified on all 64 bits.
A bucket of more than BUCKET nodes would cost the square of its size. Its nodes, and those that probe it, go
another exact way: two fingerprints are within 2 bits of each other exactly if their balls of radius 1 meet,
so each such node is dealt to the 65 points of its ball, and the nodes at a point (at most 65) are linked to the
smallest of them. That is linear in the nodes, keeps every component whole and emits no pairs within a group.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import documents, fresh, id_and_text, slices, staged, texts
from inkmill.llm.components import components

WORDS, SEED, RADIUS, PARTS, BUCKET = 3, 42, 2, 3, 32
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: str, n: int = WORDS) -> int:
    """Unsigned 64-bit SimHash; 0 where there is no word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    buf = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[min(n, len(words)) - 1 :].tolist()
    digest, count, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(ends)
    for at in range(0, total, BLOCK):
        h = np.array([digest(buf[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for whole in batches:
        for batch in slices(whole):
            fp = np.array([fingerprint(t) for t in texts(batch)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(fp)], ["doc_id", "mark", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text that tells rows of one doc_id apart, and the fingerprint."""
    rows = id_and_text(docs).withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.mapInArrow(_fingerprints, "doc_id long, mark long, fp long")


def _gram(batches):
    """Sums of products of bits, over all rows of a task."""
    total = np.zeros((64, 64), np.float64)
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        for at in range(0, len(fp), BLOCK):
            bits = np.unpackbits(fp[at : at + BLOCK].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel())], ["at", "s"])


def grouped_bits(gram: np.ndarray, n: float, parts: int) -> list[list[int]]:
    """Bits grouped greedily: each partition starts at the free bit with the strongest correlations and takes
    the free bits that correlate most with those it has."""
    p = np.diag(gram) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((gram / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = list(range(64)), []
    for size in [64 // parts + (i < 64 % parts) for i in range(parts)]:
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: (corr[b, group].sum(), -b)))
            free.remove(group[-1])
        out.append(sorted(group))
    return out


def allocated(cost: list[list[float]], radius: int) -> list[int]:
    """Thresholds with sum radius - len(cost) + 1 and the least summed cost; cost[i][t + 1] is that of t in partition i."""
    least = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for (used, (c, ts)), (k, more) in itertools.product(least.items(), enumerate(row)):
            at = used + k - 1
            if at not in step or c + more < step[at][0]:
                step[at] = (c + more, [*ts, k - 1])
        least = step
    return least[radius - len(cost) + 1][1]


def _key(fp: Column, bits: list[int]) -> Column:
    out = F.lit(0).cast("long")
    for j, b in enumerate(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1)), j))
    return out


def _probes(key: Column, width: int, t: int) -> Column:
    masks = [sum(1 << b for b in c) for r in range(t + 1) for c in itertools.combinations(range(width), r)]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: key.bitwiseXOR(m))


def allotted(nodes: DataFrame, radius: int, parts: int) -> tuple[list[list[int]], DataFrame, DataFrame, list[int]]:
    """For distinct ``nodes(fp)``: the bits of each partition, (fp, part, key), the size of each bucket, and thresholds."""
    gram = np.zeros(4096)
    for at, s in nodes.select("fp").mapInArrow(_gram, "at long, s double").groupBy("at").agg(F.sum("s")).collect():
        gram[at] = s
    gram, n = gram.reshape(64, 64), nodes.count()
    groups = grouped_bits(gram, n, parts)
    fp = F.col("fp")
    keyed = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("part"), _key(fp, g).alias("key")) for i, g in enumerate(groups)])).alias("k")).select("fp", "k.part", "k.key")
    sizes = staged(keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("size")), "buckets")
    same = {r.part: float(r.pairs) for r in sizes.groupBy("part").agg(F.sum(F.col("size") * (F.col("size") - 1) / 2).alias("pairs")).collect()}
    p = np.diag(gram) / max(n, 1)
    odds = [(2 * p * (1 - p) / np.maximum(1 - 2 * p * (1 - p), 1e-9))[g] for g in groups]
    cost = []
    for i, o in enumerate(odds):
        zero, one, two = same.get(i, 0.0) + n, o.sum(), (o.sum() ** 2 - (o**2).sum()) / 2
        cost.append([0.0, zero, zero * (1 + one) + n * len(o), zero * (1 + one + two) + n * len(o) ** 2 / 2])
    return groups, keyed, sizes, allocated(cost, radius)


def links(nodes: DataFrame, radius: int = RADIUS, parts: int = PARTS, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) that connect all ``nodes(fp)`` within ``radius`` bits; nodes are distinct."""
    if radius != 2:
        raise ValueError("balls of radius 1 meet exactly within 2 bits; other radii need another way for full buckets")
    fp = F.col("fp")
    groups, keyed, sizes, t = allotted(nodes, radius, parts)
    probed = None
    for i, g in enumerate(groups):
        if t[i] >= 0:
            some = nodes.select("fp", F.lit(i).alias("part"), F.explode(_probes(_key(fp, g), len(g), t[i])).alias("key"))
            probed = some if probed is None else probed.unionByName(some)
    full = sizes.filter(F.col("size") > bucket).select("part", "key")
    hot = probed.join(full, ["part", "key"], "left_semi").select("fp").distinct()
    index, probe = keyed.join(full, ["part", "key"], "left_anti"), probed.join(full, ["part", "key"], "left_anti")
    near = probe.withColumnRenamed("fp", "u").join(index.withColumnRenamed("fp", "v"), ["part", "key"])
    near = near.filter((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v")
    ball = F.array(fp, *[fp.bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), b)) for b in range(64)])
    meet = hot.select("fp", F.explode(ball).alias("z")).groupBy("z").agg(F.collect_set("fp").alias("at")).filter(F.size("at") > 1)
    star = meet.select(F.explode("at").alias("u"), F.array_min("at").alias("v")).filter("u <> v")
    return near.unionByName(star)


def _probes_in(part: int, fp: Column, bits: list[int], t: int) -> Column:
    return F.transform(_probes(_key(fp, bits), len(bits), t), lambda k: F.struct(F.lit(part).alias("part"), k.alias("key")))


def searched(nodes: DataFrame, radius: int, parts: int, bucket: int) -> DataFrame:
    """Pairs (u, v) of distinct ``nodes(fp)`` within ``radius`` bits: all that meet in a bucket of at most ``bucket`` nodes, and
    of those that probe a fuller one only the pairs with its least fingerprint; the rest needs another way."""
    fp = F.col("fp")
    groups, keyed, sizes, t = allotted(nodes, radius, parts)
    # all partitions in one list: over a union, joins with no full bucket would vanish from some parts of the plan only
    lists = F.concat(*[_probes_in(i, fp, g, t[i]) for i, g in enumerate(groups) if t[i] >= 0])
    probed = nodes.select("fp", F.explode(lists).alias("k")).select("fp", "k.part", "k.key")
    full = sizes.filter(F.col("size") > bucket).select("part", "key")
    least = keyed.join(full, ["part", "key"], "left_semi").groupBy("part", "key").agg(F.min("fp").alias("v"))
    far = probed.join(least, ["part", "key"]).select(fp.alias("u"), "v")
    index, probe = keyed.join(full, ["part", "key"], "left_anti"), probed.join(full, ["part", "key"], "left_anti")
    near = probe.withColumnRenamed("fp", "u").join(index.withColumnRenamed("fp", "v"), ["part", "key"]).select("u", "v")
    found = near.unionByName(far).filter((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius))
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _rooted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fingerprint rows of documents, and (fp, root) of every distinct fingerprint."""
    rows = staged(fingerprints(docs), "fingerprints")
    nodes = staged(rows.select("fp").distinct(), "nodes")
    roots = components(links(nodes))
    return rows, nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null or wordless text has fingerprint zero and links like any other. component_id is the smallest doc_id
    reachable over links of at most 2 differing bits, null only where the whole component has null ids; repeated
    rows come out as often as they go in. An empty table gives no rows. Copies are one node, however many.
    """
    rows, rooted = _rooted(docs)
    named = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(rooted, "fp"), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all columns: of each component the row with the smallest doc_id.

    Null ids come after all others; among rows of one doc_id the hash of the text decides; of rows that agree in
    both, one stays. Further columns may have any name.
    """
    rows, rooted = _rooted(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    # the least row of a fingerprint, then of a component: copies meet as one row
    least = rows.groupBy("fp").agg(F.min(order).alias("e")).join(rooted, "fp").groupBy("root").agg(F.min("e").alias("e"))
    none, at, mark = key = fresh(docs, "none", "at", "mark")
    stay = least.select(F.col("e.none").alias(none), F.coalesce("e.doc_id", F.lit(0)).alias(at), F.col("e.mark").alias(mark))
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.withColumns({none: doc_id.isNull(), at: F.coalesce(doc_id, F.lit(0)), mark: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    return keyed.dropDuplicates(key).join(stay, key, "left_semi").select(docs.columns)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
