"""Exact dedup by a tree-merge of sorted digest runs, in DataFrame functions only.

Each document gets a digest of its normalised text and a leaf, a hash of its doc_id. The documents of a leaf
form a run: one row per digest with the smallest doc_id and a count. In each binomial round the runs of
2**FAN_BITS neighbours are merged into one, until a single run per digest is left (a run is itself spread by
digest over all tasks, so no task holds a whole run). At every level rows merge only if digest, byte length and
a second, independent hash agree, so a smallest id is never taken over from a text that merely collides.
The winners then go back down the same tree: at each level a key meets at most 2**FAN_BITS rows, so a group
of copies that holds a third of the corpus is dealt over all leaves and never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.common import documents, fresh, id_and_text, staged

WHITE = r"[\x20\x09-\x0D]+"
#: Runs merged per round: 2**FAN_BITS.
FAN_BITS = 3
KEY = ["digest", "n_bytes", "mark"]


def digests(docs: DataFrame, leaf_bits: int) -> DataFrame:
    text = F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " ")
    return (
        id_and_text(docs)
        .select("doc_id", text.alias("norm"))
        .select(
            "doc_id",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.octet_length("norm").alias("n_bytes"),
            F.xxhash64("norm").alias("mark"),
            # a row's leaf doesn't depend on its doc_id, so repeated rows are spread as well
            F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(1 << leaf_bits)).alias("run"),
        )
    )


def exact_dedup(docs: DataFrame, leaf_bits: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. A null doc_id is larger than any other: it stays only where its whole group
    has none. Of repeated rows (same doc_id, equal text) exactly one is kept. An empty table gives no rows. Texts of
    any length count whole; further columns are not read.
    leaf_bits: the tree has 2**leaf_bits leaves; by default about two leaves per shuffle partition.
    """
    spark = docs.sparkSession
    if leaf_bits is None:
        leaf_bits = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length() + 1)
    rows = staged(digests(docs, leaf_bits), "digests")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "run")
    levels = [rows.groupBy(*KEY, "run").agg(F.min(least).alias("keep"), F.count(F.lit(1)).alias("group_size"))]
    bits, steps = leaf_bits, []
    while bits > 0:
        step = min(FAN_BITS, bits)
        bits -= step
        steps.append(step)
        merged = levels[-1].groupBy(*KEY, F.shiftright("run", step).alias("run"))
        levels.append(merged.agg(F.min("keep").alias("keep"), F.sum("group_size").alias("group_size")))
    won = levels.pop()
    for step in reversed(steps):
        below = levels.pop().select(*KEY, "run", F.shiftright("run", step).alias("above"))
        won = below.join(won.withColumnRenamed("run", "above"), [*KEY, "above"]).select(*KEY, "run", "keep", "group_size")
    same = Window.partitionBy(*KEY, "run", "doc_id").orderBy("doc_id")
    joined = rows.join(won, [*KEY, "run"]).withColumn("copy", F.row_number().over(same))
    return joined.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("run") == F.col("keep.run")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names; nulls, repeats and empty tables as above."""
    none, at, sha = key = fresh(docs, "none", "at", "sha")
    kept = exact_dedup(docs).filter("kept").select(F.col("doc_id").isNull().alias(none), F.coalesce("doc_id", F.lit(0)).alias(at), F.unhex("text_sha256").alias(sha))
    doc_id, norm = F.col("doc_id").cast("long"), F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), WHITE, " ")
    keyed = docs.withColumns({none: doc_id.isNull(), at: F.coalesce(doc_id, F.lit(0)), sha: F.unhex(F.sha2(norm, 256))})
    # repeated rows are one before anything is dealt
    return keyed.dropDuplicates(key).join(kept, key, "left_semi").select(docs.columns)


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
