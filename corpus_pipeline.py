"""A training-data pipeline over ``documents``: reject, dedup, redact, pack.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that the next stage
gets, written as Parquet and read back. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from inkmill.llm import exact_dedup, near_copies, packing, pii, quality
from inkmill.llm.common import documents, shared_dir


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents whose quality score stays under the threshold go.

    The model is fitted on the labelled rows of ``docs``; without any all score one half and go. Null and wordless texts
    score by the share of good labels. Repeated rows stay or go together; an empty table gives no rows.
    """
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of equal texts, but for white space, the one with the smallest doc_id stays.

    Null counts as empty; null ids come after all others; of repeated rows one stays; an empty table gives no rows.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10 for texts: of each group of near copies (5-word shingles, Jaccard 0.8 or more) the one with the
    smallest doc_id stays.

    Null and wordless texts are one group; null ids come after all others; of repeated rows one stays; an empty table
    gives no rows.
    """
    return near_copies.drop_near_copies(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: personal data in the texts is replaced by its kind, and n_chars counted anew.

    Every row stays, repeated ones and those with null ids too; null texts stay null; an empty table gives no rows.
    """
    return pii.redact(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the pieces of documents that fill the token windows.

    Null text counts as empty and is one id; repeated rows and null ids are packed like others; an empty table gives no
    rows.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", reject_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The trained stages have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None
