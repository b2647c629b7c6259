"""A stream of raw texts through the cleaning columns: stateless, so it needs no watermark and keeps no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkmill.functions.text import count_words
from inkmill.operators.cleaning import drop_page_number_lines, sanitize_prose


def read_texts(spark: SparkSession, path: str, schema: str = "doc_id long, text string", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def cleaned(rows: DataFrame) -> DataFrame:
    """doc_id, text and n_words of rows(doc_id, text); works on batches and streams alike."""
    text = drop_page_number_lines(sanitize_prose(F.coalesce("text", F.lit(""))))
    return rows.select("doc_id", text.alias("text")).withColumn("n_words", count_words("text"))


def write_latest(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends each micro-batch to a table once, by the checkpoint's account of what was done."""
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
