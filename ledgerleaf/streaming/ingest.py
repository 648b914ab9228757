"""Incremental ingest of a growing folder, and counts that follow new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx


def ingest_folder(spark: SparkSession, folder: str, table: str, state: str, profile: str = "none") -> None:
    """Append all text files that arrived in ``folder`` since the last call to the corpus at ``table``.

    ``state`` remembers what was taken, so that a repeated or restarted call adds nothing twice.
    """
    arrived = (
        spark.readStream.format("text")
        .schema("value STRING")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.txt")
        .load(folder)
    )
    corpus = arrived.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("document_name"),
        tx.clean_text(F.col("value"), profile).alias("text"),
    )
    writer = corpus.writeStream.format("parquet").option("path", table).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()


def running_counts(rows: DataFrame, keys: list[str], table: str, state: str) -> None:
    """Keep the counts per ``keys`` of a stream at ``table``, one version per batch.

    Each batch writes the complete result below its number; a repeated batch
    overwrites its own version and readers take the highest one.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/version={number}")

    stream = counted.writeStream.outputMode("complete").option("checkpointLocation", state)
    stream.foreachBatch(store).trigger(availableNow=True).start().awaitTermination()


def latest_counts(spark: SparkSession, table: str) -> DataFrame:
    versions = spark.read.parquet(table)
    newest = versions.agg(F.max("version").alias("v")).scalar()
    return versions.where(F.col("version") == newest).drop("version")
