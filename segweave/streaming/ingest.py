"""Incremental, restartable ingestion: each new manifest file once, each recording's latest rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import publish


def latest(rows: DataFrame) -> DataFrame:
    """Of the rows (with the file that they came from, _at and _path) those of each recording's newest file; of equal times the last path."""
    files = rows.groupBy("source_id", "_at", "_path").agg(F.count(F.lit(1)).alias("_rows"))
    newest = files.groupBy("source_id").agg(F.max(F.struct("_at", "_path")).alias("_new")).select(F.col("source_id").alias("_id"), "_new")
    kept = (F.col("source_id") == F.col("_id")) & (F.struct("_at", "_path") == F.col("_new"))
    return rows.join(newest, kept, "left_semi").drop("_at", "_path")


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str) -> None:
    """Read the JSONL files that are new since the last run and replace their recordings in target.

    The checkpoint makes a rerun do nothing; a recording that comes again
    overwrites its own rows, and of a recording that several new files hold, the newest
    file's rows are taken.
    """

    def write(batch: DataFrame, _: int) -> None:
        publish(latest(batch), target)

    stream = spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(source)
    stream = stream.select("*", F.col("_metadata.file_modification_time").alias("_at"), F.col("_metadata.file_path").alias("_path"))
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
