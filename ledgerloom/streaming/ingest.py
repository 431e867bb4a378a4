"""Messages as a stream: files of a folder through the batch operators, and counts by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.headers import normalize_subject


def read_messages(spark: SparkSession, folder: str, like: str) -> DataFrame:
    """New Parquet files of a folder, with the schema of the table ``like``."""
    return spark.readStream.schema(spark.read.parquet(like).schema).parquet(folder)


def hourly_volume(messages: DataFrame, late: str = "2 hours") -> DataFrame:
    """Messages by scenario and hour of arrival; later ones than the watermark are left out of closed hours."""
    timed = messages.withWatermark("ingested_ts", late)
    return timed.groupBy(F.window("ingested_ts", "1 hour").alias("hour"), "scenario_id").agg(F.count("*").alias("n")).select("hour.start", "scenario_id", "n")


def append_messages(messages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each batch appended to ``out/batch=<id>``: a repeated batch writes over its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("thread_subject", normalize_subject(F.col("subject"))).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
