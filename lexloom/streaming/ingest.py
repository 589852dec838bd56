"""Structured Streaming: incremental ingest of new files, and windowed counts with late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_table(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 64) -> DataFrame:
    """New Parquet files of a folder (or glob) as a stream of a fixed schema."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingest(stream: DataFrame, transform, out: str, checkpoint: str, keys: list[str]) -> None:
    """Process what is new once and append it to `out`: rows whose keys are there already are skipped, so a replayed batch
    after a lost driver adds nothing twice."""

    def sink(batch: DataFrame, _: int) -> None:
        spark, rows = batch.sparkSession, transform(batch).dropDuplicates(keys)
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
        if fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs):
            rows = rows.join(spark.read.parquet(out).select(*keys), keys, "left_anti")
        rows.write.mode("append").parquet(out)

    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, minutes: int = 60, late: str = "2 hours") -> DataFrame:
    """Count and value per event type and window. Works on streams (late rows beyond `late` are dropped) and on tables."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    g = events.groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a user: events no further than `gap` apart."""
    if events.isStreaming:
        events = events.withWatermark("ts", gap)
    g = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("session_start"), "n")
