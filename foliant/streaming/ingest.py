"""Incremental ingestion: pages arrive as files, every delivery is handled once, late ones included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def deliveries_per_day(pages: DataFrame, time: str, method: str, late: str = "60 days") -> DataFrame:
    """``day, method, n_pages`` over the time of loading; rows later than the watermark are left out."""
    return pages.withWatermark(time, late).groupBy(F.window(time, "1 day").alias("w"), F.coalesce(F.col(method), F.lit("unknown")).alias("method")).agg(F.count("*").alias("n_pages")).select(F.col("w.start").alias("day"), "method", "n_pages")


def once(pages: DataFrame, key: str, time: str, late: str = "60 days") -> DataFrame:
    """The first delivery of each key within the watermark."""
    return pages.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def ingest(pages: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Runs ``work`` on what is new and appends it to ``path``; a batch that is run again replaces its own files."""

    def batch(df: DataFrame, number: int) -> None:
        work(df).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
