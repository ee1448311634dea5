"""Stages over files as they come: each file once, by checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lexmill.functions.text import text_hash


def stream(spark: SparkSession, path: str, schema: StructType | str, file_format: str = "json", files_at_once: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).format(file_format).load(path)


def run_stage(source: DataFrame, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Applies a batch stage to each micro-batch. A batch writes to a folder of its own number and overwrites it, so that one that is run again counts once."""

    def each(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={number}")

    w = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def new_texts(source: DataFrame, at: str, text: str = "text", delay: str = "1 day") -> DataFrame:
    """Rows whose text did not come before within the delay."""
    return source.withWatermark(at, delay).withColumn("text_hash", text_hash(text)).dropDuplicatesWithinWatermark(["text_hash"])


def windowed_counts(source: DataFrame, at: str, key: str, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """(start, end, key, n) of tumbling windows; rows later than the delay are left out."""
    return source.withWatermark(at, delay).groupBy(F.window(at, width), key).agg(F.count("*").alias("n")).select("window.start", "window.end", key, "n")
