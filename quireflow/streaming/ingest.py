"""Resumable ingest of listing files by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.ingest import new_rows
from ..operators.storage import exists


def stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", per_trigger: int = 100) -> DataFrame:
    """New files of a folder as a stream; the checkpoint remembers which were read."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def first_writes(rows: DataFrame, keys: list[str], event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """One row of each key, without a promise which of a batch. With an event time, keys older than the watermark leave the state.

    Without one the state holds every key; ``ingest_first`` needs no state and keeps the first row.
    """
    if event_time:
        return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return rows.dropDuplicates(keys)


def ingest_first(rows: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...], order: str) -> None:
    """Write the first row of each key, whole: of a batch the smallest by ``order``, and what an earlier batch wrote stands.

    The table itself says which keys are known, so no state grows beside it. A batch that comes again after
    a crash gives the same rows in the same place.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = spark.read.option("basePath", path).schema(StructType([*batch.schema.fields, StructField("batch", LongType())])).parquet(path).where(F.col("batch") < number) if exists(spark, path) else None
        new_rows(batch, known, keys, order, None).write.mode("overwrite").parquet(f"{path}/batch={number}")

    rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


def ingest(rows: DataFrame, path: str, checkpoint: str, on_batch: Callable[[DataFrame, int], None] | None = None) -> None:
    """Write what is there now as Parquet and stop; a second call goes on where this one ended.

    ``on_batch`` gets each batch and its number before it is written, and may get one again after a crash.
    """
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if on_batch:
        def both(batch: DataFrame, number: int) -> None:
            on_batch(batch, number)
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

        query = writer.foreachBatch(both).start()
    else:
        query = writer.format("parquet").option("path", path).start()
    query.awaitTermination()


def progress(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Running pages and items of each task, as a streaming aggregate."""
    return rows.groupBy(*keys).agg(F.count("*").alias("items"))
