"""Incremental runs: a stream of arriving pages against the ledger, and event-time counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, folder: str, schema, glob: str = "*.parquet", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_seen(pages: DataFrame, key: list[str], ts: str, late: str | None = None) -> DataFrame:
    """Each key's first row. With ``late``, state older than that goes, and a key may come again after it; without, none goes."""
    return pages.withWatermark(ts, late).dropDuplicatesWithinWatermark(key) if late else pages.dropDuplicates(key)


def counts(events: DataFrame, ts: str, late: str, size: str, slide: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Rows by event-time window, tumbling or sliding."""
    frame = F.window(ts, size, slide) if slide else F.window(ts, size)
    rows = events.withWatermark(ts, late).groupBy(frame.alias("w"), *(by or [])).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *(by or []), "n")


def run_once(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Works off what has arrived and stops; a rerun goes on where this one ended."""
    rows.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_totals(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Works off what has arrived; the totals so far replace those at ``path`` after every micro-batch, so a repeated batch does no harm."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    rows.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def merge_batches(pages: DataFrame, table: str, checkpoint: str, merge) -> None:
    """Calls ``merge(batch, table)`` for every micro-batch; the call must be repeatable."""
    pages.writeStream.foreachBatch(lambda batch, _: merge(batch, table)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
