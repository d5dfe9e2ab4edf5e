"""Streaming operators: first-seen items, windows, per-key revision numbers and sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def file_stream(spark: SparkSession, path: str, schema: str, per_trigger: int = 10) -> DataFrame:
    """Parquet files of a folder as a stream; the files per trigger bound what waits downstream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def first_seen(stream: DataFrame, key: list[str], time: str, horizon: str = "14 days") -> DataFrame:
    """The first row of every key within the horizon; its state is dropped behind the watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, horizon).dropDuplicatesWithinWatermark(key)


def window_counts(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """start, key, n per tumbling window; rows later than `late` are dropped."""
    s = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return s.groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def session_counts(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """key, start, end, n of sessions that end after a gap."""
    s = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return s.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def revisions(stream: DataFrame, key: str, row: str) -> DataFrame:
    """key, row, rev: which occurrence of its key each row is, counted over the whole stream in per-key state."""

    def count(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        for b in batches:
            b = b.sort_values(row)
            yield pd.DataFrame({key: b[key], row: b[row], "rev": range(n + 1, n + 1 + len(b))})
            n += len(b)
        state.update((n,))

    kinds = dict(stream.dtypes)
    out = f"{key} {kinds[key]}, {row} {kinds[row]}, rev long"
    return stream.select(key, row).groupBy(key).applyInPandasWithState(count, out, "n long", "append", GroupStateTimeout.NoTimeout)


def split(stream: DataFrame, keep, on: str = "kept") -> DataFrame:
    """Marks rows that pass a predicate; a null predicate keeps the row, so that nothing is lost."""
    return stream.withColumn(on, F.coalesce(keep, F.lit(True)))


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over what is there and hands every batch to an idempotent sink (batch, id)."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch into its own folder, so a repeated batch replaces itself."""
    return lambda batch, i: batch.write.mode("overwrite").parquet(f"{path}/batch={i}")
