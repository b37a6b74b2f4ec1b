"""Structured Streaming front end: incremental ingest, last state per key, deduplication, windows and sessions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from correlia.sources.sinks import append_only


def follow(spark: SparkSession, path: str, schema: str, files_per_batch: int = 64) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingest_new(stream: DataFrame, table: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Append rows with unseen keys to a table, batch by batch. A batch that is run again appends nothing twice."""
    return stream.writeStream.foreachBatch(lambda df, _: append_only(df, table, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_of_key(stream: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; the state of a key is forgotten `delay` after the newest time seen."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, window: str, keys: list[str], delay: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Rows per tumbling or sliding window and key; rows later than `delay` are dropped by the watermark."""
    w = F.window(time, window, slide) if slide else F.window(time, window)
    return stream.withWatermark(time, delay).groupBy(w.alias("ventana"), *keys).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, time: str, keys: list[str], pause: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions of a key, cut at a pause."""
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, pause).alias("sesion"), *keys).agg(F.count(F.lit(1)).alias("n"))


def latest_state(stream: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """(key, value, cambios): the last value of each key by time, later rows win, and how often it changed; for update mode."""
    kinds = dict(stream.dtypes)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        at, last, n = state.get if state.exists else (None, None, 0)
        for pdf in batches:
            for t, v in pdf.sort_values([time, value])[[time, value]].itertuples(index=False):
                t = int(pd.Timestamp(t).value)
                if at is None or t >= at:
                    n += last is not None and v != last
                    at, last = t, v
        state.update((at, last, n))
        yield pd.DataFrame({key: [k[0]], value: [last], "cambios": [n]})

    return stream.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).applyInPandasWithState(step, f"{key} {kinds[key]}, {value} {kinds[value]}, cambios long", f"at long, last {kinds[value]}, n long", "update", "NoTimeout")
