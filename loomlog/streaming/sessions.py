"""Streams: idempotent turns, sessions that end by silence, totals by window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def follow(spark: SparkSession, path: str, schema: str, per_trigger: int = 8) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def once(stream: DataFrame, key: str, ts: str, delay: str = "7 days") -> DataFrame:
    """Each key once; a key is remembered for the delay after its event time."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def silent_sessions(stream: DataFrame, key: str, ts: str, gap: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions that a gap without events ends."""
    return stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "n")


def progress(stream: DataFrame, key: str, size: str) -> DataFrame:
    """The furthest offset and how often each key grew; late rows are never dropped, as the state
    has no watermark, and never move an offset back."""
    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        offset, grown = state.get if state.exists else (0, 0)
        for f in frames:
            top = int(f[size].max())
            if top > offset:
                offset, grown = top, grown + 1
        state.update((offset, grown))
        yield pd.DataFrame({key: [k[0]], "last_offset": [offset], "reopened": [grown]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, last_offset long, reopened long", "last_offset long, reopened long", "update", GroupStateTimeout.NoTimeout)


def append_new(stream: DataFrame, key: str, out: str, checkpoint: str, ts: str | None = None, delay: str = "7 days"):
    """Starts a query that appends each key's first row once. The keys seen are the stream's state, which
    a restart reads back, and the file sink's log leaves a replayed batch out. Without ts every key is
    remembered, so that a late repeat is never added; with it, for the delay after its event time."""
    first = stream.dropDuplicates([key]) if ts is None else once(stream, key, ts, delay)
    return first.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
