"""Streaming views: visited pages once each, first and last seen, hourly rotation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def visited_once(stream: DataFrame, key: list[str], ts: str = "ts", delay: str | None = None) -> DataFrame:
    """The first row of each key that comes.

    Keys are never forgotten, as a crawl asks for, so the state grows with the keys. With
    ``delay`` those older than the watermark are, and a key that comes again after that
    time is taken for new.
    """
    if delay is None:
        return stream.dropDuplicates(key)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def hourly_counts(stream: DataFrame, by: str, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Rows of each hour and group.

    In append mode an hour is emitted once the watermark has passed it; in update mode with
    each batch that adds to it, so that the hours that are still open come out as well.
    """
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).groupBy(F.window(ts, "60 minutes"), by).agg(F.count("*").alias("n_lines")).select(F.col("window.start").alias("hour"), by, "n_lines")


def seen(stream: DataFrame, key: str, ts: str = "ts", after_s: int = 1800) -> DataFrame:
    """key, first_seen, last_seen, promoted: the state of each key after each batch that has it."""
    kind = stream.select(key).schema[0].dataType.simpleString()

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last = state.get if state.exists else (None, None)
        for pdf in batches:
            us = pdf[ts].astype("datetime64[us]").astype("int64")
            first, last = min(x for x in (first, int(us.min())) if x is not None), max(x for x in (last, int(us.max())) if x is not None)
        state.update((first, last))
        yield pd.DataFrame({key: [k[0]], "first_seen": pd.to_datetime([first], unit="us"), "last_seen": pd.to_datetime([last], unit="us"), "promoted": [last - first > after_s * 1_000_000]})

    rows = stream.where(F.col(ts).isNotNull() & F.col(key).isNotNull()).select(key, F.col(ts).cast("timestamp_ntz").alias(ts))
    return rows.groupBy(key).applyInPandasWithState(update, f"`{key}` {kind}, first_seen timestamp_ntz, last_seen timestamp_ntz, promoted boolean", "first long, last long", "update", GroupStateTimeout.NoTimeout)
