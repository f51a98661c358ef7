"""Counters and outcomes of a running log, with a bound on late lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counters(log: DataFrame, ts: str = "ts", result: str = "event_type", window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """How often each result came in each window; a window is final once no line can be that late.  Works on streams
    and tables alike."""
    return (
        log.withWatermark(ts, late)
        .groupBy(F.window(ts, window).alias("w"), F.col(result).alias("result"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("start"), "result", "n")
    )


def first_of_each(log: DataFrame, key: str, ts: str = "ts", late: str = "1 day") -> DataFrame:
    """The first line of each key, with state that is dropped once a key can come no more."""
    return log.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
