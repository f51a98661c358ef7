"""Page views by month, and the category tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates


def monthly(views: DataFrame, by: str, ts: str, amount: str) -> DataFrame:
    return views.groupBy(F.col(by).alias("series"), dates.month_of(F.col(ts)).alias("month")).agg(F.sum(amount).alias("views"))


def roll_up(series: DataFrame) -> DataFrame:
    """Total and first month of each series."""
    return series.groupBy("series").agg(F.sum("views").alias("views"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def stale(series: DataFrame, last_month: str) -> DataFrame:
    """Series without the last month."""
    return roll_up(series).where(F.col("last_month") < last_month).select("series", "last_month")


def two_hops(edges: DataFrame, root: str, allowed: DataFrame, prefix: str = "") -> DataFrame:
    """Grandchildren of a root over (parent, child), where allowed and with a prefix."""
    hubs = edges.where(F.col("parent") == root).select(F.col("child").alias("hub"))
    own = edges.select(F.col("parent").alias("hub"), F.col("child").alias("category"))
    return hubs.join(own, "hub").where(F.col("category").startswith(prefix)).join(allowed.select("category").distinct(), "category", "left_semi").select("hub", "category")


def request_queue(tracked: DataFrame, allowed: DataFrame, requested: DataFrame) -> DataFrame:
    """Categories: requests that are fulfilled, and new ones to make."""
    fulfilled = requested.select("category").distinct().join(allowed.select("category"), "category", "left_semi").withColumn("state", F.lit("fulfilled"))
    new = tracked.select("category").distinct().join(allowed.select("category"), "category", "left_anti").join(requested.select("category"), "category", "left_anti").withColumn("state", F.lit("new"))
    return fulfilled.union(new)
