"""Who last set a value, who came first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trace(revisions: DataFrame) -> DataFrame:
    """(page, rev, user, params map) -> the user who gave each parameter its present value.

    A parameter that went and came back counts as changed; one that the last revision lacks is left out.  Each revision
    is set against the keys that its page ever had, never against those of others.
    """
    keys = revisions.select("page", F.explode(F.map_keys("params")).alias("key")).distinct()
    long = revisions.select("page", "rev", "user", "params").join(keys, "page").select("page", "rev", "user", "key", F.try_element_at("params", F.col("key")).alias("value"))
    over = Window.partitionBy("page", "key").orderBy("rev")
    changed = long.withColumn("changed", ~F.col("value").eqNullSafe(F.lag("value").over(over)))
    return (
        changed.groupBy("page", "key")
        .agg(F.max_by("value", "rev").alias("value"), F.max_by("user", F.when(F.col("changed"), F.col("rev"))).alias("user"))
        .where("value is not null")
    )


def classify(traced: DataFrame, bots: list[str]) -> DataFrame:
    known = F.lower(F.replace(F.col("user"), F.lit("_"), F.lit(" "))).isin(*[b.lower().replace("_", " ") for b in bots])
    return traced.withColumn("origin", F.when(F.coalesce(known, F.lit(False)), "bot").otherwise("community"))


def first_editor(revisions: DataFrame) -> DataFrame:
    return revisions.groupBy("page").agg(F.min_by("user", "rev").alias("user"))
