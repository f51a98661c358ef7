"""Connected components of a link table, by alternating large and small stars, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node links its neighbours (large star: the greater ones; small star: the smaller ones and itself) to the
    smallest of them and itself."""
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) bigint links -> (node, component) of all linked nodes but each component's smallest."""
    edges = common.materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        edges = common.materialize(_star(_star(edges, True), False), "links")
        row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (row["n"], row["h"]) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = (row["n"], row["h"])
