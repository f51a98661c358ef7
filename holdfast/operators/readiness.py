"""Readiness inventory: how much of each institution and domain could be taken over.

items: id, hub, inst, rights, old, plus platform flags; institutions as in selection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fmt
from .selection import eligible_institutions


def by_institution(items: DataFrame, institutions: DataFrame, banned: DataFrame) -> DataFrame:
    """Conditional counts of each eligible institution in one pass, its level, and its rank within the hub."""
    chosen = eligible_institutions(institutions).select("hub", "inst")
    counted = (
        items.join(banned.select("id").distinct(), "id", "left_anti")
        .where("has_asset")
        .join(chosen, ["hub", "inst"], "left_semi")
        .groupBy("hub", "inst")
        .agg(
            F.count("*").alias("total"),
            F.count_if(F.col("rights") == "unlimited").alias("unlim"),
            F.count_if((F.col("rights") != "unlimited") & F.col("old")).alias("old_other"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("hub").orderBy(F.desc("unlim"), F.desc("old_other"), "inst"))
    return counted.select("hub", "inst", "total", "unlim", "old_other", fmt.level(F.col("unlim")).alias("level"), fmt.percent(F.col("unlim"), F.col("total")).alias("percent"), rank.cast("bigint").alias("rank"))


def by_domain(records: DataFrame) -> DataFrame:
    """(domain, inst, is_eligible, is_partner, total, unlim, old_other) -> domains where one institution is eligible
    and no partner yet; sums are of all institutions there.  The largest institution needs one item at least; ties go to
    the first name."""
    first_name = F.min_by("inst", F.struct((-F.col("total")).alias("t"), F.col("inst").alias("n")))
    summed = records.where(F.coalesce(F.col("domain"), F.lit("")) != "").groupBy("domain").agg(
        F.sum("total").alias("total"),
        F.sum("unlim").alias("unlim"),
        F.sum("old_other").alias("old_other"),
        F.bool_or(F.col("is_eligible") & ~F.col("is_partner")).alias("open"),
        F.when(F.max("total") > 0, first_name).otherwise("").alias("largest"),
    )
    rank = F.row_number().over(Window.orderBy(F.desc("unlim"), F.desc("old_other"), "domain"))
    return summed.where("open").select("domain", "total", "unlim", "old_other", "largest", fmt.level(F.col("unlim")).alias("level"), rank.cast("bigint").alias("rank"))
