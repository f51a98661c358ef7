"""Statements: building them from items, and reconciling what should be with what is.

expected: entity, prop, value [, owner]; existing: entity, stmt, prop, value, ours, foreign [, malformed]
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# Properties and their entities that contributed statements use.
CONTRIBUTOR = "P9126"
SELF, AGGREGATOR, REPOSITORY, CUSTODIAL = "Q2944483", "Q393351", "Q108296843", "Q108296919"
PUBLIC_DOMAIN, COPYRIGHTED = "Q19652", "Q50423863"
STATUS, LICENSE, STATEMENT = "P6216", "P275", "P6426"


def contributed(items: DataFrame, content_hubs: list[str]) -> DataFrame:
    """(id, hub_qid, inst_qid): this aggregator, the hub and the institution, each with its role.  A content hub is the
    repository itself and its institution a department; any other hub aggregates, and the institution is the repository."""
    content = F.col("hub_qid").isin(*content_hubs)
    row = lambda seq, qid, role: F.struct(F.lit(seq).alias("seq"), F.lit(CONTRIBUTOR).alias("prop"), qid.alias("value"), role.alias("role"))
    rows = F.array(
        row(1, F.lit(SELF), F.lit(AGGREGATOR)),
        row(2, F.col("hub_qid"), F.when(content, REPOSITORY).otherwise(AGGREGATOR)),
        row(3, F.col("inst_qid"), F.when(content, CUSTODIAL).otherwise(REPOSITORY)),
    )
    return items.select("id", F.explode(rows).alias("s")).select("id", "s.*")


def rights_statements(items: DataFrame, rights: DataFrame) -> DataFrame:
    """(id, rights_uri) by (uri, prop, qid): the mapped statement and the status that follows from it."""
    status = F.when(F.col("qid") == PUBLIC_DOMAIN, PUBLIC_DOMAIN).when(F.col("prop") == LICENSE, COPYRIGHTED).when(F.col("prop") == STATEMENT, PUBLIC_DOMAIN)
    rows = F.array_compact(
        F.array(
            F.when(F.col("qid") != PUBLIC_DOMAIN, F.struct(F.col("prop").alias("prop"), F.col("qid").alias("value"))),
            F.when(status.isNotNull(), F.struct(F.lit(STATUS).alias("prop"), status.alias("value"))),
        )
    )
    return items.join(rights, items["rights_uri"] == rights["uri"]).select("id", F.explode(rows).alias("s")).select("id", "s.*")


def long_values(values: DataFrame, limit: int = text.CHUNK_LENGTH) -> DataFrame:
    """(id, prop, language, pos, value) -> parts of long values, with the series letter and part number that keep them in
    order.  Letters are by property and language, as null is for what has none."""
    from pyspark.sql import Window

    cut = values.withColumn("parts", text.chunks(F.col("value"), limit))
    over = Window.partitionBy("id", "prop", "language").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    nth = F.sum((F.size("parts") > 1).cast("int")).over(over)
    lettered = cut.withColumn("letter", F.when(F.size("parts") > 1, text.series_letter(nth)))
    return lettered.select("id", "prop", "language", "pos", "letter", F.posexplode("parts").alias("part", "value"))


def reconcile(expected: DataFrame, existing: DataFrame, protected: tuple[str, ...] = ()) -> DataFrame:
    """An action for each expected and each existing statement, by (entity, prop, value).

    add: expected and not there, or there with a foreign source only; keep: ours; annotate: there without any source;
    remove: ours, of a property that is not protected, and expected no more; ignore: not ours.  Malformed statements (a time
    without its parts, an unknown value without its wording) are apart from the others of their value, which may be null:
    ours go, of protected properties too.
    """
    key = ["entity", "prop", "value"]
    malformed = F.coalesce("malformed", F.lit(False)) if "malformed" in existing.columns else F.lit(False)
    broken, existing = existing.where(malformed), existing.where(~malformed)
    want = expected.select(*key).distinct().withColumn("wanted", F.lit(True))
    have = existing.groupBy(*key).agg(F.bool_or("ours").alias("ours"), F.bool_or("foreign").alias("foreign"), F.count("*").alias("n"))
    action = (
        F.when(F.col("wanted") & F.col("n").isNull(), "add")
        .when(F.col("wanted") & F.col("ours"), "keep")
        .when(F.col("wanted") & F.col("foreign"), "add")
        .when(F.col("wanted"), "annotate")
        .when(F.col("ours") & ~F.col("prop").isin(*protected), "remove")
        .otherwise("ignore")
    )
    gone = broken.select(*key, F.when(F.col("ours"), "remove").otherwise("ignore").alias("action")).distinct()
    return want.join(have, key, "full").select(*key, action.alias("action")).union(gone)


def reconcile_merged(references: DataFrame, expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files that several items share.  references: entity, stmt, value, owner; expected: entity, owner, value;
    loaded: entity, owner.  A statement keeps owners that assert it or whose data are not loaded, gains asserting owners
    and goes only when no owner is left."""
    kept = (
        references.distinct()
        .join(expected.withColumn("asserts", F.lit(True)).distinct(), ["entity", "owner", "value"], "left")
        .join(loaded.withColumn("loaded", F.lit(True)).distinct(), ["entity", "owner"], "left")
    )
    keeps = F.col("asserts").isNotNull() | F.col("loaded").isNull()
    gains = references.select("entity", "stmt", "value").distinct().join(expected.distinct(), ["entity", "value"]).groupBy("stmt").agg(F.collect_set("owner").alias("gain"))
    out = kept.groupBy("entity", "stmt", "value").agg(F.collect_set(F.when(keeps, F.col("owner"))).alias("stay"), F.count("*").alias("before")).join(gains, "stmt", "left")
    owners = F.array_sort(F.array_union("stay", F.coalesce("gain", F.array().cast("array<string>"))))
    return out.select("entity", "stmt", "value", "before", owners.alias("owners"), F.when(F.size(owners) == 0, "remove").otherwise("keep").alias("action"))


def set_sync(expected: DataFrame, existing: DataFrame, key: list[str], value: str, authoritative: bool) -> DataFrame:
    """Values to add, and (where our list rules) to take away."""
    add = expected.select(*key, value).distinct().join(existing.select(*key, value).distinct(), [*key, value], "left_anti").withColumn("action", F.lit("add"))
    if not authoritative:
        return add
    return add.union(existing.select(*key, value).distinct().join(expected.select(*key, value).distinct(), [*key, value], "left_anti").withColumn("action", F.lit("remove")))


def coalesce_patches(patches: DataFrame, removed: DataFrame) -> DataFrame:
    """(stmt, item) patches of one statement become one, without items marked as removed."""
    return patches.distinct().join(removed.distinct(), ["stmt", "item"], "left_anti").groupBy("stmt").agg(F.array_sort(F.collect_set("item")).alias("items"))


def value_key(kind: Column, value: Column, ordinal: Column) -> Column:
    """One comparable key whatever the datatype; null where it cannot be told."""
    return F.when(kind == "string", F.concat_ws("#", value, ordinal)).when(kind == "entity", value).when(kind == "time", F.concat(F.lit("t:"), value))
