"""Which items are worth working on: registries, ban lists, ordered verdicts, batches.

institutions: hub, hub_qid, hub_upload, inst, inst_qid, inst_upload
items:        id, hub, inst, rights, has_asset
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def present(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def uploads() -> Column:
    return F.coalesce("hub_upload", F.lit(False)) | F.coalesce("inst_upload", F.lit(False))


def eligible_institutions(institutions: DataFrame, maintain: bool = False) -> DataFrame:
    """Both ids are known, and the hub or the institution uploads; maintenance drops the last condition alone."""
    return institutions.where(present("hub_qid") & present("inst_qid") & (F.lit(maintain) | uploads()))


def hub_uploads(institutions: DataFrame) -> DataFrame:
    """A hub is in if it or any of its institutions uploads."""
    return institutions.groupBy("hub").agg(F.bool_or(uploads()).alias("eligible"))


def eligibility_reason(institutions: DataFrame, maintain: bool = False) -> DataFrame:
    """The first gate that an institution fails, or 'ok'."""
    reason = (
        F.when(~present("hub_qid"), "hub without id")
        .when(~present("inst_qid"), "institution without id")
        .when(~(F.lit(maintain) | uploads()), "no upload")
        .otherwise("ok")
    )
    return institutions.select("hub", "inst", (reason == "ok").alias("ok"), reason.alias("reason"))


def worklist(items: DataFrame, institutions: DataFrame, banned: DataFrame, maintain: bool = False, skip_media_filter: bool = False) -> DataFrame:
    """Items of eligible institutions that are not banned, with open rights and an asset unless that filter is off."""
    chosen = eligible_institutions(institutions, maintain).select("hub", "inst")
    open_ = F.lit(skip_media_filter) | ((F.col("rights") == "unlimited") & F.col("has_asset"))
    return items.where(open_).join(chosen, ["hub", "inst"], "left_semi").join(banned.select("id").distinct(), "id", "left_anti")


def item_verdicts(requested: DataFrame, items: DataFrame, institutions: DataFrame, banned: DataFrame) -> DataFrame:
    """One status for each requested id, from the first rule that holds."""
    known = items.join(institutions, ["hub", "inst"], "left")
    flags = banned.select("id").distinct().withColumn("banned", F.lit(True))
    status = (
        F.when(F.col("found").isNull(), "NOT_FOUND")
        .when(F.col("banned"), "BANNED")
        .when(F.coalesce(F.col("rights"), F.lit("")) != "unlimited", "RIGHTS")
        .when(~F.coalesce("has_asset", F.lit(False)), "NO_MEDIA")
        .when(~present("hub_qid"), "UNKNOWN_HUB")
        .when(~(present("inst_qid") & uploads()), "INSTITUTION")
        .otherwise("OK")
    )
    return requested.join(known.withColumn("found", F.lit(True)), "id", "left").join(flags, "id", "left").select("id", status.alias("status"))


def facets(items: DataFrame, column: str) -> DataFrame:
    """How many items have each value; an item counts once for a value."""
    return items.groupBy(F.col(column).alias("term")).agg(F.count_distinct("id").alias("count"))


def facet_batches(counts: DataFrame, size: int, below: int | None = None, descending: bool = False) -> DataFrame:
    """Values in order of count, dealt into batches.  The table of values is small; items never pass through the window."""
    kept = counts if below is None else counts.where(F.col("count") < below)
    order = [F.desc("count") if descending else F.asc("count"), F.asc("term")]
    return kept.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / size).cast("bigint"))


def first_seen(scans: list[DataFrame]) -> DataFrame:
    """The union of scans by id; each id with the number of the first scan that has it."""
    every = None
    for n, scan in enumerate(scans):
        part = scan.select("id", F.lit(n).alias("scan"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy("id").agg(F.min("scan").alias("scan"))


def ban_list(static: DataFrame, feed: DataFrame) -> DataFrame:
    """Ids of a list and of a feed of JSON lines; lines and ids that are not well formed are dropped."""
    fed = feed.select(F.get_json_object("value", "$.DPLA_id").alias("id"))
    return static.select("id").union(fed).where(text.is_item_id(F.col("id"))).distinct()


def resolve_names(wanted: DataFrame, hubs: DataFrame, aliases: DataFrame) -> DataFrame:
    """name -> slug: a slug itself, else an alias, else a display name in any case."""
    direct = hubs.select(F.col("slug").alias("name"), F.col("slug").alias("s1")).distinct()
    other = aliases.groupBy(F.col("alias").alias("name")).agg(F.min("slug").alias("s2"))
    shown = hubs.groupBy(F.lower("name").alias("lowered")).agg(F.min("slug").alias("s3"))
    found = wanted.join(direct, "name", "left").join(other, "name", "left").withColumn("lowered", F.lower("name")).join(shown, "lowered", "left")
    return found.select("name", F.coalesce("s1", "s2", "s3").alias("slug"))


def targets_of_entity(institutions: DataFrame, maintain: bool = False) -> DataFrame:
    """qid -> all hubs and institutions that it names, where they upload."""
    hubs = institutions.groupBy("hub").agg(F.max("hub_qid").alias("qid"), F.bool_or(uploads()).alias("up")).select("qid", "hub", F.lit(None).cast("string").alias("inst"), "up")
    own = institutions.select(F.col("inst_qid").alias("qid"), "hub", "inst", uploads().alias("up"))
    return hubs.unionByName(own).where(F.col("qid").isNotNull() & (F.lit(maintain) | F.col("up"))).select("qid", "hub", "inst")


# Fixed value: what does not count at the beginning of a title when titles are listed.
UNSORTED = " \"'(<[-_."


def title_order(items: DataFrame, title: str) -> DataFrame:
    """Items with the key that lists them as their pages are listed, and in that order: the page's title without its
    identifier, folded, without leading quotes and brackets, then by id."""
    identifier = F.col("id").cast("string")
    page = text.page_title(F.coalesce(F.col(title), F.lit("")), identifier, F.lit(""))
    prefix = F.substr(page, F.lit(1), F.length(page) - F.length(identifier) - len(" - DPLA - "))
    key = F.ltrim(text.casefolded(prefix), F.lit(UNSORTED))
    return items.withColumn("sort_key", F.concat(key, F.lit("\u0000"), identifier)).orderBy("sort_key", "id")


def collection_batches(counts: DataFrame, excluded: tuple[str, ...], below: int, size: int) -> DataFrame:
    """Collections that are small enough and whose names have none of these words, dealt into batches."""
    kept = counts.where(~F.coalesce(F.col("term").rlike("|".join(excluded)), F.lit(False))) if excluded else counts
    return facet_batches(kept, size, below)


def entity_of_target(institutions: DataFrame, targets: DataFrame) -> DataFrame:
    """(hub, inst; null for the hub itself) -> qid; null where nothing is known."""
    hubs = institutions.groupBy("hub").agg(F.max("hub_qid").alias("_hub_qid"))
    own = institutions.groupBy("hub", "inst").agg(F.max("inst_qid").alias("_inst_qid"))
    joined = targets.join(hubs, "hub", "left").join(own, ["hub", "inst"], "left")
    return joined.select("hub", "inst", F.when(F.col("inst").isNull(), F.col("_hub_qid")).otherwise(F.col("_inst_qid")).alias("qid"))


def names_of_entities(institutions: DataFrame) -> DataFrame:
    """qid -> the name of the hub or institution that has it; a hub's first."""
    hubs = institutions.select(F.col("hub_qid").alias("qid"), F.struct(F.lit(0).alias("rank"), F.col("hub").alias("name")).alias("n"))
    own = institutions.select(F.col("inst_qid").alias("qid"), F.struct(F.lit(1).alias("rank"), F.col("inst").alias("name")).alias("n"))
    return hubs.union(own).where("qid is not null").groupBy("qid").agg(F.min("n").alias("n")).select("qid", F.col("n.name").alias("name"))


def missing_categories(institutions: DataFrame, categories: DataFrame) -> DataFrame:
    """Institutions with an entity that have no category yet; categories: qid."""
    return institutions.where(present("inst_qid")).select("hub", "inst", "inst_qid").distinct().join(categories.select(F.col("qid").alias("inst_qid")).distinct(), "inst_qid", "left_anti")


def institution_status(institutions: DataFrame, wanted: DataFrame) -> DataFrame:
    """Whether each (hub, inst) uploads: the hub does, or the institution."""
    own = institutions.groupBy("hub", "inst").agg(F.bool_or(uploads()).alias("_up"))
    return wanted.join(own, ["hub", "inst"], "left").select("hub", "inst", F.coalesce("_up", F.lit(False)).alias("eligible"))


def of_partner(items: DataFrame, hubs: DataFrame) -> DataFrame:
    """Items (partner: a slug, hub: a name) with whether the record is of that partner; an unknown slug is nobody's."""
    names = hubs.select(F.col("slug").alias("partner"), F.col("name").alias("_name"))
    return items.join(names, "partner", "left").withColumn("of_partner", F.coalesce("_name", F.lit("")) == F.coalesce("hub", F.lit(""))).drop("_name")
