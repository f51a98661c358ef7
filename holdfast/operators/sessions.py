"""Sessions that work through labels one after another: which label is active, what is left, who is in the way, how far it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fmt, text

IDLE_SECONDS = 1800
WAITING = " ⏸ waiting on slots"
# How phases begin that need a slot.
SLOT_PHASES = ("Uploading", "SDC syncing")


def idle_suffix(now: Column, written: Column) -> Column:
    """A warning with the time since a log was written, if that is more than IDLE_SECONDS."""
    idle = now - written
    minutes = F.floor(idle / 60)
    shown = F.when(minutes >= 60, F.format_string("%dh%02dm", F.floor(minutes / 60), minutes % 60)).otherwise(F.format_string("%dm", minutes))
    return F.when((now > 0) & (written > 0) & (idle > IDLE_SECONDS), F.concat(F.lit(" ⚠ idle "), shown)).otherwise("")


def active_labels(sessions: DataFrame, logs: DataFrame) -> DataFrame:
    """Each session's label whose log was written last since the session began.

    sessions: session, created, label; logs: label, written.
    """
    own = sessions.join(logs, "label").where(F.col("written") >= F.col("created"))
    return own.groupBy("session").agg(F.max_by("label", F.struct("written", "label")).alias("active"), F.max("written").alias("written"))


def open_labels(sessions: DataFrame, active: DataFrame) -> DataFrame:
    """The labels that a session has not finished: the active one and those after it; all of them where none is known.

    sessions: session, pos, label; active: session, active.
    """
    joined = sessions.join(active.select("session", "active"), "session", "left")
    start = joined.where(F.col("label") == F.col("active")).groupBy("session").agg(F.min("pos").alias("start"))
    return joined.join(start, "session", "left").where(F.col("pos") >= F.coalesce("start", F.col("pos"))).select("session", "pos", "label")


def conflicts(requests: DataFrame, labels: DataFrame) -> DataFrame:
    """Sessions that are in a request's way.

    requests: request, hub, institution (slug), several (more than one institution), item, collection, label; labels: session,
    label.  A hub meets every label of its own; all others meet the hub, and the same label; a collection also its institution,
    and institutions their collections.
    """
    own = labels.select("session", F.col("label").alias("other")).distinct().withColumn("hub", F.substring_index("other", "+", 1))
    met = requests.join(own, "hub")
    hub_wide = F.col("institution").isNull() & F.col("item").isNull()
    same = (F.col("other") == F.col("hub")) | (F.col("other") == F.col("label"))
    of_collection = same | F.coalesce(F.col("other") == F.concat_ws("+", "hub", "institution"), F.lit(False))
    conflict = F.when(hub_wide, True).when(F.col("collection").isNotNull(), of_collection).when(F.col("item").isNotNull(), same).otherwise(same | F.col("other").startswith(F.concat(F.col("label"), F.lit("+"))))
    return met.where(conflict).select("request", "session").distinct()


def target_groups(tokens: DataFrame, slugs: DataFrame, entities: DataFrame) -> DataFrame:
    """What each token of a user stands for, as sets of label parts: (token, parts, error).

    A token is an entity (all hubs and institutions that it names), an item's id (its first eight digits), "hub|institution|
    collection", or a label's part.  slugs: name, slug; entities: qid, hub, inst.
    """
    bare = tokens.select(F.trim("token").alias("token")).where("token <> ''").distinct()
    is_entity, is_item, is_path = text.is_entity_id(F.col("token")), text.is_item_id(F.col("token")), F.col("token").contains("|")
    of_entity = bare.where(is_entity).join(entities.withColumnRenamed("qid", "token"), "token", "left")
    named = of_entity.select("token", F.array_compact(F.array("hub", text.slug(F.col("inst")))).alias("parts"), F.when(F.col("hub").isNull(), "unknown entity").alias("error"))
    items = bare.where(is_item & ~is_entity).select("token", F.array(F.lower(F.substring("token", 1, 8))).alias("parts"), F.lit(None).cast("string").alias("error"))
    pieces = F.transform(F.split("token", r"\|", 3), lambda x: F.trim(x))
    paths = bare.where(~is_entity & ~is_item).withColumn("pieces", pieces).withColumn("name", F.col("pieces")[0]).join(slugs, "name", "left")
    rest = F.transform(F.filter(F.slice("pieces", 2, F.greatest(F.size("pieces") - 1, F.lit(0))), lambda x: x != ""), text.slug)
    hub = F.when(is_path, F.col("slug")).otherwise(F.coalesce("slug", "token"))
    error = F.when(hub.isNull(), "unknown hub").when(F.exists(rest, lambda x: x == ""), "empty name")
    listed = paths.select("token", F.concat(F.array_compact(F.array(hub)), rest).alias("parts"), error.alias("error"))
    every = named.unionByName(items).unionByName(listed)
    return every.select("token", F.array_sort(F.array_distinct("parts")).alias("parts"), "error").distinct()


def sessions_to_stop(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Sessions of which a group's parts are all among the parts; labels: session, label."""
    parts = labels.select("session", F.explode(F.split("label", r"\+")).alias("part")).distinct()
    wanted = groups.where("error is null and size(parts) > 0").select("parts", F.size("parts").alias("n"), F.explode("parts").alias("part")).distinct()
    return wanted.join(parts, "part").groupBy("session", "parts", "n").agg(F.count("*").alias("found")).where("found = n").select("session").distinct()


def slot_counts(slots: DataFrame) -> DataFrame:
    """(pool, slot, label; null if free) -> held and free slots of each pool."""
    return slots.groupBy("pool").agg(F.count("label").alias("held"), F.count_if(F.col("label").isNull()).alias("free"))


def slot_suffixes(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """What a session's row says of its slots; rows: display, phase.  Only phases that need one say anything."""
    held = slots.where("label is not null").groupBy("label").agg(F.count("*").alias("held"))
    joined = rows.withColumn("label", F.regexp_replace("display", r" \[\d+/\d+\]$", "")).join(held, "label", "left")
    needs = F.lit(False)
    for start in SLOT_PHASES:
        needs = needs | F.col("phase").startswith(start)
    suffix = F.when(~needs, "").when(F.col("held") > 0, F.format_string(" [Slots: %d]", "held")).when(F.col("phase").contains("waiting on slots"), "").otherwise(" [Awaiting slot]")
    return joined.select("display", "phase", suffix.alias("suffix"))


def ordinals_total(lines: DataFrame) -> DataFrame:
    """(label, text) of download logs -> the media that items say they have, or else the downloads begun."""
    stated = F.sum(F.regexp_extract("text", r"\b(\d+) ordinals\b", 1).try_cast("bigint"))
    begun = F.count_if(F.col("text").contains("Downloading "))
    return lines.groupBy("label").agg(F.when(F.coalesce(stated, F.lit(0)) > 0, stated).otherwise(begun).alias("total"))


def progress(rows: DataFrame) -> DataFrame:
    """One line on how far a session's phase is.

    rows: label, phase (download, upload, sync), items, total, uploaded, skipped, merged, hand_fix, done, ordinals,
    total_ordinals, maintain_total, active (a download's log says so), waiting, now, written.
    """
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    comma = lambda c: F.format_string("%,d", n(c))
    waits = F.coalesce("waiting", F.lit(False))
    slot = F.when(waits, WAITING).otherwise("")
    idle = F.when((n("done") == 0) & ~waits, idle_suffix(F.col("now"), F.col("written"))).otherwise("")
    share = F.when(n("total") > 0, F.format_string("%.1f", n("items") / n("total") * 100)).otherwise("?")
    of_items = F.concat(comma("items"), F.lit(" / "), comma("total"), F.lit(" items, ~"), share, F.lit("%"))
    start = F.when(waits, "queued").otherwise("starting...")
    finished = n("done") > 0
    download = (
        F.when(finished, F.concat(F.lit("Download complete ("), comma("items"), F.lit(" / "), comma("total"), F.lit(" items)")))
        .when(F.coalesce("active", F.lit(False)), F.concat(F.lit("Downloading ("), of_items, F.lit(")"), idle))
        .otherwise(F.concat(F.lit("Stalled ("), of_items, F.lit(")"), idle))
    )
    sent = n("uploaded") + n("skipped")
    upload = (
        F.when(n("items") == 0, F.concat(F.lit("Uploading ("), start, F.lit(")"), slot))
        .when(finished, F.concat(F.lit("Upload complete ("), comma("uploaded"), F.lit(" uploaded, "), comma("skipped"), F.lit(" already on Commons, "), comma("merged"), F.lit(" merged, "), comma("hand_fix"), F.lit(" hand-fix)")))
        .otherwise(F.concat(F.lit("Uploading ("), F.when(n("total_ordinals") > 0, fmt.progress(sent, n("total_ordinals"))).otherwise(of_items), F.lit(")"), slot, idle))
    )
    synced = (
        F.when(n("maintain_total") > 0, fmt.progress(n("items"), n("maintain_total")))
        .when((n("total_ordinals") > 0) & (n("ordinals") > 0), fmt.progress(n("ordinals"), n("total_ordinals")))
        .when(n("items") <= n("total"), of_items)
        .otherwise(F.concat(comma("items"), F.lit(" files processed")))
    )
    sync = (
        F.when(n("items") == 0, F.concat(F.lit("SDC syncing ("), start, F.lit(")"), slot))
        .when(finished, F.concat(F.lit("SDC complete ("), comma("items"), F.lit(" items processed)")))
        .otherwise(F.concat(F.lit("SDC syncing ("), synced, F.lit(")"), slot, idle))
    )
    line = F.when(F.col("phase") == "download", download).when(F.col("phase") == "upload", upload).when(F.col("phase") == "sync", sync).otherwise("Unknown")
    return rows.select("label", "phase", line.alias("line"))


def run_summary(rows: DataFrame) -> DataFrame:
    """label, workers, elapsed, waited (seconds) with the wait of a worker and its share of the run, 0 where nothing ran."""
    wait = F.when(F.col("workers") > 0, F.col("waited") / F.col("workers")).otherwise(0.0)
    return rows.select("label", wait.alias("wait"), F.when(F.col("elapsed") > 0, wait / F.col("elapsed") * 100).otherwise(0.0).alias("percent"))


def tail(lines: DataFrame, count: int, most_bytes: int) -> DataFrame:
    """The last lines of each log (log, line_no, text, start: its first byte, size: the log's bytes) that lie whole within its
    last bytes."""
    from pyspark.sql import Window

    near = lines.where(F.col("start") >= F.col("size") - most_bytes)
    n = F.row_number().over(Window.partitionBy("log").orderBy(F.desc("line_no")))
    return near.withColumn("_n", n).where(F.col("_n") <= count).select("log", "line_no", "text")


def distinct_targets(tokens: DataFrame) -> DataFrame:
    """(request, pos, token) -> each token of a request once, where it stands first."""
    return tokens.groupBy("request", "token").agg(F.min("pos").alias("pos")).select("request", "pos", "token")
