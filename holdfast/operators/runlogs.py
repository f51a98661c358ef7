"""Run logs: carried ids, error blocks, latest outcomes, retry sets, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed pattern: both wordings of the line that opens an error block.
BLOCK = r"-- Ordinal (\d+) \((M\d+)\) for ([0-9a-f]{32}): SDC sync failed(?: after retries)?; skipping ordinal\."
# Errors that a plain retry is likely to pass.
TRANSIENT_ERRORS = (
    "MaxlagTimeoutError", "ServerError", "ReadTimeoutError", "ReadTimeout", "ConnectTimeoutError", "EndpointConnectionError", "ChunkedEncodingError",
    "ProtocolError", "ConnectionError", "internal_api_error_DBQueryError", "internal_api_error_DBConnectionError", "editconflict", "failed-save", "readonly",
    "ratelimited", "maxlag", "SlowDown", "RequestTimeout", "ServiceUnavailable", "InternalError",
)
TRANSIENT = "|".join(TRANSIENT_ERRORS)


def carry_forward(lines: DataFrame, by: list[str], order: list[str], value: Column, name: str = "carried") -> DataFrame:
    """The last value seen at or before each line."""
    over = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(name, F.last(value, ignorenulls=True).over(over))


def blocks(lines: DataFrame, by: list[str], order: list[str], opens: Column, closes: Column) -> DataFrame:
    """Lines from each opening one up to the next that closes or opens, with the block's number; other lines go."""
    over = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("_cut", F.sum((opens | closes).cast("int")).over(over)).withColumn("block", F.sum(opens.cast("int")).over(over))
    first = Window.partitionBy(*by, "_cut").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return numbered.withColumn("_open", F.first(opens).over(first)).where("_open").drop("_cut", "_open")


def failed_ordinals(log: DataFrame) -> DataFrame:
    """Log lines (file, line_no, text) -> the error blocks: item, ordinal, entity, whether the cause passes."""
    opens, closes = F.col("text").rlike(BLOCK), F.col("text").rlike(r"^\[(?:INFO|ERROR)\]")
    found = blocks(log, ["file"], ["line_no"], opens, closes & ~opens)
    return found.groupBy("file", "block").agg(
        F.max(F.nullif(F.regexp_extract("text", BLOCK, 3), F.lit(""))).alias("id"),
        F.max(F.nullif(F.regexp_extract("text", BLOCK, 1), F.lit(""))).cast("int").alias("ordinal"),
        F.max(F.nullif(F.regexp_extract("text", BLOCK, 2), F.lit(""))).alias("entity"),
        F.bool_or(F.col("text").rlike(TRANSIENT)).alias("transient"),
    )


def latest_outcome(outcomes: DataFrame, key: list[str], run: str) -> DataFrame:
    """(key, run, outcome) -> the outcome of each key's last run; within a run, 'retry' beats 'done'."""
    order = Window.partitionBy(*key).orderBy(F.desc(run), F.desc(F.col("outcome") == "retry"))
    return outcomes.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(*key, run, "outcome")


def retry_sets(download: DataFrame, upload: DataFrame, sync: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What each phase must run again; an earlier phase takes an item from the later ones."""
    only = lambda df: df.select(*key).distinct()
    d = only(download).join(only(done), key, "left_anti")
    u = only(upload).join(d, key, "left_anti")
    s = only(sync).join(u, key, "left_anti").join(d, key, "left_anti")
    return d.withColumn("phase", F.lit("download")).union(u.withColumn("phase", F.lit("upload"))).union(s.withColumn("phase", F.lit("sync")))


def counters(rows: DataFrame, result: str, amount: str | None = None) -> DataFrame:
    """Totals by result that are not zero."""
    total = F.count("*") if amount is None else F.sum(amount)
    return rows.groupBy(F.col(result).alias("result")).agg(total.alias("n")).where("n > 0")


def counter_diff(now: DataFrame, before: DataFrame) -> DataFrame:
    """What each counter gained since a snapshot."""
    joined = now.alias("a").join(before.alias("b"), "result", "full")
    return joined.select("result", (F.coalesce("a.n", F.lit(0)) - F.coalesce("b.n", F.lit(0))).alias("delta"))


def merge_counters(parts: list[DataFrame]) -> DataFrame:
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("result").agg(F.sum("n").alias("n"))


def systemic_failure(total: Column, synced: Column, partial: Column, failed: Column) -> Column:
    """Something failed, and nothing was synced (not even in part) or half of all items failed."""
    return (total > 0) & (failed > 0) & ((synced + partial == 0) | (failed / total >= 0.5))


def item_outcome(synced: Column, error: Column) -> Column:
    return F.when(synced & error, "PARTIAL").when(synced, "SYNCED").when(error, "ERROR").otherwise("MAPPING")


# Fixed patterns: the line that names an item, the line of a failed download, and that of one without a URL.
FAILED_ITEM, FAILED_DOWNLOAD, FAILED_EMPTY = r"Failed: ([0-9a-f]{32})", "Failed downloading", "Failed downloading  to"


def failed_downloads(log: DataFrame) -> DataFrame:
    """(file, line_no, text) of download logs -> items with a failed download: of the failures after an item's line the first
    counts, unless it had no URL."""
    named = F.col("text").rlike(FAILED_ITEM)
    over = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    held = carry_forward(log.withColumn("_block", F.sum(named.cast("int")).over(over)), ["file"], ["line_no"], F.when(named, F.regexp_extract("text", FAILED_ITEM, 1)), "id")
    first = held.where(~named & F.col("text").contains(FAILED_DOWNLOAD) & F.col("id").isNotNull()).groupBy("file", "_block", "id").agg(F.min_by("text", "line_no").alias("text"))
    return first.where(~F.col("text").contains(FAILED_EMPTY)).select("file", "id").distinct()


def printed(counts: DataFrame) -> DataFrame:
    """One block of text: a line for each counter that is above zero, by name."""
    lines = counts.where("n > 0").select(F.struct(F.col("result"), F.concat(F.col("result"), F.lit(": "), F.col("n").cast("string")).alias("line")).alias("l"))
    return lines.agg(F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n").alias("block"))


def tally(rows: DataFrame, anchor: str) -> DataFrame:
    """How many rows were resolved by each anchor."""
    return rows.groupBy(F.col(anchor).alias("anchor")).agg(F.count("*").alias("n"))


def skips_by_reason(rows: DataFrame) -> DataFrame:
    """(id, ordinal, reason) -> each reason of an item with its ordinals."""
    return rows.where("reason <> ''").groupBy("id", "reason").agg(F.array_sort(F.collect_list("ordinal")).alias("ordinals"))


def groups(files: DataFrame, limit: int | None = None) -> DataFrame:
    """(id, file) -> an item's files together, of the first items by id if there is a limit."""
    own = files.groupBy("id").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return own if limit is None else own.orderBy("id").limit(limit)


# Fixed patterns: lines of phase logs that are counted, and those that state a number.
COUNTED = {"items": "DPLA ID:", "uploaded": "Uploaded to", "skipped": "Skipping.*Already exists on commons", "done": "COUNTS:", "ordinals": "-- Ordinal [0-9]+:"}
STATED = {"hand_fix": r"UPLOAD_HAND_FIX:\s*(\d+)", "merged": r"UPLOAD_MERGED_TO_CANONICAL:\s*(\d+)", "maintain_total": r"maintain scope: (\d+) files"}


def phase_counts(lines: DataFrame) -> DataFrame:
    """(log, line_no, text) -> the eight numbers of a phase's log in one pass: lines of five kinds, and the last of three stated
    numbers; 0 where there are none."""
    counted = [F.count_if(F.col("text").rlike(pattern)).alias(name) for name, pattern in COUNTED.items()]
    number = lambda pattern: F.regexp_extract("text", pattern, 1).try_cast("bigint")
    stated = [F.coalesce(F.max_by(number(p), F.when(number(p).isNotNull(), F.col("line_no"))), F.lit(0)).alias(name) for name, p in STATED.items()]
    return lines.groupBy("log").agg(*counted, *stated)
