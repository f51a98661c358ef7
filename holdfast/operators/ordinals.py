"""Media of an item in order: page labels, duplicates, verification, gaps, retirement.

ordinals: id, ordinal, ext, sha1, size, content_type
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_MISSES, CEILING = 2, 500
# Media types that are staged only, and those that are never taken.
DOWNLOAD_ONLY = ("video/mp4", "video/x-msvideo", "video/quicktime", "audio/x-ms-wma", "video/x-ms-wmv")
INVALID = (
    "text/html", "application/json", "application/xml", "text/xml", "text/plain", "application/msword", "application/octet-stream", "application/rtf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation", "application/vnd.ms-excel", "application/vnd.ms-powerpoint",
)


def page_labels(ordinals: DataFrame) -> DataFrame:
    """The k-th medium of an extension is page k, if the item has more than one of that extension; else no label."""
    of = Window.partitionBy("id", "ext")
    k = F.row_number().over(of.orderBy("ordinal"))
    return ordinals.withColumn("page", F.when(F.count("*").over(of) > 1, k.cast("string")).otherwise(""))


def eligible_pages(ordinals: DataFrame, eligible: Column) -> DataFrame:
    """Page labels counted over eligible media alone."""
    return page_labels(ordinals.where(eligible))


def duplicate_content(ordinals: DataFrame) -> DataFrame:
    """Content that an item has twice or more."""
    return ordinals.where("sha1 is not null").groupBy("id", "sha1").agg(F.count("*").alias("copies")).where("copies > 1")


def page_union(ordinals: DataFrame) -> DataFrame:
    """All pages that show a medium's content, its own first of all; none where it has no label."""
    pages = F.array_sort(F.collect_set(F.when(F.col("page") != "", F.col("page").cast("int"))).over(Window.partitionBy("id", "sha1")))
    return page_labels(ordinals).withColumn("pages", F.when(F.col("page") == "", F.array().cast("array<int>")).otherwise(pages))


def verify(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(id, ordinal, title, sha1, eligible) against (title, found_sha1, redirect): a status for each medium."""
    status = (
        F.when(~F.col("eligible"), "SKIPPED")
        .when(F.col("there").isNull(), "MISSING")
        .when(F.col("redirect"), "REDIRECT")
        .when(F.col("sha1") == F.col("found_sha1"), "CORRECT")
        .otherwise("MISMATCH")
    )
    return expected.join(found.withColumn("there", F.lit(True)), "title", "left").select("id", "ordinal", status.alias("status"))


def incomplete(items: DataFrame, ordinals: DataFrame) -> DataFrame:
    """(id, listed) items whose media are not as many as their list says."""
    counts = ordinals.groupBy("id").agg(F.count("*").alias("found"))
    return items.join(counts, "id", "left").select("id", "listed", F.coalesce("found", F.lit(0)).alias("found")).where("listed <> found")


def gap_audit(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """Pages beyond the expected count (all from the first, if one is expected) up to the first run of more than MAX_MISSES
    gaps, CEILING pages at most.  Items that should have none are not looked at.

    pages: id, page; expected: id, n
    """
    start = F.when(F.col("n") == 1, 0).otherwise(F.col("n"))
    known = expected.where("n >= 1").withColumn("start", start)
    beyond = pages.select("id", "page").distinct().join(known, "id").where((F.col("page") > F.col("start")) & (F.col("page") <= F.col("start") + CEILING))
    of = Window.partitionBy("id").orderBy("page")
    jump = F.col("page") - F.coalesce(F.lag("page").over(of), F.col("start")) - 1 > MAX_MISSES
    marked = beyond.select("id", "page", jump.alias("jump"))
    return marked.withColumn("stops", F.sum(F.col("jump").cast("int")).over(of)).where("stops = 0").select("id", "page")


def content_exists(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """(sha1) that some file has."""
    return wanted.join(files.select("sha1").distinct(), "sha1", "left_semi")


def content_hash(content: Column) -> Column:
    """SHA-1 of bytes, or of a text's UTF-8."""
    return F.sha1(content.cast("binary"))


def signed(objects: DataFrame) -> DataFrame:
    """Objects (path, sha1, content) with the hashes that are missing; those that have one are not read for it."""
    missing = F.coalesce("sha1", F.lit("")) == ""
    return objects.select("path", F.when(missing, content_hash(F.col("content"))).otherwise(F.col("sha1")).alias("sha1"))


def by_hash(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """(sha1, preferred) -> the file with that content: the preferred title, else the earliest upload, else by title.

    files: sha1, title, uploaded
    """
    order = Window.partitionBy("sha1", "preferred").orderBy((F.col("title") == F.col("preferred")).desc_nulls_last(), F.asc_nulls_last("uploaded"), "title")
    return wanted.join(files, "sha1").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def skip_reason(size: Column, content_type: Column) -> Column:
    return (
        F.when(size.isNull(), "absent").when(size == 0, "empty").when(content_type.isin(*DOWNLOAD_ONLY), "download only").when(content_type.isin(*INVALID), "bad type").otherwise("")
    )


def retire_decision(size: Column, eligible: Column, sha1: Column, content_type: Column, ext: Column, landed: Column) -> Column:
    return (
        F.when(size.isNull(), "ABSENT")
        .when(size == 0, "BLANK")
        .when(~eligible, "INELIGIBLE")
        .when(sha1.isNull(), "NO_HASH")
        .when(content_type.isin(*INVALID), "BAD_TYPE")
        .when(ext == "", "BAD_EXTENSION")
        .when(landed, "RETIRE")
        .otherwise("KEEP")
    )


def download_decision(age: Column, overwrite: Column, valid: Column, max_age: int) -> Column:
    """age: days since it was staged, null if it never was."""
    return (
        F.when(age.isNotNull() & ~overwrite & (age <= max_age), "SKIPPED")
        .when(~valid, "REJECTED")
        .when(age.isNotNull(), "REFRESHED")
        .otherwise("FETCHED")
    )
