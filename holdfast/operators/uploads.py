"""What an upload or a download of an item does, decided from joined facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .ordinals import DOWNLOAD_ONLY, INVALID

# Types that say nothing, and what our titles have in them.
UNTYPED = ("application/octet-stream", "binary/octet-stream")
TITLE_MARKS = (" - DPLA - ", " - NARA - ")
UNKNOWN_EXTENSION = ".bin"


def accepted_type(content_type: Column) -> Column:
    return ~content_type.isin(*INVALID)


def staged_only(content_type: Column) -> Column:
    """Types that are kept for conversion, and not uploaded."""
    return content_type.isin(*DOWNLOAD_ONLY)


def exists(size: Column) -> Column:
    """An object that is there and not empty."""
    return F.coalesce(size > 0, F.lit(False))


def own_title(title: Column) -> Column:
    out = F.lit(False)
    for mark in TITLE_MARKS:
        out = out | title.contains(mark)
    return out


def account(name: Column) -> Column:
    """An account's name for comparing."""
    return F.trim(F.replace(F.lower(name), F.lit("_"), F.lit(" ")))


def is_community_file(title: Column, uploader: Column, bots: tuple[str, ...]) -> Column:
    """Neither the title nor the first uploader is ours; so if the uploader is not known."""
    ours = F.coalesce(account(uploader).isin(*[b.replace("_", " ").lower().strip() for b in bots]), F.lit(False))
    return ~own_title(title) & ~ours


def is_duplicate_sibling(sha1: Column, found_title: Column, duplicates: Column, expected: Column) -> Column:
    """The content is several times in the item, and was found under one of the item's titles."""
    return F.coalesce(F.array_contains(duplicates, sha1) & F.array_contains(expected, found_title), F.lit(False))


def is_same_item_relic(intended: Column, target: Column, item: Column) -> Column:
    """Both titles are of this item, and of different pages of it."""
    same = (text.id_in_title(intended) == item) & (text.id_in_title(target) == item)
    return F.coalesce(same & (text.page_in_title(intended) != text.page_in_title(target)), F.lit(False))


def media_type(content_type: Column, detected: Column) -> Column:
    """The type of an object, or what was detected where the type says nothing; null if that says nothing either."""
    return F.when(~content_type.isin(*UNTYPED), content_type).when(~detected.isin(*UNTYPED), detected)


def upload_verdict(facts: DataFrame, bots: tuple[str, ...]) -> DataFrame:
    """One verdict a medium, from the first rule that holds.

    facts: id, ordinal, size, content_type, detected, extension, intended, sha1, found_title, found_uploader, duplicates
    (array), expected (array), drift (the outcome for content under another title), failed.
    """
    kind = media_type(F.col("content_type"), F.col("detected"))
    bad_extension = F.coalesce("extension", F.lit("")).isin("", UNKNOWN_EXTENSION)
    verdict = (
        F.when(~exists(F.col("size")), "NOT_PRESENT")
        .when(kind.isNull() | ~F.coalesce(accepted_type(kind), F.lit(False)) | F.coalesce(staged_only(kind), F.lit(False)) | bad_extension, "INELIGIBLE")
        .when(F.col("found_title") == F.col("intended"), "SKIPPED")
        .when(F.col("found_title").isNotNull() & is_community_file(F.col("found_title"), F.col("found_uploader"), bots), "HAND_FIX")
        .when(is_duplicate_sibling(F.col("sha1"), F.col("found_title"), F.col("duplicates"), F.col("expected")), "MERGED")
        .when(F.col("found_title").isNotNull(), F.coalesce("drift", F.lit("FAILED")))
        .when(F.coalesce("failed", F.lit(False)), "FAILED")
        .otherwise("UPLOADED")
    )
    return facts.select("id", "ordinal", verdict.alias("verdict"))


def media_source(item: DataFrame, overwrite: bool = False, max_age: int | None = None) -> DataFrame:
    """Where an item's list of media comes from: its own, a cached list, its manifest, or nowhere.

    item: id, staged, media array, manifest, cached array, cached_age (days).
    """
    listed = F.col("media").isNotNull()
    fresh = F.lit(not overwrite) & (F.size(F.coalesce("cached", F.array().cast("array<string>"))) > 0)
    if max_age is not None:
        fresh = fresh & F.coalesce(F.col("cached_age") < max_age, F.lit(False))
    source = F.when(~F.coalesce("staged", F.lit(False)), "unstaged").when(listed, "media").when(F.col("manifest").isNotNull() & fresh, "cached").when(F.col("manifest").isNotNull(), "manifest").otherwise("none")
    return item.select("id", source.alias("source"))


def partner_check(partners: DataFrame, hubs: DataFrame, maintain: bool = False) -> DataFrame:
    """Whether each partner is known and uploads; maintenance asks only that it is known.  hubs: slug, eligible."""
    joined = partners.join(hubs.select(F.col("slug").alias("partner"), "eligible"), "partner", "left")
    status = F.when(F.col("eligible").isNull(), "unknown").when(F.col("eligible") | F.lit(maintain), "ok").otherwise("no upload")
    return joined.select("partner", status.alias("status"))


def wiki_eligibility(items: DataFrame, banned: DataFrame) -> DataFrame:
    """Every criterion of an item as a column of its own, and their conjunction.

    items: id, rights, media array, manifest, derived_manifest, hub_qid, inst_qid, hub_upload, inst_upload.
    """
    filled = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    flags = banned.select("id", F.lit(True).alias("_banned")).distinct()
    checks = items.join(flags, "id", "left").select(
        "id",
        F.coalesce(F.col("rights") == "Unlimited Re-Use", F.lit(False)).alias("rights_ok"),
        ((F.size(F.coalesce("media", F.array().cast("array<string>"))) > 0) | filled("manifest") | filled("derived_manifest")).alias("asset_ok"),
        (F.coalesce("hub_upload", F.lit(False)) | F.coalesce("inst_upload", F.lit(False))).alias("provider_ok"),
        F.col("_banned").isNull().alias("id_ok"),
        (filled("hub_qid") & filled("inst_qid")).alias("entities_ok"),
    )
    return checks.withColumn("eligible", F.col("rights_ok") & F.col("asset_ok") & F.col("provider_ok") & F.col("id_ok") & F.col("entities_ok"))


def synced_ordinals(claims: DataFrame, results: DataFrame, files: DataFrame, rescued: DataFrame) -> DataFrame:
    """The media of items that have statements: each with its page on the wiki (found by title where the upload failed) and
    the URL that it came from.

    claims: id; results: id, ordinal, status, pageid; files: id, ordinal, url; rescued: id, ordinal, pageid.
    """
    known = results.join(claims.select("id").distinct(), "id", "left_semi")
    found = rescued.select("id", "ordinal", F.col("pageid").alias("_rescued"))
    joined = known.join(files.select("id", "ordinal", "url"), ["id", "ordinal"], "left").join(found, ["id", "ordinal"], "left")
    page = F.when(F.col("status").isin("UPLOADED", "SKIPPED", "MERGED"), F.col("pageid")).otherwise(F.col("_rescued"))
    return joined.select("id", "ordinal", page.alias("pageid"), "url").where("pageid is not null")


def write_results(results: DataFrame, existing: DataFrame) -> DataFrame:
    """Verdicts of a run in place of those that the same items had."""
    return existing.join(results.select("id").distinct(), "id", "left_anti").unionByName(results)


def titles_by_page(files: DataFrame, item: Column) -> DataFrame:
    """Files whose title carries exactly an item's id, by page number ("1" where the title has none).  Of files with one number
    the first by title counts."""
    own = files.where(text.id_in_title(F.col("title")) == item).withColumn("item", item).withColumn("page", F.coalesce(text.page_in_title(F.col("title")).cast("string"), F.lit("1")))
    first = F.row_number().over(Window.partitionBy("item", "page").orderBy("title"))
    return own.withColumn("_n", first).where("_n = 1").select("item", "page", "title")
