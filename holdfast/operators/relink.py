"""Finding the present id of a file, and what to do when its content lies elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls


def relink(files: DataFrame, live: DataFrame) -> DataFrame:
    """files: file, embedded_id, url, scope; live: id, shown_at, scope.

    The embedded id if it lives; else the one record with a variant of the URL; else the one record of the scope whose
    URL holds the file's token.  More than one record at a step is ambiguous and ends the search.
    """
    own = files.select("file", "embedded_id", "url", "scope")
    alive = own.join(live.select(F.col("id").alias("embedded_id")).distinct(), "embedded_id", "left_semi").select("file", F.col("embedded_id").alias("direct"))
    spread = own.select("file", F.explode(urls.variants(F.col("url"))).alias("shown_at"))
    exact = spread.join(live.select("id", "shown_at"), "shown_at").groupBy("file").agg(F.min("id").alias("exact"), F.count_distinct("id").alias("n_exact"))
    # a record whose URL holds the token has the token's last letters somewhere, so that the search starts as an equality; only
    # tokens of files that are still open are looked for, each once in a scope
    starts = F.sequence(F.lit(1), F.greatest(F.length("shown_at") - urls.MIN_TOKEN + 1, F.lit(1)))
    pieces = F.array_distinct(F.transform(starts, lambda i: F.substring("shown_at", i, F.lit(urls.MIN_TOKEN))))
    pieces = F.explode(F.filter(pieces, lambda x: x.rlike(f"^[A-Za-z0-9_-]{{{urls.MIN_TOKEN}}}$")))
    found = own.join(alive, "file", "left").join(exact, "file", "left").withColumn("token", F.when(F.col("direct").isNull() & F.col("n_exact").isNull(), urls.stable_token(F.col("url"))))
    tokens = found.where("token is not null").select("scope", "token").distinct().withColumn("gram", F.substring("token", -urls.MIN_TOKEN, urls.MIN_TOKEN))
    near = live.select("id", "scope", "shown_at", pieces.alias("gram")).join(tokens, ["scope", "gram"]).where(F.contains("shown_at", "token"))
    scoped = near.groupBy("scope", "token").agg(F.min("id").alias("scoped"), F.count_distinct("id").alias("n_scoped"))
    joined = found.join(scoped, ["scope", "token"], "left")
    anchor = (
        F.when(F.col("direct").isNotNull(), "embedded")
        .when(F.col("n_exact") == 1, "shown_at")
        .when(F.col("n_exact") > 1, "ambiguous")
        .when(F.col("n_scoped") == 1, "token")
        .when(F.col("n_scoped") > 1, "ambiguous")
        .otherwise("unresolved")
    )
    chosen = F.when(anchor == "embedded", F.col("direct")).when(anchor == "shown_at", F.col("exact")).when(anchor == "token", F.col("scoped"))
    return joined.select("file", anchor.alias("anchor"), chosen.alias("id"))


def drift_outcome(community: Column, same_title: Column, other_item_live: Column, title_empty: Column, redirects_to_self: Column, redirects: Column, sibling: Column) -> Column:
    """What to do with content that lies under another title than intended; the first rule that holds."""
    return (
        F.when(F.coalesce(community, F.lit(True)), "HAND_FIX_COMMUNITY")
        .when(same_title, "ALREADY_CORRECT")
        .when(other_item_live, "HAND_FIX")
        .when(title_empty, "MOVED")
        .when(redirects_to_self, "MOVED")
        .when(redirects, "HAND_FIX")
        .when(sibling, "MERGE_AND_REDIRECT")
        .otherwise("HAND_FIX")
    )
