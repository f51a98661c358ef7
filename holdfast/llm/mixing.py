"""Mixing sources to target weights, with weights that change over training.

DataFrame functions only.  Each source's weight schedule is piecewise linear over training time 0..1.  Its integral,
scaled to the source's target, is the source's cumulative demand for words; inverting it at a document's place in the
source's shuffled order gives the document's training position.  Documents are range-sorted by position.

A source's target is its share, by weight, of all words, at most ``MAX_EPOCHS`` times its own; what a capped source
cannot take goes to the others by weight.  Whole passes over a source come first; a last part pass takes whole
documents in hash order up to the one that brings the sum nearest to the target.

Null texts have size 0 and are never taken; a null source is a source of its own, last in order; repeated rows each
count; an empty table gives an empty mix; other columns pass through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Weight at times 0, 1/2 and 1, as parts of a source's mean weight, for its first, second and third weight class:
#: early, steady and late sources.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (0.5, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
#: Rows of one source's hash range that one window sorts together.
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def shuffle_key() -> Column:
    """Orders the documents of a source: 60 bits of an md5 of id and text, so that SQL elsewhere can repeat it."""
    whole = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, size) rows -> one row a source: rank, weight, source_size, target.

    Filling by weight with caps has a closed form: in ascending order of cap over weight, the capped sources are those
    before the first that its share of what is left does not exceed.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    per = per.withColumn("rank", rank).withColumn("weight", weight).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = per.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    uncapped = F.col("level") * F.col("weight") <= F.col("cap")
    # The level of the first source that stays below its cap holds for it and all after it.
    fill = F.min(F.when(uncapped, F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(everything)["level"]
    return per.withColumn("fill", fill).select(
        "source", "rank", "weight", "source_size", F.when(F.col("fill").isNull() | (F.col("fill") * F.col("weight") > F.col("cap")), F.col("cap")).otherwise(F.col("fill") * F.col("weight")).alias("target")
    )


def position_at(share: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """The time by which ``share`` of a source's demand has been drawn: its integrated schedule, inverted."""
    branches = None
    for k, knots in enumerate(schedules):
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
        total, done, at = sum(areas), 0.0, F.lit(float(knots[-1][0]))
        pieces = []
        for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas, strict=True):
            slope, need = (w1 - w0) / (t1 - t0), share * total - done
            # w0 x + slope x^2 / 2 = need, in the form that holds for slope 0 too
            x = 2 * need / (w0 + F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * need)))
            pieces.append((share * total < done + area, t0 + x))
            done += area
        for condition, value in reversed(pieces):
            at = F.when(condition, value).otherwise(at)
        mine = F.col(rank) % len(schedules) == k if isinstance(rank, str) else rank % len(schedules) == k
        branches = F.when(mine, at) if branches is None else branches.when(mine, at)
    return branches


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, schedules=SCHEDULES) -> DataFrame:
    """One row a document: doc_id, key, source, size, source_size, target, rank, epochs (whole passes), copies, taken, offset.

    A hot source is cut into hash ranges: sums of ranges are windowed first, then the rows of each range.
    """
    slim = common.materialize(
        docs.select("doc_id", F.col("source"), word_count(F.col("text")).alias("size"), shuffle_key().alias("key")), "mix"
    )
    rows = slim.count()
    bits = max(0, (max(1, rows) // BUCKET_ROWS).bit_length())
    slim = slim.withColumn("bucket", F.shiftrightunsigned("key", 60 - bits))
    targets = source_targets(slim, weights, max_epochs)
    ranges = slim.groupBy("source", "bucket").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    facts = ranges.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select("r.source", "bucket", "range_start", "rank", "weight", "source_size", "target")
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.alias("d").join(facts.alias("f"), F.col("d.source").eqNullSafe(F.col("f.source")) & (F.col("d.bucket") == F.col("f.bucket"))).select(
        "doc_id", "key", "d.source", "size", "source_size", "target", "rank", (F.col("range_start") + F.col("within")).alias("offset")
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("epochs") + (2 * F.col("offset") + F.col("size") <= 2 * rest).cast("bigint"))
    placed = placed.withColumn("epochs", epochs).withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return placed.withColumn("position", position_of(F.lit(0), schedules))


def position_of(epoch: Column, schedules=SCHEDULES) -> Column:
    """Training position of a document's copy in the given pass (0 for the first)."""
    drawn = (epoch * F.col("source_size") + F.col("offset") + F.col("size") / 2) / F.col("target")
    return position_at(F.when(F.col("target") > 0, F.least(F.lit(1.0), drawn)).otherwise(F.lit(1.0)), F.col("rank"), schedules)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, schedules=SCHEDULES) -> DataFrame:
    """The mixed corpus: a row for each copy taken, in training order, with the columns of ``docs`` and ``_position``."""
    plan = plan_mix(docs, weights, max_epochs, schedules).where("copies > 0")
    # whole rows go in one column, so that theirs and the plan's names cannot meet
    keyed = docs.select(F.struct(shuffle_key().alias("key"), F.col("doc_id").alias("id"), F.col("source").alias("source")).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    mine = plan.select(F.struct("key", F.col("doc_id").alias("id"), "source").alias("_key"), F.struct("offset", "size", "source_size", "target", "rank", "copies").alias("_plan"))
    # equal ids, texts and sources are one key: each of its rows has its own plan row, paired by number; numbers and join want
    # rows dealt by the same one column, so that whole rows are exchanged once for both
    number = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    plans = mine.groupBy("_key").agg(F.sort_array(F.collect_list("_plan")).alias("_plans"))
    joined = keyed.withColumn("_n", number).join(plans, "_key").select(F.col("_key.key").alias("_key"), "_doc", F.get("_plans", F.col("_n") - 1).alias("_plan")).where("_plan is not null")
    copies = joined.select("_key", "_doc", "_plan.*", F.explode(F.sequence(F.lit(0), F.col("_plan.copies").cast("int") - 1)).alias("_epoch"))
    out = copies.select("_doc", position_of(F.col("_epoch"), schedules).alias("_position"), "_key")
    return out.repartitionByRange("_position", "_key").sortWithinPartitions("_position", "_key").select("_doc.*", "_position")


def mix_sources(docs: DataFrame) -> DataFrame:
    """Contract of op3, with the position of each document's first copy."""
    plan = plan_mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "position", "key")
    return plan.repartitionByRange("position", "key").sortWithinPartitions("position", "key").drop("key")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, (rank % 3 + 1)::DOUBLE AS weight, 3.0::DOUBLE * source_size::DOUBLE AS cap FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
filled AS (
  SELECT *, (SELECT arg_min(level, cap / weight * 1e6 + rank) FROM levels WHERE level * weight <= cap) AS fill FROM levels),
targets AS (
  SELECT source, rank, source_size, CASE WHEN fill IS NULL OR fill * weight > cap THEN cap ELSE fill * weight END AS target FROM filled),
placed AS (
  SELECT s.*, t.source_size, t.target, t.rank,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos0
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
         CASE WHEN target > 0 THEN least(1.0, (pos0 + size / 2) / target) ELSE 1.0 END AS share
  FROM placed)
SELECT doc_id, source, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE size * (epochs + (2 * pos0 + size <= 2 * (target - epochs * source_size))::BIGINT) END::BIGINT AS taken,
       CASE rank % 3
         WHEN 1 THEN CASE WHEN share < 0.5 THEN 0.0 + 2 * (share - 0.0) / (1.0 + sqrt(greatest(0.0, 1.0)))
                          WHEN share < 1.0 THEN 0.5 + 2 * (share - 0.5) / (1.0 + sqrt(greatest(0.0, 1.0))) ELSE 1.0 END
         WHEN 0 THEN CASE WHEN share < 0.625 THEN 0.0 + 2 * share / (1.5 + sqrt(greatest(0.0, 2.25 - 2 * share)))
                          WHEN share < 1.0 THEN 0.5 + 2 * (share - 0.625) / (1.0 + sqrt(greatest(0.0, 1.0 - 2 * (share - 0.625)))) ELSE 1.0 END
         ELSE CASE WHEN share < 0.375 THEN 0.0 + 2 * share / (0.5 + sqrt(greatest(0.0, 0.25 + 2 * share)))
                   WHEN share < 1.0 THEN 0.5 + 2 * (share - 0.375) / (1.0 + sqrt(greatest(0.0, 1.0 + 2 * (share - 0.375)))) ELSE 1.0 END
       END AS position
FROM passes
"""
