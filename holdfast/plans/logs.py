"""Run logs, counters and revision history over the driver's events and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import provenance, runlogs
from .registry import Registry
from .roles import LOG_SQL, log, table

LOGS = Registry()
query = LOGS.query
_BY, _ORDER = ["user_id"], ["ts", "event_id"]


@query(f"WITH {LOG_SQL} SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN k END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM log")
def carry_forward_id(spark: SparkSession, d: str) -> DataFrame:
    return runlogs.carry_forward(log(spark, d), _BY, _ORDER, F.when(F.col("event_type") == "signup", F.col("k"))).select("event_id", "carried")


@query(
    f"""WITH {LOG_SQL}, c AS (SELECT *, sum((event_type IN ('error', 'click'))::INT) OVER w AS cut, sum((event_type = 'error')::INT) OVER w AS block FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
o AS (SELECT *, first_value(event_type = 'error') OVER (PARTITION BY user_id, cut ORDER BY ts, event_id) AS open FROM c)
SELECT user_id, block::BIGINT AS block, count(*) AS lines, bool_or(event_type = 'purchase') AS passes FROM o WHERE open GROUP BY ALL"""
)
def error_blocks(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    found = runlogs.blocks(log(spark, d), _BY, _ORDER, kind == "error", kind == "click")
    return found.groupBy("user_id", "block").agg(F.count("*").alias("lines"), F.bool_or(kind == "purchase").alias("passes"))


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    outcome = F.when(kind == "error", "retry").when(kind == "purchase", "done")
    return log(spark, d).select("user_id", "k", F.to_date("ts").alias("run"), outcome.alias("outcome")).where("outcome is not null")


_OUTCOMES_SQL = "outcomes AS (SELECT user_id, k, ts::DATE AS run, CASE event_type WHEN 'error' THEN 'retry' ELSE 'done' END AS outcome FROM log WHERE event_type IN ('error', 'purchase'))"


@query(f"WITH {LOG_SQL}, {_OUTCOMES_SQL} SELECT user_id, k, run, outcome FROM (SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY run DESC, outcome = 'retry' DESC) AS n FROM outcomes) WHERE n = 1")
def latest_outcome(spark: SparkSession, d: str) -> DataFrame:
    return runlogs.latest_outcome(_outcomes(spark, d), ["user_id", "k"], "run")


@query(
    f"""WITH {LOG_SQL}, p AS (SELECT DISTINCT user_id, k % 20 AS k, event_type FROM log),
d AS (SELECT user_id, k FROM p WHERE event_type = 'click' EXCEPT SELECT user_id, k FROM p WHERE event_type = 'purchase'),
u AS (SELECT user_id, k FROM p WHERE event_type = 'error' EXCEPT SELECT * FROM d),
s AS ((SELECT user_id, k FROM p WHERE event_type = 'signup' EXCEPT SELECT * FROM u) EXCEPT SELECT * FROM d)
SELECT *, 'download' AS phase FROM d UNION ALL SELECT *, 'upload' FROM u UNION ALL SELECT *, 'sync' FROM s"""
)
def retry_sets(spark: SparkSession, d: str) -> DataFrame:
    rows = log(spark, d).select("user_id", (F.col("k") % 20).alias("k"), "event_type")
    of = lambda kind: rows.where(F.col("event_type") == kind)
    return runlogs.retry_sets(of("click"), of("error"), of("signup"), of("purchase"), ["user_id", "k"])


@query(f"WITH {LOG_SQL} SELECT user_id, count(*) AS lines, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS synced, max(CASE WHEN event_type = 'error' THEN ts END) AS last_error, coalesce(sum(CASE WHEN event_type = 'purchase' THEN k END), 0)::BIGINT AS amount FROM log GROUP BY user_id")
def counters_single_pass(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    return log(spark, d).groupBy("user_id").agg(
        F.count("*").alias("lines"),
        F.count_if(kind == "error").alias("errors"),
        F.count_if(kind == "purchase").alias("synced"),
        F.max(F.when(kind == "error", F.col("ts"))).alias("last_error"),
        F.coalesce(F.sum(F.when(kind == "purchase", F.col("k"))), F.lit(0)).alias("amount"),
    )


@query(
    f"""WITH {LOG_SQL}, h AS (SELECT count(*) // 2 AS n FROM log), a AS (SELECT event_type AS result, count(*) AS n FROM log GROUP BY 1), b AS (SELECT event_type AS result, count(*) AS n FROM log WHERE event_id < (SELECT n FROM h) GROUP BY 1)
SELECT result, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta FROM a FULL JOIN b USING (result)"""
)
def counter_diff(spark: SparkSession, d: str) -> DataFrame:
    own = log(spark, d)
    half = own.agg(F.floor(F.count("*") / 2).alias("half"))
    before = own.join(F.broadcast(half), F.col("event_id") < F.col("half"))
    return runlogs.counter_diff(runlogs.counters(own, "event_type"), runlogs.counters(before, "event_type"))


@query(
    f"""WITH {LOG_SQL}, c AS (SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type = 'purchase') AS synced, count(*) FILTER (event_type = 'signup') AS partial FROM log GROUP BY 1)
SELECT user_id, total > 0 AND failed > 0 AND (synced + partial = 0 OR failed / total >= 0.5) AS abort FROM c"""
)
def systemic_failure(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    counts = [F.count("*").alias("total"), *[F.count_if(kind == k).alias(name) for k, name in (("error", "failed"), ("purchase", "synced"), ("signup", "partial"))]]
    counted = log(spark, d).groupBy("user_id").agg(*counts)
    return counted.select("user_id", runlogs.systemic_failure(*[F.col(c) for c in ("total", "synced", "partial", "failed")]).alias("abort"))


@query(f"WITH {LOG_SQL}, c AS (SELECT user_id, k, bool_or(event_type = 'purchase') AS s, bool_or(event_type = 'error') AS e FROM log GROUP BY ALL) SELECT user_id, k, CASE WHEN s AND e THEN 'PARTIAL' WHEN s THEN 'SYNCED' WHEN e THEN 'ERROR' ELSE 'MAPPING' END AS outcome FROM c")
def item_outcome(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    flags = log(spark, d).groupBy("user_id", "k").agg(F.bool_or(kind == "purchase").alias("s"), F.bool_or(kind == "error").alias("e"))
    return flags.select("user_id", "k", runlogs.item_outcome(F.col("s"), F.col("e")).alias("outcome"))


def _revisions(spark: SparkSession, d: str) -> DataFrame:
    """Each turn as a revision with two parameters, each of which may be missing."""
    size = F.length("text")
    params = F.map_filter(
        F.create_map(F.lit("title"), F.when(size % 4 != 0, F.col("text")), F.lit("date"), F.when(size % 3 != 0, (size % 7).cast("string"))),
        lambda k, v: v.isNotNull(),
    )
    return table(spark, d, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("rev"), F.col("role").alias("user"), params.alias("params"))


@query(
    """WITH l AS (SELECT conv_id AS page, turn AS rev, role AS user, unnest(['title', 'date']) AS key,
    unnest([CASE WHEN len(text) % 4 <> 0 THEN text END, CASE WHEN len(text) % 3 <> 0 THEN (len(text) % 7)::VARCHAR END]) AS value FROM conversations),
c AS (SELECT *, value IS DISTINCT FROM lag(value) OVER (PARTITION BY page, key ORDER BY rev) AS changed FROM l)
SELECT page, key, (array_agg(value ORDER BY rev DESC))[1] AS value, (array_agg(user ORDER BY rev DESC) FILTER (changed))[1] AS user,
  CASE WHEN lower((array_agg(user ORDER BY rev DESC) FILTER (changed))[1]) = 'assistant' THEN 'bot' ELSE 'community' END AS origin
FROM c GROUP BY page, key HAVING (array_agg(value ORDER BY rev DESC))[1] IS NOT NULL"""
)
def provenance_trace(spark: SparkSession, d: str) -> DataFrame:
    return provenance.classify(provenance.trace(_revisions(spark, d)), ["Assistant"])


@query("SELECT conv_id AS page, arg_min(role, turn) AS user FROM conversations GROUP BY conv_id")
def oldest_editor(spark: SparkSession, d: str) -> DataFrame:
    return provenance.first_editor(_revisions(spark, d))


@query(f"WITH {LOG_SQL} SELECT date_trunc('hour', ts) AS start, event_type AS result, count(*) AS n FROM log GROUP BY 1, 2")
def windowed_counters(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming import runlog

    return runlog.windowed_counters(log(spark, d))
