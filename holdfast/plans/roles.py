"""The driver's tables in the roles of archive records.

hub = nation, institution = customer, item = orders, medium = lineitem, run log = events, revisions = conversations,
ban list = toxic documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OLD = "1995-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry; nation is a fixed, tiny table."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("n_name").alias("hub"),
        F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("hub_qid"),
        (F.col("n_nationkey") % 5 == 0).alias("hub_upload"),
        F.col("c_name").alias("inst"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("Q"), F.col("c_custkey").cast("string"))).alias("inst_qid"),
        (F.col("c_mktsegment") == "BUILDING").alias("inst_upload"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, customer, orders = (table(spark, sf_dir, t) for t in ("nation", "customer", "orders"))
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.col("n_name").alias("hub"),
        F.col("c_name").alias("inst"),
        F.when(F.col("o_orderstatus") == "F", "unlimited").when(F.col("o_orderstatus") == "O", "conditional").otherwise("unspecified").alias("rights"),
        (F.col("o_orderpriority") != "5-LOW").alias("has_asset"),
        (F.col("o_orderdate") < F.lit(OLD).cast("timestamp_ntz")).alias("old"),
    )


def banned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))


_LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, line number) is not unique, so media are numbered anew by every column."""
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        number.alias("ordinal"),
        F.col("l_returnflag").alias("ext"),
        F.sha1(F.col("l_partkey").cast("string").cast("binary")).alias("sha1"),
        F.col("l_quantity").alias("size"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").alias("stamp"),
        F.col("l_suppkey").alias("owner"),
        F.col("l_partkey").alias("part"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


INSTITUTIONS_SQL = """institutions AS (
  SELECT n_name AS hub, 'Q' || n_nationkey AS hub_qid, n_nationkey % 5 = 0 AS hub_upload, c_name AS inst,
         CASE WHEN c_acctbal >= 0 THEN 'Q' || c_custkey END AS inst_qid, c_mktsegment = 'BUILDING' AS inst_upload
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
ITEMS_SQL = f"""items AS (
  SELECT o_orderkey AS id, n_name AS hub, c_name AS inst,
         CASE o_orderstatus WHEN 'F' THEN 'unlimited' WHEN 'O' THEN 'conditional' ELSE 'unspecified' END AS rights,
         o_orderpriority <> '5-LOW' AS has_asset, o_orderdate < TIMESTAMP '{OLD}' AS old
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
BANNED_SQL = "banned AS (SELECT DISTINCT doc_id AS id FROM labels WHERE toxic = 1)"
ORDINALS_SQL = f"""ordinals AS (
  SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_LINE)}) AS ordinal,
         l_returnflag AS ext, sha1(l_partkey::VARCHAR) AS sha1, l_quantity AS size, l_linestatus AS status, l_shipdate AS stamp,
         l_suppkey AS owner, l_partkey AS part
  FROM lineitem)"""
LOG_SQL = "log AS (SELECT event_id, ts, user_id, event_type, value, (props->>'$.k')::BIGINT AS k FROM events)"
