"""Scalar libraries over the driver's texts, URLs and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text, urls
from ..operators import selection, statements
from .registry import Registry
from .roles import table

TEXTS = Registry()
query = TEXTS.query


def _replaced_sql(expression: str, pairs: tuple[tuple[str, str], ...]) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    for old, new in pairs:
        expression = f"replace({expression}, {quote(old)}, {quote(new)})"
    return expression


_CUT = r"regexp_replace(substr(text, 1, 181), '[\s\x0B\x1C-\x1F\x{85}\x{A0}]+$', '')"
_BROKEN = f"CASE WHEN contains({_CUT}, '&') AND contains({_CUT}, '=') THEN translate({_CUT}, '&=', '+-') ELSE {_CUT} END"
_CLEAN = rf"trim(regexp_replace(regexp_replace({_replaced_sql(_BROKEN, text.TITLE_REPLACEMENTS)}, '\p{{Cf}}|\p{{Cc}}', ' ', 'g'), '[\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}]+', ' ', 'g'))"


@query(
    f"""WITH t AS (SELECT doc_id, {_CLEAN} AS t FROM documents)
SELECT doc_id, upper(substr(t, 1, 1)) || substr(t, 2) || ' - DPLA - ' || md5(doc_id::VARCHAR) || CASE WHEN doc_id % 3 = 0 THEN ' (page ' || (doc_id % 10) || ')' ELSE '' END || '.jpg' AS title FROM t"""
)
def title_build(spark: SparkSession, d: str) -> DataFrame:
    page = F.when(F.col("doc_id") % 3 == 0, (F.col("doc_id") % 10).cast("string")).otherwise("")
    identifier = F.md5(F.col("doc_id").cast("string").cast("binary"))
    return table(spark, d, "documents").select("doc_id", text.page_title(F.col("text"), identifier, F.lit(".jpg"), page).alias("title"))


@query(
    r"""WITH t AS (SELECT o_orderkey AS id, 'Scan' || CASE WHEN o_orderkey % 2 = 0 THEN ' - DPLA - ' || md5(o_orderkey::VARCHAR) ELSE '' END || CASE WHEN o_orderkey % 3 = 0 THEN ' (page ' || (o_orderkey % 40) || ')' ELSE '' END || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '.JPG' END AS title FROM orders)
SELECT id, nullif(regexp_extract(title, '- DPLA - ([0-9a-f]{32})', 1), '') AS item, nullif(regexp_extract(title, '\(page (\d+)\)(?:\.[^.]*)?$', 1), '')::INT AS page, CASE WHEN contains(title, '.') THEN lower(regexp_extract(title, '\.([^.]*)$', 1)) ELSE '' END AS ext FROM t"""
)
def title_parse(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    name = F.concat(
        F.lit("Scan"),
        F.when(key % 2 == 0, F.concat(F.lit(" - DPLA - "), F.md5(key.cast("string").cast("binary")))).otherwise(""),
        F.when(key % 3 == 0, F.concat(F.lit(" (page "), (key % 40).cast("string"), F.lit(")"))).otherwise(""),
        F.when(key % 5 == 0, "").otherwise(".JPG"),
    )
    titles = table(spark, d, "orders").select(key.alias("id"), name.alias("title"))
    return titles.select("id", text.id_in_title(F.col("title")).alias("item"), text.page_in_title(F.col("title")).alias("page"), text.extension(F.col("title")).alias("ext"))


_ESCAPED = _replaced_sql("x", tuple((token, "") for token in text.RESERVED_WIKITEXT))


@query(f"SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_ESCAPED}), '; ') AS joined FROM documents")
def wiki_escape_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.join_escaped(F.split("text", "\n")).alias("joined"))


@query("SELECT c_custkey AS id, regexp_replace(replace(lower(c_name || ' & ' || n_name), ' ', '-'), '[^a-z0-9-]', '', 'g') AS slug FROM customer JOIN nation ON c_nationkey = n_nationkey")
def slugify(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(F.col("c_custkey").alias("id"), text.slug(F.concat("c_name", F.lit(" & "), "n_name")).alias("slug"))


_VALUE = r"regexp_replace(regexp_replace(translate(text, chr(65279) || chr(8206) || chr(8207) || chr(65534) || chr(65535), ''), '[\x00-\x1F\x7F-\x{9F}]+', ' ', 'g'), '^[\s\x0B\x{A0}]+|[\s\x0B\x{A0}]+$', '', 'g')"


@query(f"SELECT doc_id, nfc_normalize({_VALUE}) AS value FROM documents")
def text_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.nfc(text.statement_value(F.col("text"))).alias("value"))


@query(
    rf"""WITH RECURSIVE v AS (SELECT doc_id AS id, {_VALUE} AS value FROM documents),
c(id, n, part, rest) AS (
  SELECT id, 0, NULL::VARCHAR, value FROM v
  UNION ALL
  SELECT id, n + 1, CASE WHEN len(rest) <= 1500 THEN rest ELSE substr(rest, 1, cut) END, CASE WHEN len(rest) <= 1500 THEN NULL ELSE substr(rest, cut + 1) END
  FROM (SELECT *, CASE WHEN regexp_matches(substr(rest, 1, 1501), '[^\s\x{{A0}}]{{2}}') THEN len(regexp_extract(substr(rest, 1, 1501), '^((?s:.*)[^\s\x{{A0}}])[^\s\x{{A0}}]', 1)) ELSE 1500 END AS cut FROM c WHERE rest IS NOT NULL))
SELECT id, 'P1476' AS prop, 0 AS pos, CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'A' END AS letter, n - 1 AS part, part AS value FROM c WHERE n > 0"""
)
def text_chunks(spark: SparkSession, d: str) -> DataFrame:
    values = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("P1476").alias("prop"), F.col("lang").alias("language"), F.lit(0).alias("pos"), text.statement_value(F.col("text")).alias("value"))
    return statements.long_values(values).drop("language")



def _folded_sql(expression: str) -> str:
    """As for comparing, where the text has no magic words and no letters that fold otherwise than to lower case, but ß."""
    ends = text.TRIMMED.replace("'", "''")
    return rf"regexp_replace(trim(replace(lower({expression}), 'ß', 'ss'), '{ends}'), '[\s\x0B\x{{85}}\x{{A0}}]+', ' ', 'g')"


@query(
    f"""WITH p AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM conversations),
l AS (SELECT *, list_filter(list_transform(string_split(text, '. '), lambda x: {_folded_sql('x')}), lambda x: x <> '') AS a,
  CASE WHEN contains(before, '. ') THEN list_filter(list_transform(string_split(before, '. '), lambda x: {_folded_sql('x')}), lambda x: x <> '') END AS b FROM p)
SELECT conv_id, turn, b IS NOT NULL AND a IS NOT NULL AND len(a) > 0 AND len(list_filter(a, lambda x: NOT list_contains(b, x))) = 0 AS subset FROM l"""
)
def value_subset(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = table(spark, d, "conversations").withColumn("before", before)
    return rows.select("conv_id", "turn", text.multi_value_subset(F.col("text"), F.col("before"), ". ").alias("subset"))


@query(f"SELECT doc_id, {_folded_sql('text')} AS folded FROM documents")
def fold_compare(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.folded(F.col("text")).alias("folded"))


@query(
    f"""WITH t AS (SELECT doc_id, {_CLEAN} AS t FROM documents)
SELECT doc_id AS id, ltrim(replace(lower(t), 'ß', 'ss'), ' "''(<[-_.') || chr(0) || doc_id AS sort_key FROM t"""
)
def title_order(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return selection.title_order(rows, "text").select("id", "sort_key")


@query(
    """WITH b AS (SELECT page_id, url AS u, CASE WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8) WHEN starts_with(url, 'https://') THEN 'http://' || substr(url, 9) END AS o FROM pages)
SELECT page_id, array_to_string([u, CASE WHEN suffix(u, '/') THEN regexp_replace(u, '/+$', '') ELSE u || '/' END, o, CASE WHEN suffix(o, '/') THEN regexp_replace(o, '/+$', '') ELSE o || '/' END], ' ') AS variants FROM b"""
)
def url_variants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.array_join(urls.variants(F.col("url")), " ").alias("variants"))


_TOKENS = r"list_filter(regexp_split_to_array(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*(?:\?[^#]*)?)', 1), '[^A-Za-z0-9_-]+'), lambda s: s <> '')"


@query(
    f"""WITH t AS (SELECT page_id, {_TOKENS} AS ts FROM pages),
b AS (SELECT page_id, (list_sort(list_transform(list_zip(ts, range(1, len(ts) + 1)), lambda z: {{'w': -(2 * len(z[1]) + regexp_matches(z[1], '[0-9]')::INT), 'i': z[2], 't': z[1]}})))[1].t AS best FROM t)
SELECT page_id, CASE WHEN len(best) >= 6 THEN best END AS token FROM b"""
)
def url_token(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.stable_token(F.col("url")).alias("token"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS authority FROM pages")
def url_authority(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.authority(F.col("url")).alias("authority"))


@query("SELECT page_id, regexp_replace(replace(url, 'https://', 'http://'), '/+$', '') AS uri FROM pages")
def rights_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.rights_key(F.col("url")).alias("uri"))


@query(
    """WITH o AS (SELECT o_orderkey AS id, o_orderkey % 10 AS k, year(o_orderdate) AS y, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y-%m-%d') AS ymd FROM orders)
SELECT id, CASE WHEN k IN (0, 1, 2, 3, 8) THEN '+' || ymd || 'T00:00:00Z' WHEN k IN (4, 5) THEN '+' || ym || '-01T00:00:00Z' WHEN k = 6 THEN '+' || (y // 10 * 10) || '-01-01T00:00:00Z' WHEN k = 7 THEN '+' || y || '-01-01T00:00:00Z' END AS time,
  CASE WHEN k IN (0, 1, 2, 3, 8) THEN 11 WHEN k IN (4, 5) THEN 10 WHEN k = 6 THEN 8 WHEN k = 7 THEN 9 END::INT AS precision, CASE WHEN k < 9 THEN k IN (7, 8) END AS approximate FROM o"""
)
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    day, key = F.col("o_orderdate"), F.col("o_orderkey") % 10
    form = lambda pattern: F.date_format(day, pattern)
    shown = (
        F.when(key == 0, form("yyyy-M-d"))
        .when(key == 1, form("M/d/yyyy"))
        .when(key == 2, form("MMMM d, yyyy"))
        .when(key == 3, form("d MMM. yyyy"))
        .when(key == 4, form("yyyy-MM"))
        .when(key == 5, form("MMM yyyy"))
        .when(key == 6, F.concat((F.floor(F.year(day) / 10) * 10).cast("string"), F.lit("s")))
        .when(key == 7, F.concat(F.lit("[circa "), form("yyyy"), F.lit("?]")))
        .when(key == 8, F.concat(F.lit("ca. "), form("yyyy-MM-dd")))
        .otherwise(F.concat(form("yyyy"), F.lit(" BC")))
    )
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), dates.partial_date(shown).alias("p")).select("id", "p.time", "p.precision", "p.approximate")


@query(
    """WITH o AS (SELECT o_orderkey AS id, o_orderkey % 5 AS k, year(o_orderdate) AS y, o_custkey % 30 AS n FROM orders)
SELECT id, CASE WHEN k < 4 THEN y - n END::INT AS first, CASE WHEN k < 4 THEN y END::INT AS last FROM o"""
)
def date_range(spark: SparkSession, d: str) -> DataFrame:
    key, y = F.col("o_orderkey") % 5, F.year("o_orderdate")
    a, b = y.cast("string"), (y - F.col("o_custkey") % 30).cast("string")
    shown = (
        F.when(key == 0, F.concat(a, F.lit("-"), b))
        .when(key == 1, F.concat(F.lit("between "), b, F.lit(" and "), a))
        .when(key == 2, F.concat(F.lit("from "), b, F.lit(" to "), a))
        .when(key == 3, F.concat(F.lit("{{other date|between|"), a, F.lit("|"), b, F.lit("}}")))
        .otherwise(F.concat(F.lit("about "), a))
    )
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), dates.year_range(shown).alias("r")).select("id", "r.first", "r.last")


@query("SELECT o_orderkey AS id, o_orderkey % 3 = 0 OR (o_orderkey % 3 = 1 AND day(o_orderdate) = 1) AS same FROM orders")
def date_equal(spark: SparkSession, d: str) -> DataFrame:
    day, key = F.col("o_orderdate"), F.col("o_orderkey") % 3
    first = F.date_format(day, "MMMM d, yyyy")
    other = F.when(key == 0, F.date_format(day, "M/d/yyyy")).when(key == 1, F.date_format(day, "yyyy-MM-01")).otherwise(F.concat(F.lit("circa "), F.date_format(day, "yyyy-MM-dd")))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), dates.same_date(first, other).alias("same"))
