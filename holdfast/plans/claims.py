"""Statements, migration plans, uploads and sessions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, rights, text, urls, wiki
from ..operators import claims, compare, migration, runlogs, selection, sessions, uploads
from ..operators import ordinals as media
from .registry import Registry
from .roles import INSTITUTIONS_SQL, LOG_SQL, ORDINALS_SQL, institutions, log, ordinals, table

CLAIMS = Registry()
query = CLAIMS.query

Q = F.col
_RIGHTS = (("http://r.org/F", "P275", "Q20007257"), ("http://r.org/O", "P6426", "Q47530911"), ("http://r.org/P", "P275", claims.MARK_ENTITY))


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Orders as items with everything that statements are made of; some titles are too long for one statement."""
    key, day = Q("o_orderkey"), Q("o_orderdate")
    long = F.repeat(F.concat(_s(key), F.lit("-")), 400)
    shown = F.when(key % 4 == 0, F.date_format(day, "yyyy-MM-dd")).when(key % 4 == 1, F.concat(F.lit("circa "), F.date_format(day, "yyyy"))).when(key % 4 == 2, F.lit("undated")).otherwise(F.lit(""))
    hub = F.concat(F.lit("Q"), F.when(key % 3 == 0, "518155").otherwise(_s(key % 9 + 1)))
    return table(spark, d, "orders").select(
        key.alias("id"),
        F.concat(F.lit("http://x.org/"), _s(key)).alias("url"),
        F.array(F.concat(F.lit(" Title "), _s(key)), F.when(key % 5 == 0, long).otherwise(""), F.when(key % 5 == 0, F.concat(F.lit("x"), long))).alias("titles"),
        F.array(Q("o_orderpriority")).alias("descriptions"),
        F.array(shown).alias("dates"),
        F.when(key % 2 == 0, F.array(F.concat(F.lit("Clerk "), _s("o_custkey")))).alias("creators"),
        F.when(key % 3 != 0, F.array(_s(key))).alias("identifiers"),
        F.array(F.struct(Q("o_orderstatus").alias("name"), F.when(key % 2 == 0, F.concat(F.lit("Q"), _s("o_custkey"))).otherwise("").alias("qid"))).alias("subjects"),
        hub.alias("hub_qid"),
        F.concat(F.lit("Q"), _s("o_custkey")).alias("inst_qid"),
        F.when(key % 7 == 0, "https://creativecommons.org/publicdomain/mark/1.0/").otherwise(F.concat(F.lit("https://r.org/"), Q("o_orderstatus"), F.lit("/"))).alias("rights_uri"),
        F.when(key % 2 == 0, F.concat(F.lit("http://x.org/"), _s(key), F.lit("/manifest"))).otherwise("null").alias("manifest"),
        F.when(key % 3 == 0, F.array(_s(key))).alias("numbers"),
        F.when(key % 3 == 0, "Q66739888").alias("access"),
        F.when(key % 3 == 0, "Q11723795").otherwise("").alias("level"),
        day.cast("date").alias("ingest_date"),
    )


def _rights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_RIGHTS, "uri string, prop string, qid string")


_LONG = "repeat(k || '-', 400)"
_STATEMENTS_SQL = f"""o AS (SELECT o_orderkey AS k, *, CASE WHEN o_orderkey % 3 = 0 THEN 'Q518155' ELSE 'Q' || (o_orderkey % 9 + 1) END AS hub, 'Q' || o_custkey AS inst FROM orders),
r AS (SELECT * FROM (VALUES {", ".join(repr(x) for x in _RIGHTS)}) v(uri, prop, qid)),
parts AS (SELECT k, v, n, substr(v, (n - 1) * 1500 + 1, 1500) AS value, len(v) > 1500 AS cut, letter FROM (
  SELECT k, v, letter, unnest(range(1, greatest((len(v) + 1499) // 1500, 1) + 1)) AS n FROM (
    SELECT k, 'Title ' || k AS v, '' AS letter FROM o UNION ALL SELECT k, {_LONG}, 'A' FROM o WHERE k % 5 = 0
    UNION ALL SELECT k, 'x' || {_LONG}, CASE WHEN len({_LONG}) > 1500 THEN 'B' ELSE 'A' END FROM o WHERE k % 5 = 0))),
s AS (
  SELECT k, CASE WHEN k % 7 = 0 THEN 'P6216' ELSE prop END AS prop, CASE WHEN k % 7 = 0 THEN 'Q19652' ELSE qid END AS value, '' AS q FROM o JOIN r ON uri = 'http://r.org/' || o_orderstatus
  UNION ALL SELECT k, 'P6216', CASE WHEN qid = 'Q6938433' THEN 'Q88088423' WHEN prop = 'P275' THEN 'Q50423863' ELSE 'Q19652' END, '' FROM o JOIN r ON uri = 'http://r.org/' || o_orderstatus WHERE k % 7 <> 0
  UNION ALL SELECT k, 'P760', k::VARCHAR, '' FROM o
  UNION ALL SELECT k, 'P1476', value, CASE WHEN cut THEN ' P1545=' || letter || n ELSE '' END FROM parts
  UNION ALL SELECT k, 'P195', CASE WHEN hub = 'Q518155' THEN hub ELSE inst END, '' FROM o
  UNION ALL SELECT k, 'P170', NULL, ' P2093=Clerk ' || o_custkey FROM o WHERE k % 2 = 0
  UNION ALL SELECT k, 'P571', CASE k % 4 WHEN 0 THEN '+' || strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' WHEN 1 THEN '+' || year(o_orderdate) || '-01-01T00:00:00Z' END,
    CASE k % 4 WHEN 0 THEN ' P1932=' || strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN ' P1480=Q5727902 P1932=circa ' || year(o_orderdate) ELSE ' P1932=undated' END FROM o WHERE k % 4 <> 3
  UNION ALL SELECT k, 'P4272', o_orderstatus, '' FROM o UNION ALL SELECT k, 'P921', 'Q' || o_custkey, '' FROM o WHERE k % 2 = 0
  UNION ALL SELECT k, 'P10358', o_orderpriority, '' FROM o
  UNION ALL SELECT k, 'P9126', 'Q2944483', ' P3831=Q393351' FROM o
  UNION ALL SELECT k, 'P9126', hub, CASE WHEN hub = 'Q518155' THEN ' P3831=Q108296843' ELSE ' P3831=Q393351' END FROM o
  UNION ALL SELECT k, 'P9126', inst, CASE WHEN hub = 'Q518155' THEN ' P3831=Q108296919' ELSE ' P3831=Q108296843' END FROM o
  UNION ALL SELECT k, 'P7482', 'Q74228490', ' P973=http://x.org/' || k || ' P137=' || hub || CASE WHEN k % 2 = 0 THEN ' P6108=http://x.org/' || k || '/manifest' ELSE '' END FROM o
  UNION ALL SELECT k, 'P217', k::VARCHAR, ' P195=' || inst FROM o WHERE k % 3 <> 0
  UNION ALL SELECT k, 'P1225', k::VARCHAR, '' FROM o WHERE k % 3 = 0
  UNION ALL SELECT k, 'P7228', 'Q66739888', '' FROM o WHERE k % 3 = 0
  UNION ALL SELECT k, 'P6224', 'Q11723795', '' FROM o WHERE k % 3 = 0)"""


def _shown(c: str = "qualifiers") -> Column:
    return F.array_join(F.transform(c, lambda q: F.concat(q["prop"], F.lit("="), q["value"])), " ")


@query(f"WITH {_STATEMENTS_SQL} SELECT k AS id, prop, value, 'P459=Q61848113' || q AS qualifiers, 'https://dp.la/item/' || k AS owner, o_orderdate::DATE AS retrieved FROM s JOIN o USING (k)")
def claims_all(spark: SparkSession, d: str) -> DataFrame:
    return claims.build(_items(spark, d), _rights(spark)).select("id", "prop", "value", _shown().alias("qualifiers"), "owner", "retrieved")


@query(
    f"""WITH {_STATEMENTS_SQL}, c AS (SELECT k, prop, CASE WHEN prop = 'P7482' THEN 'http://x.org/' || k WHEN prop = 'P170' THEN 'Clerk ' || o_custkey WHEN prop = 'P571' AND k % 4 = 2 THEN 'undated'
    WHEN prop = 'P571' THEN value || CASE WHEN k % 4 = 0 THEN '|P11' ELSE '|P9|circa' END WHEN prop IN ('P760', 'P1476', 'P4272', 'P10358', 'P217', 'P1225') THEN value || '#' || coalesce(nullif(regexp_extract(q, 'P1545=(\\S+)', 1), ''), '') ELSE value END AS key FROM s JOIN o USING (k))
SELECT k AS id, prop, count(*)::INT AS n, md5(array_to_string(list_sort(list(key)), ' ')) AS keys FROM c WHERE key IS NOT NULL GROUP BY 1, 2"""
)
def expected_values(spark: SparkSession, d: str) -> DataFrame:
    found = compare.expected_values(claims.build(_items(spark, d), _rights(spark)))
    return found.select("id", "prop", F.size("values").alias("n"), F.md5(F.array_join("values", " ").cast("binary")).alias("keys"))


# ---------------------------------------------------------------- statements of files

_DAY = "2024-05-01"


def _statements(spark: SparkSession, d: str) -> DataFrame:
    """Media as statements of their item's file: titles, numbers, dates and names, with references by supplier."""
    own = ordinals(spark, d)
    part, kind, owner = Q("part"), Q("part") % 4, Q("owner") % 6
    year = F.concat(F.lit("19"), F.lpad(_s(part % 30 + 10), 2, "0"))
    words = F.when(part % 3 == 0, F.concat(F.lit("circa "), year)).when(part % 3 == 1, F.concat(year, F.lit(" - 1999"))).otherwise(F.concat(F.lit("{{other date|between|"), year, F.lit("|1999}}")))
    is_time = (kind == 2) & (part % 5 == 0)
    reference = lambda publisher, url, day, basis: F.struct(F.lit(publisher).alias("publisher"), F.concat(F.lit("https://dp.la/item/"), url).alias("url"), F.lit(day).cast("date").alias("retrieved"), F.lit(basis).alias("basis")).cast(compare.REFERENCE)
    mine, stale, others, imported = reference(compare.SELF, _s("id"), _DAY, None), reference(compare.SELF, _s("id"), "2020-01-01", None), reference(compare.SELF, F.lit("other"), _DAY, None), reference(None, F.lit("x"), None, compare.IMPORTED)
    none = F.array().cast(f"array<{compare.REFERENCE}>")
    refs = F.when(owner == 0, none).when(owner == 1, F.array(mine)).when(owner == 2, F.array(stale, others)).when(owner == 3, F.array(imported)).when(owner == 4, F.array(mine, mine)).otherwise(F.array(others))
    qualifier = lambda p, v: F.when(v.isNotNull(), F.array(F.struct(F.lit(p).alias("prop"), v.alias("value")))).otherwise(F.array().cast("array<struct<prop:string,value:string>>"))
    value = F.when(kind == 0, F.concat(F.lit("Title "), _s(part % 3), F.when(Q("ordinal") % 2 == 0, ".").otherwise(""))).when(kind == 1, F.when(part % 7 == 0, "--").otherwise(F.concat(F.lit("No "), _s(part % 3)))).when(is_time, F.concat(F.lit("+"), year, F.lit("-01-01T00:00:00Z")))
    return own.select(
        Q("id").alias("entity"),
        F.concat_ws("$", "id", "ordinal").alias("stmt"),
        F.when(kind == 0, "P1476").when(kind == 1, "P217").when(kind == 2, "P571").otherwise("P170").alias("prop"),
        F.when(value.isNotNull(), "value").otherwise("somevalue").alias("kind"),
        F.when(kind == 0, "monolingualtext").when(kind == 1, "string").when(kind == 2, "time").otherwise("wikibase-item").alias("datatype"),
        value.alias("value"),
        F.when(kind == 0, "en").alias("language"),
        F.when(is_time, 9).alias("precision"),
        F.concat(qualifier("P1932", F.when((kind == 2) & ~is_time, words)), qualifier("P2093", F.when(kind == 3, F.concat(F.lit("Name "), _s(part % 3)))), qualifier("P1001", F.when(part % 11 == 0, "Q30"))).alias("qualifiers"),
        refs.alias("refs"),
    )


_FILES_SQL = f"""{ORDINALS_SQL}, raw AS (SELECT id AS entity, id || '$' || ordinal AS stmt, ordinal, part, part % 4 AS kind, owner % 6 AS o, '19' || lpad((part % 30 + 10)::VARCHAR, 2, '0') AS year, part % 4 = 2 AND part % 5 = 0 AS is_time FROM ordinals),
files AS (SELECT *, ['P1476', 'P217', 'P571', 'P170'][kind + 1] AS prop,
  CASE WHEN kind = 0 THEN 'Title ' || (part % 3) || CASE WHEN ordinal % 2 = 0 THEN '.' ELSE '' END WHEN kind = 1 THEN CASE WHEN part % 7 = 0 THEN '--' ELSE 'No ' || (part % 3) END WHEN is_time THEN '+' || year || '-01-01T00:00:00Z' END AS value,
  CASE WHEN kind = 2 AND NOT is_time THEN CASE part % 3 WHEN 0 THEN 'circa ' || year WHEN 1 THEN year || ' - 1999' ELSE '{{{{other date|between|' || year || '|1999}}}}' END END AS words FROM raw),
facts AS (SELECT *, CASE WHEN kind = 0 THEN 'monolingual:title ' || (part % 3) || ':en' WHEN kind = 1 AND part % 7 <> 0 THEN 'string:no ' || (part % 3) || ':' WHEN is_time THEN 'time:' || value || '|P9:'
  WHEN kind = 2 AND part % 3 = 0 THEN 'time:+' || year || '-01-01T00:00:00Z|P9|circa:' WHEN kind = 2 THEN 'date-range:' || year || ':1999' END AS fact FROM files)"""


@query(f"WITH {_FILES_SQL} SELECT stmt, fact FROM facts")
def fact_keys(spark: SparkSession, d: str) -> DataFrame:
    found = _statements(spark, d).select("stmt", compare.fact().alias("f"))
    return found.select("stmt", F.when(Q("f").isNotNull(), F.concat(Q("f.shape"), F.lit(":"), Q("f.first"), F.lit(":"), F.coalesce("f.second", F.lit("")))).alias("fact"))


@query(
    f"""WITH {_FILES_SQL}, k AS (SELECT *, CASE WHEN kind = 3 THEN 'Name ' || (part % 3) WHEN kind = 2 AND NOT is_time THEN words WHEN kind = 2 THEN value || '|P9' ELSE value || '#' END AS key, o IN (1, 2, 4, 5) AS own, part % 11 <> 0 AND o IN (0, 1, 2, 4, 5) AS amendable FROM files)
SELECT stmt, key, own, amendable FROM k"""
)
def comparable_keys(spark: SparkSession, d: str) -> DataFrame:
    return _statements(spark, d).select("stmt", compare.comparable().alias("key"), compare.has_own_reference().alias("own"), compare.amendable().alias("amendable"))


@query(f"WITH {_FILES_SQL} SELECT DISTINCT entity, stmt FROM facts f WHERE o = 3 AND EXISTS (SELECT 1 FROM facts g WHERE g.entity = f.entity AND g.prop = f.prop AND g.o IN (1, 2, 4, 5) AND g.fact = f.fact)")
def imported_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return compare.imported_duplicates(_statements(spark, d))


@query(f"WITH {_FILES_SQL} SELECT entity, stmt FROM files WHERE o = 3 AND value = '--'")
def imported_junk(spark: SparkSession, d: str) -> DataFrame:
    return compare.imported_junk(_statements(spark, d))


@query(f"WITH {_FILES_SQL} SELECT DISTINCT entity FROM files WHERE o IN (1, 2, 4, 5)")
def attributed_entities(spark: SparkSession, d: str) -> DataFrame:
    return compare.attributed_entities(_statements(spark, d))


@query(f"WITH {_FILES_SQL} SELECT DISTINCT entity FROM files WHERE o = 3 AND prop IN ('P1476', 'P571')")
def already_migrated(spark: SparkSession, d: str) -> DataFrame:
    return migration.already_migrated(_statements(spark, d))


def _of_item(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(Q("o_orderkey").alias("entity"), _s("o_orderkey").alias("item"), F.lit(_DAY).cast("date").alias("retrieved"))


_REFS = lambda refs: F.array_join(F.transform(refs, lambda r: F.concat_ws(" ", r["url"], _s(r["retrieved"]))), "; ")
_MINE = f"'https://dp.la/item/' || entity || ' {_DAY}'"
_OTHERS = f"'https://dp.la/item/other {_DAY}'"


@query(f"WITH {_FILES_SQL} SELECT stmt, {_MINE} AS refs FROM files WHERE o IN (2, 4, 5)")
def references_refreshed(spark: SparkSession, d: str) -> DataFrame:
    return compare.refreshed(_statements(spark, d), _of_item(spark, d)).select("stmt", _REFS("refs").alias("refs"))


@query(
    f"""WITH {_FILES_SQL}, said AS (SELECT *, kind = 0 OR (kind = 3 AND part % 3 = 0) AS said FROM files)
SELECT stmt, CASE WHEN said AND o = 0 THEN {_MINE} WHEN said AND o = 2 THEN {_MINE} || '; ' || {_OTHERS} WHEN said AND o = 3 THEN 'https://dp.la/item/x; ' || {_MINE} WHEN said AND o = 4 THEN {_MINE}
  WHEN said AND o = 5 THEN {_OTHERS} || '; ' || {_MINE} WHEN o = 2 THEN {_OTHERS} ELSE '' END AS refs FROM said WHERE (said AND o <> 1) OR (NOT said AND o IN (1, 2, 4))"""
)
def references_merged(spark: SparkSession, d: str) -> DataFrame:
    own = _statements(spark, d)
    expected = own.where("prop = 'P1476'").select("entity", "prop", compare.comparable().alias("key")).union(own.select("entity", F.lit("P170"), F.lit("Name 0"))).distinct()
    return compare.merged_references(own, _of_item(spark, d), expected).select("stmt", _REFS("refs").alias("refs"))


@query(f"WITH {ORDINALS_SQL} SELECT id AS entity, array_to_string(list_sort(list(DISTINCT (owner % 5)::VARCHAR)), ',') AS items, count(DISTINCT owner % 5) > 1 AS merged FROM ordinals GROUP BY id")
def contributing_items(spark: SparkSession, d: str) -> DataFrame:
    rows = ordinals(spark, d).select(Q("id").alias("entity"), F.lit(compare.ITEM_ID).alias("prop"), _s(Q("owner") % 5).alias("value"))
    return compare.contributors(rows).select("entity", F.array_join("items", ",").alias("items"), "merged")


@query(
    f"""WITH {ORDINALS_SQL}, x AS (SELECT id AS entity, id || '$' || ordinal AS stmt, part FROM ordinals), g AS (SELECT DISTINCT entity, stmt FROM x WHERE part % 5 = 0),
a AS (SELECT entity, list_sort(list(DISTINCT 'c' || part % 9)) AS l FROM x WHERE part % 3 = 0 GROUP BY 1), c AS (SELECT entity, list_sort(list(DISTINCT stmt)) AS l FROM x WHERE part % 2 = 0 AND part % 5 <> 0 GROUP BY 1), r AS (SELECT entity, list_sort(list(stmt)) AS l FROM g GROUP BY 1)
SELECT entity, coalesce(array_to_string(a.l, ','), '') AS added, coalesce(array_to_string(c.l, ','), '') AS changed, coalesce(array_to_string(r.l, ','), '') AS removed FROM a FULL JOIN c USING (entity) FULL JOIN r USING (entity)"""
)
def edits(spark: SparkSession, d: str) -> DataFrame:
    rows = ordinals(spark, d).select(Q("id").alias("entity"), F.concat_ws("$", "id", "ordinal").alias("stmt"), "part")
    made = compare.edits(rows.where("part % 3 = 0").select("entity", F.concat(F.lit("c"), _s(Q("part") % 9)).alias("claim")), rows.where("part % 2 = 0"), rows.where("part % 5 = 0"))
    return made.select("entity", *[F.array_join(a, ",").alias(b) for a, b in (("add", "added"), ("change", "changed"), ("remove", "removed"))])


@query(
    """WITH i AS (SELECT o_orderkey AS id, 0 AS pos, 'c' || o_custkey % 50 AS name, CASE WHEN o_orderkey % 2 = 0 THEN (o_custkey % 7)::VARCHAR END AS number FROM orders UNION ALL SELECT o_orderkey, 1, 'c' || o_custkey % 20, NULL FROM orders),
n AS (SELECT 'c' || c_custkey % 50 AS name, list_sort(list(DISTINCT 'Q' || c_nationkey % 3)) AS qids FROM customer WHERE c_custkey % 50 < 10 GROUP BY 1),
f AS (SELECT DISTINCT name, number, CASE WHEN number::INT % 2 = 0 THEN 'Q9' || number END AS one FROM i WHERE number IS NOT NULL),
x AS (SELECT id, pos, name, unnest(coalesce(qids, [coalesce(one, '')])) AS qid, qids IS NOT NULL AS named FROM i LEFT JOIN n USING (name) LEFT JOIN f USING (name, number)),
k AS (SELECT id, pos, name, qid FROM x WHERE NOT named UNION ALL SELECT id, min(pos), arg_min(name, pos), qid FROM x WHERE named GROUP BY id, qid)
SELECT * FROM k UNION ALL SELECT id, pos, name, '' FROM i WHERE (id, pos) NOT IN (SELECT (id, pos) FROM k)"""
)
def subject_resolution(spark: SparkSession, d: str) -> DataFrame:
    key, cust = Q("o_orderkey"), Q("o_custkey")
    name = lambda n: F.concat(F.lit("c"), _s(n))
    match = F.when(key % 2 == 0, F.array(F.concat(F.lit(claims.CATALOG_URL), _s(cust % 7))))
    subjects = F.array(F.struct(name(cust % 50).alias("name"), match.alias("exact_match")), F.struct(name(cust % 20).alias("name"), F.lit(None).cast("array<string>").alias("exact_match")))
    items = table(spark, d, "orders").select(key.alias("id"), subjects.alias("subjects"))
    known = table(spark, d, "customer").where("c_custkey % 50 < 10").select(name(Q("c_custkey") % 50).alias("name"), F.concat(F.lit("Q"), _s(Q("c_nationkey") % 3)).alias("qid"))
    queries = claims.subject_queries(items)
    answers = queries.withColumn("rank", F.lit(1)).withColumn("qid", F.when(Q("number").cast("int") % 2 == 0, F.concat(F.lit("Q9"), "number")).otherwise(""))
    return claims.resolve_subjects(items, known, claims.first_answers(queries, answers))


# ---------------------------------------------------------------- migration


def _parameters(spark: SparkSession, d: str) -> DataFrame:
    key = Q("o_orderkey")
    value = (
        F.when(key % 8 == 0, "Old Title.").when(key % 8 == 1, F.concat(F.lit("{{en|New "), _s("o_custkey"), F.lit("}}"))).when(key % 8 == 2, "old title\n----\nmore").when(key % 8 == 3, "two\nlines")
        .when(key % 8 == 4, "see [[other]]").when(key % 8 == 5, "{{DPLA|x=1}}").when(key % 8 == 6, "http://x.org/a").otherwise("part a")
    )
    name = F.when(key % 8 == 6, "source").when(key % 5 == 0, "institution").otherwise("title")
    canonical = F.when(key % 8 == 7, "Part A; part b").otherwise("Old title")
    return table(spark, d, "orders").select(key.alias("page"), name.alias("key"), value.alias("value"), canonical.alias("canonical"), F.when(key % 3 == 0, "bot").otherwise("community").alias("by"))


_PLAN_SQL = """p AS (SELECT o_orderkey AS page, o_orderkey % 8 AS m, CASE WHEN o_orderkey % 8 = 6 THEN 'source' WHEN o_orderkey % 5 = 0 THEN 'institution' ELSE 'title' END AS key, o_orderkey % 3 = 0 AS bot, o_custkey FROM orders),
a AS (SELECT *, CASE WHEN m IN (5, 6) THEN 'drop' WHEN bot OR (m IN (0, 7) AND key = 'title') THEN 'originated' WHEN m = 2 THEN 'extend' WHEN key = 'institution' OR m IN (3, 4) THEN 'preserve' ELSE 'import' END AS action,
  CASE m WHEN 0 THEN 'Old Title.' WHEN 1 THEN '{{en|New ' || o_custkey || '}}' WHEN 2 THEN 'old title' || chr(10) || '----' || chr(10) || 'more' WHEN 3 THEN 'two' || chr(10) || 'lines' WHEN 4 THEN 'see [[other]]' WHEN 5 THEN '{{DPLA|x=1}}' WHEN 6 THEN 'http://x.org/a' ELSE 'part a' END AS value FROM p)"""


@query(f"WITH {_PLAN_SQL} SELECT page, key, action, CASE WHEN action = 'extend' THEN substr(value, 10) ELSE value END AS content FROM a")
def migration_plan(spark: SparkSession, d: str) -> DataFrame:
    return migration.plan(_parameters(spark, d))


@query(f"WITH {_PLAN_SQL} SELECT page, 'P1476' AS prop, 'value' AS kind, 'New ' || o_custkey AS value, 'en' AS language FROM a WHERE action = 'import' AND o_custkey % 4 <> 0 UNION ALL SELECT o_orderkey, 'P6802', 'value', 'F' || o_custkey % 10, NULL FROM orders WHERE o_orderkey % 6 = 0 AND o_custkey % 10 < 5")
def migration_imports(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    related = orders.where("o_orderkey % 6 = 0").select(Q("o_orderkey").alias("page"), F.concat(F.lit("F"), _s(Q("o_custkey") % 10)).alias("file"))
    there = related.where(F.substring("file", 2, 1).cast("int") < 5).select(Q("file").alias("title")).distinct()
    nobody = related.limit(0).select(Q("file").alias("title"), Q("file").alias("qid"))
    existing = orders.where("o_custkey % 4 = 0").select(Q("o_orderkey").alias("page"), F.lit("P1476").alias("prop"), F.concat(F.lit("New "), _s("o_custkey")).alias("value"))
    made = migration.materialize(migration.build_imports(migration.plan(_parameters(spark, d)), related), nobody, there, existing)
    return made.select("page", "prop", "kind", "value", "language")


@query(
    f"""WITH {_PLAN_SQL} SELECT page, key = 'title' AND m = 0 OR m = 7 AND false OR m = 1 AND o_custkey % 2 = 0 AS same FROM a"""
)
def value_matches(spark: SparkSession, d: str) -> DataFrame:
    rows = _parameters(spark, d).join(table(spark, d, "orders").select(Q("o_orderkey").alias("page"), "o_custkey"), "page")
    expected = F.when(Q("page") % 8 == 1, F.concat(F.lit("New "), _s(Q("o_custkey") + Q("o_custkey") % 2))).otherwise(Q("canonical"))
    return rows.select("page", migration.value_matches(Q("value"), expected, F.array(F.lit("en")), Q("key")).alias("same"))


@query(
    """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'qid:Q' || o_custkey WHEN 1 THEN 'page:Ann ' || o_custkey WHEN 2 THEN 'unknown:author' WHEN 3 THEN NULL WHEN 4 THEN 'text:Plain, ' || o_custkey ELSE 'text:{{Creator:A}} and {{unknown}}' END AS shape,
  CASE o_orderkey % 6 WHEN 1 THEN 'page:Ann ' || o_custkey WHEN 2 THEN 'unknown:author' WHEN 5 THEN 'page:A; unknown:' ELSE '' END AS parts FROM orders"""
)
def creator_shapes(spark: SparkSession, d: str) -> DataFrame:
    key, cust = Q("o_orderkey") % 6, _s("o_custkey")
    value = (
        F.when(key == 0, F.concat(F.lit("{{creator|Wikidata=Q"), cust, F.lit("}}"))).when(key == 1, F.concat(F.lit("{{Creator:Ann "), cust, F.lit("}}"))).when(key == 2, "{{Unknown|author}}")
        .when(key == 3, "{{NARA-Author|x}}").when(key == 4, F.concat(F.lit("Plain, "), cust)).otherwise("{{Creator:A}} and {{unknown}}")
    )
    pair = lambda s: F.concat(s["kind"], F.lit(":"), s["value"])
    return table(spark, d, "orders").select(Q("o_orderkey").alias("id"), pair(migration.creator_shape(value)).alias("shape"), F.array_join(F.transform(migration.embedded_creators(value)["parts"], pair), "; ").alias("parts"))


# ---------------------------------------------------------------- pages and URLs


@query(
    r"""WITH i AS (SELECT o_orderkey AS id, o_orderkey % 6 AS m, 'id' || o_orderkey AS x FROM orders)
SELECT id, CASE m WHEN 0 THEN 'https://h.org/' || x WHEN 1 THEN 'https://h.org/iiif/' || x WHEN 2 THEN 'http://h.org/a/iiif/' || x WHEN 3 THEN 'http://h.org/iiif/a/' || x || '/c' WHEN 4 THEN 'http://h.org/a/b/iiif/' || x END || '/full/max/0/default.jpg' AS image FROM i"""
)
def image_urls(spark: SparkSession, d: str) -> DataFrame:
    key, x = Q("o_orderkey") % 6, F.concat(F.lit("id"), _s("o_orderkey"))
    url = (
        F.when(key == 0, F.concat(F.lit("https://h.org/"), x)).when(key == 1, F.concat(F.lit("https://h.org/iiif/"), x, F.lit("/full/200,/0/native.jpg"))).when(key == 2, F.concat(F.lit("http://h.org/a/iiif/"), x, F.lit("/")))
        .when(key == 3, F.concat(F.lit("http://h.org/iiif/a/"), x, F.lit("/c"))).when(key == 4, F.concat(F.lit("http://h.org/a/b/iiif/"), x, F.lit("/0,0,5,5/max/0/default.png"))).otherwise(F.concat(F.lit("http://h.org/a/b/"), x))
    )
    return table(spark, d, "orders").select(Q("o_orderkey").alias("id"), urls.full_size_image(url).alias("image"))


@query(
    """WITH p AS (SELECT o_orderkey AS id, o_custkey, o_orderkey % 4 AS m FROM orders)
SELECT id, CASE m WHEN 0 THEN 'NoC-US | Q' || o_custkey WHEN 1 THEN 'Cc-by-sa-4.0' WHEN 2 THEN 'cc-zero' ELSE '' END AS permission FROM p"""
)
def rights_templates(spark: SparkSession, d: str) -> DataFrame:
    key = Q("o_orderkey") % 4
    uri = F.when(key == 0, "http://rightsstatements.org/vocab/NoC-US/1.0/").when(key == 1, "http://creativecommons.org/licenses/by-sa/4.0/").when(key == 2, "http://creativecommons.org/publicdomain/zero/1.0/").otherwise("http://x.org")
    return table(spark, d, "orders").select(Q("o_orderkey").alias("id"), rights.permission(uri, rights.permission_template(uri), F.concat(F.lit("Q"), _s("o_custkey"))).alias("permission"))


@query(
    """SELECT doc_id AS id, '== {{int:filedesc}} ==' || chr(10) || chr(10) || '{{DPLA metadata' || CASE WHEN doc_id % 2 = 0 THEN chr(10) || '| creator = ' || source ELSE '' END || chr(10) || '| title = ' || doc_id || chr(10) || '| description = ' || lang
  || chr(10) || '| date = ' || chr(10) || '| permission = {{cc-zero}}' || chr(10) || '| hub = Q1' || chr(10) || '| institution = Q2' || chr(10) || '| url = http://x.org/' || doc_id || chr(10) || '| dpla_id = ' || md5(doc_id::VARCHAR) || chr(10) || '| local_id = ' || chr(10) || '}}' AS page FROM documents"""
)
def metadata_pages(spark: SparkSession, d: str) -> DataFrame:
    key = Q("doc_id")
    values = {
        "creator": F.when(key % 2 == 0, Q("source")), "title": _s(key), "description": Q("lang"), "date": F.lit(None).cast("string"), "permission": F.lit("{{cc-zero}}"), "hub": F.lit("Q1"), "institution": F.lit("Q2"),
        "url": F.concat(F.lit("http://x.org/"), _s(key)), "dpla_id": F.md5(_s(key).cast("binary")), "local_id": F.lit(""),
    }
    return table(spark, d, "documents").select(key.alias("id"), wiki.metadata_page(values).alias("page"))


@query(
    """SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'circa ' || year(o_orderdate) WHEN 1 THEN year(o_orderdate) || '?' WHEN 2 THEN (year(o_orderdate) // 10 * 10) || 's' WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'x' END AS shown FROM orders"""
)
def date_templates(spark: SparkSession, d: str) -> DataFrame:
    key, year = Q("o_orderkey") % 5, _s(F.year("o_orderdate"))
    value = (
        F.when(key == 0, F.concat(F.lit("{{other date|ca.|"), year, F.lit("}}"))).when(key == 1, F.concat(F.lit("{{Other_date | ? | "), year, F.lit("}}"))).when(key == 2, F.concat(F.lit("{{other date|decade|"), _s(F.floor(F.year("o_orderdate") / 10) * 10), F.lit("}}")))
        .when(key == 3, F.concat(F.lit("{{Taken on|"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("|location=x}}"))).otherwise("x")
    )
    return table(spark, d, "orders").select(Q("o_orderkey").alias("id"), dates.plain_date(value).alias("shown"))


# ---------------------------------------------------------------- uploads


@query(
    f"""WITH {ORDINALS_SQL}, f AS (SELECT id, ordinal::INT AS ordinal, part, part % 9 AS m FROM ordinals)
SELECT id, ordinal, CASE WHEN part % 11 = 0 THEN 'NOT_PRESENT' WHEN m IN (0, 1, 2) THEN 'INELIGIBLE' WHEN m = 3 THEN 'SKIPPED' WHEN m = 4 THEN 'HAND_FIX' WHEN m = 5 THEN 'MERGED' WHEN m = 6 THEN 'MOVED' WHEN m = 7 THEN 'FAILED' ELSE 'UPLOADED' END AS verdict FROM f"""
)
def upload_verdicts(spark: SparkSession, d: str) -> DataFrame:
    m = Q("part") % 9
    intended = F.concat(F.lit("T - DPLA - "), _s("id"))
    other = F.concat(intended, F.lit(" (page 2)"))
    facts = ordinals(spark, d).select(
        "id", "ordinal", F.when(Q("part") % 11 == 0, F.when(Q("part") % 2 == 0, 0)).otherwise(5).alias("size"),
        F.when(m == 0, "text/html").when(m == 1, "video/mp4").when(m == 2, "application/octet-stream").when(m == 8, "binary/octet-stream").otherwise("image/jpeg").alias("content_type"),
        F.when(m == 8, "image/png").otherwise("application/octet-stream").alias("detected"), F.lit(".jpg").alias("extension"), intended.alias("intended"), "sha1",
        F.when(m == 3, intended).when(m == 4, "A holiday.jpg").when(m.isin(5, 6), other).alias("found_title"), F.lit("Someone").alias("found_uploader"),
        F.when(m == 5, F.array("sha1")).alias("duplicates"), F.array(other).alias("expected"), F.lit("MOVED").alias("drift"), (m == 7).alias("failed"),
    )
    return uploads.upload_verdict(facts, ("DPLA_bot",))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'unstaged' WHEN o_orderkey % 3 = 0 THEN 'media' WHEN o_orderkey % 3 = 1 AND o_custkey % 4 IN (1, 2) THEN 'cached' WHEN o_orderkey % 3 = 1 THEN 'manifest' ELSE 'none' END AS source FROM orders")
def media_sources(spark: SparkSession, d: str) -> DataFrame:
    key, cust = Q("o_orderkey"), Q("o_custkey")
    items = table(spark, d, "orders").select(
        key.alias("id"), (key % 7 != 0).alias("staged"), F.when(key % 3 == 0, F.array(F.lit("u"))).alias("media"), F.when(key % 3 != 2, "m").alias("manifest"), F.when(cust % 4 != 0, F.array(F.lit("u"))).alias("cached"), (cust % 4 * 10).alias("cached_age")
    )
    return uploads.media_source(items, max_age=30)


@query(
    f"""WITH {INSTITUTIONS_SQL}, i AS (SELECT o_orderkey AS id, o_orderstatus = 'F' AS rights_ok, o_orderkey % 4 <> 0 AS asset_ok, hub_qid, inst_qid, hub_upload, inst_upload FROM orders JOIN institutions ON inst = 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0')),
b AS (SELECT DISTINCT doc_id AS id FROM labels WHERE toxic = 1), c AS (SELECT i.id, rights_ok, asset_ok, hub_upload OR inst_upload AS provider_ok, b.id IS NULL AS id_ok, inst_qid IS NOT NULL AS entities_ok FROM i LEFT JOIN b USING (id))
SELECT *, rights_ok AND asset_ok AND provider_ok AND id_ok AND entities_ok AS eligible FROM c"""
)
def wiki_eligibility(spark: SparkSession, d: str) -> DataFrame:
    key = Q("o_orderkey")
    own = table(spark, d, "orders").join(institutions(spark, d), F.concat(F.lit("Customer#"), F.lpad(_s("o_custkey"), 9, "0")) == Q("inst"))
    items = own.select(
        key.alias("id"), F.when(Q("o_orderstatus") == "F", "Unlimited Re-Use").alias("rights"), F.when(key % 4 == 1, F.array(F.lit("u"))).otherwise(F.array().cast("array<string>")).alias("media"), F.when(key % 4 == 2, "m").otherwise("").alias("manifest"),
        F.when(key % 4 == 3, "m").alias("derived_manifest"), "hub_qid", "inst_qid", "hub_upload", "inst_upload",
    )
    return uploads.wiki_eligibility(items, table(spark, d, "labels").where("toxic = 1").select(Q("doc_id").alias("id")))


@query(
    """WITH o AS (SELECT o_orderkey AS id, 'T' || ' - DPLA - ' || md5(o_orderkey::VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN ' (page ' || o_orderkey % 30 || ')' ELSE '' END || '.jpg' AS a,
  'T' || ' - DPLA - ' || md5(CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderkey::VARCHAR END) || CASE WHEN o_orderkey % 5 <> 0 THEN ' (page ' || o_orderkey % 40 || ')' ELSE '' END || '.jpg' AS b, o_orderkey % 2 = 0 AS p, o_orderkey % 30 AS x, o_orderkey % 40 AS y FROM orders)
SELECT id, p AND id % 3 <> 0 AND id % 5 <> 0 AND x <> y AS relic, id % 4 <> 0 AND id % 3 <> 0 AS community FROM o"""
)
def title_relics(spark: SparkSession, d: str) -> DataFrame:
    key = Q("o_orderkey")
    page = lambda n: F.concat(F.lit(" (page "), _s(n), F.lit(")"))
    build = lambda ident, number: F.concat(F.lit("T - DPLA - "), F.md5(ident.cast("binary")), number, F.lit(".jpg"))
    a = build(_s(key), F.when(key % 2 == 0, page(key % 30)).otherwise(""))
    b = build(F.when(key % 3 == 0, "x").otherwise(_s(key)), F.when(key % 5 != 0, page(key % 40)).otherwise(""))
    relic = uploads.is_same_item_relic(a, b, F.md5(_s(key).cast("binary")))
    community = uploads.is_community_file(F.when(key % 4 == 0, "X - NARA - 5.jpg").otherwise("X.jpg"), F.when(key % 3 == 0, "dpla_Bot").when(key % 3 == 1, "Someone"), ("DPLA bot",))
    return table(spark, d, "orders").select(key.alias("id"), relic.alias("relic"), community.alias("community"))


@query(
    f"""WITH {ORDINALS_SQL}, o AS (SELECT id, ordinal::INT AS ordinal, part FROM ordinals)
SELECT id, ordinal, CASE WHEN part % 4 = 3 THEN -part ELSE part END AS pageid, CASE WHEN part % 5 <> 0 THEN 'u' || part END AS url FROM o WHERE id % 3 <> 0 AND (part % 4 <> 3 OR part % 2 = 1)"""
)
def synced_ordinals(spark: SparkSession, d: str) -> DataFrame:
    own = ordinals(spark, d).select("id", "ordinal", "part")
    results = own.select("id", "ordinal", F.when(Q("part") % 4 == 3, "FAILED").otherwise("UPLOADED").alias("status"), F.when(Q("part") % 4 != 3, Q("part")).alias("pageid"))
    files = own.where("part % 5 <> 0").select("id", "ordinal", F.concat(F.lit("u"), _s("part")).alias("url"))
    rescued = own.where("part % 2 = 1").select("id", "ordinal", (-Q("part")).alias("pageid"))
    return uploads.synced_ordinals(own.where("id % 3 <> 0").select("id"), results, files, rescued)


# ---------------------------------------------------------------- sessions and logs


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    """Nations as sessions, customers' segments as their labels in order."""
    rows = table(spark, d, "customer").select(Q("c_nationkey").alias("session"), F.concat(F.lit("h"), _s(Q("c_nationkey") % 5), F.lit("+"), text.slug(Q("c_mktsegment"))).alias("label")).distinct()
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy("session").orderBy("label")))


_SESSIONS_SQL = "sessions AS (SELECT session, label, row_number() OVER (PARTITION BY session ORDER BY label) AS pos FROM (SELECT DISTINCT c_nationkey AS session, 'h' || c_nationkey % 5 || '+' || lower(c_mktsegment) AS label FROM customer))"


@query(
    f"""WITH {_SESSIONS_SQL}, l AS (SELECT session, label, pos, session * 10 AS created, pos * 7 + session * 9 AS written FROM sessions WHERE session % 4 <> 0),
a AS (SELECT session, arg_max(label, (written, label)) AS active FROM l WHERE written >= created AND pos <= 3 GROUP BY 1), st AS (SELECT session, min(pos) AS start FROM sessions JOIN a USING (session) WHERE label = active GROUP BY 1)
SELECT session, pos::INT AS pos, label FROM sessions LEFT JOIN st USING (session) WHERE pos >= coalesce(start, pos)"""
)
def open_labels(spark: SparkSession, d: str) -> DataFrame:
    own = _sessions(spark, d).withColumn("created", Q("session") * 10)
    logs = own.where("session % 4 <> 0 and pos <= 3").select(F.concat_ws("@", "session", "label").alias("label"), (Q("pos") * 7 + Q("session") * 9).alias("written"))
    keyed = own.withColumn("label", F.concat_ws("@", "session", "label"))
    active = sessions.active_labels(keyed, logs).withColumn("active", F.substring_index("active", "@", -1))
    return sessions.open_labels(own, active).select("session", "pos", "label")


@query(
    f"""WITH {_SESSIONS_SQL}, q AS (SELECT c_custkey AS request, 'h' || c_nationkey % 5 AS hub, CASE WHEN c_custkey % 4 > 0 THEN lower(c_mktsegment) END AS inst, c_custkey % 4 AS m FROM customer WHERE c_custkey % 10 = 0 OR c_custkey < 50),
w AS (SELECT *, hub || coalesce('+' || inst, '') || CASE m WHEN 2 THEN '+c' WHEN 3 THEN '+i' ELSE '' END AS label FROM q)
SELECT DISTINCT request, session FROM w JOIN sessions s ON s.label LIKE w.hub || '+%' WHERE m = 0 OR s.label = w.label OR (m = 2 AND s.label = hub || '+' || inst) OR (m = 1 AND starts_with(s.label, w.label || '+'))"""
)
def session_conflicts(spark: SparkSession, d: str) -> DataFrame:
    m = Q("c_custkey") % 4
    inst = F.when(m > 0, text.slug(Q("c_mktsegment")))
    hub = F.concat(F.lit("h"), _s(Q("c_nationkey") % 5))
    tail = F.when(m == 2, "c").when(m == 3, "i")
    requests = table(spark, d, "customer").where("c_custkey % 10 = 0 or c_custkey < 50").select(
        Q("c_custkey").alias("request"), hub.alias("hub"), F.when(m.isin(1, 2), inst).alias("institution"), F.when(m == 3, "i").alias("item"), F.when(m == 2, "c").alias("collection"), F.concat_ws("+", hub, inst, tail).alias("label")
    )
    return sessions.conflicts(requests, _sessions(spark, d))


@query(
    f"""WITH {_SESSIONS_SQL}, g AS (SELECT DISTINCT ['h' || c_nationkey % 5, lower(c_mktsegment)] AS parts FROM customer WHERE c_custkey % 3 = 0)
SELECT DISTINCT session FROM sessions, g WHERE list_has_all(string_split(label, '+'), parts) AND session % 2 = 0"""
)
def sessions_to_stop(spark: SparkSession, d: str) -> DataFrame:
    tokens = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.concat(F.lit(" h"), _s(Q("c_nationkey") % 5), F.lit(" | "), "c_mktsegment").alias("token")).distinct()
    slugs = table(spark, d, "nation").select(F.concat(F.lit("h"), _s(Q("n_nationkey") % 5)).alias("name")).distinct().withColumn("slug", Q("name"))
    nothing = slugs.limit(0).select(Q("name").alias("qid"), Q("name").alias("hub"), Q("name").alias("inst"))
    return sessions.sessions_to_stop(sessions.target_groups(tokens, slugs, nothing), _sessions(spark, d).where("session % 2 = 0"))


@query(
    """WITH s AS (SELECT c_custkey % 50 AS slot, min(CASE WHEN c_custkey % 3 = 0 THEN 'l' || c_custkey % 7 END) AS label FROM customer GROUP BY 1), h AS (SELECT label, count(*) AS n FROM s WHERE label IS NOT NULL GROUP BY 1),
r AS (SELECT DISTINCT 'l' || c_custkey % 9 AS label, 'l' || c_custkey % 9 || CASE WHEN c_custkey % 2 = 0 THEN ' [1/3]' ELSE '' END AS display, CASE c_custkey % 3 WHEN 0 THEN 'Uploading (x)' WHEN 1 THEN 'SDC syncing (queued) ⏸ waiting on slots' ELSE 'Downloading' END AS phase FROM customer)
SELECT display, phase, CASE WHEN phase = 'Downloading' THEN '' WHEN n > 0 THEN ' [Slots: ' || n || ']' WHEN contains(phase, 'waiting on slots') THEN '' ELSE ' [Awaiting slot]' END AS suffix FROM r LEFT JOIN h USING (label)"""
)
def slot_suffixes(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "customer")
    key = Q("c_custkey")
    slots = own.groupBy((key % 50).alias("slot")).agg(F.min(F.when(key % 3 == 0, F.concat(F.lit("l"), _s(key % 7)))).alias("label"))
    rows = own.select(F.concat(F.lit("l"), _s(key % 9), F.when(key % 2 == 0, " [1/3]").otherwise("")).alias("display"), F.when(key % 3 == 0, "Uploading (x)").when(key % 3 == 1, "SDC syncing (queued) ⏸ waiting on slots").otherwise("Downloading").alias("phase")).distinct()
    return sessions.slot_suffixes(rows, slots)


@query(
    """WITH p AS (SELECT c_custkey AS label, c_custkey % 3 AS m, c_custkey % 5 AS items, c_custkey % 2 AS done, c_custkey % 7 = 0 AS waiting, 4 AS total FROM customer), x AS (SELECT *, format('{:d} / 4 items, ~{:.1f}%', items, items / 4.0 * 100) AS of_items,
  CASE WHEN waiting THEN ' ⏸ waiting on slots' ELSE '' END AS slot, CASE WHEN done = 0 AND NOT waiting AND label % 4 = 0 THEN ' ⚠ idle 1h05m' ELSE '' END AS idle FROM p)
SELECT label, CASE WHEN m = 0 AND done > 0 THEN 'Download complete (' || items || ' / 4 items)' WHEN m = 0 THEN 'Stalled (' || of_items || ')' || idle
  WHEN items = 0 THEN CASE m WHEN 1 THEN 'Uploading (' ELSE 'SDC syncing (' END || CASE WHEN waiting THEN 'queued' ELSE 'starting...' END || ')' || slot
  WHEN m = 1 AND done > 0 THEN 'Upload complete (2 uploaded, 1 already on Commons, 0 merged, 0 hand-fix)' WHEN m = 1 THEN 'Uploading (' || of_items || ')' || slot || idle
  WHEN done > 0 THEN 'SDC complete (' || items || ' items processed)' ELSE 'SDC syncing (' || of_items || ')' || slot || idle END AS line FROM x"""
)
def session_progress(spark: SparkSession, d: str) -> DataFrame:
    key = Q("c_custkey")
    zero = F.lit(None).cast("bigint")
    rows = table(spark, d, "customer").select(
        key.alias("label"), F.when(key % 3 == 0, "download").when(key % 3 == 1, "upload").otherwise("sync").alias("phase"), (key % 5).alias("items"), F.lit(4).alias("total"), F.lit(2).alias("uploaded"), F.lit(1).alias("skipped"),
        *[zero.alias(c) for c in ("merged", "hand_fix", "ordinals", "total_ordinals", "maintain_total")], (key % 2).alias("done"), F.lit(None).cast("boolean").alias("active"), (key % 7 == 0).alias("waiting"),
        F.lit(10_000).alias("now"), F.when(key % 4 == 0, 10_000 - 3900).otherwise(9_000).alias("written"),
    )
    return sessions.progress(rows).select("label", "line")


@query(
    f"""WITH {LOG_SQL}, b AS (SELECT *, sum((event_type = 'signup')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS block FROM log),
f AS (SELECT user_id, block, arg_min(k, (ts, event_id)) AS k FROM b WHERE event_type = 'error' AND block > 0 GROUP BY 1, 2),
i AS (SELECT user_id, block, any_value(k) AS id FROM b WHERE event_type = 'signup' GROUP BY 1, 2)
SELECT DISTINCT user_id AS file, md5(id::VARCHAR) AS id FROM f JOIN i USING (user_id, block) WHERE f.k % 2 = 0"""
)
def failed_downloads(spark: SparkSession, d: str) -> DataFrame:
    kind, k = Q("event_type"), Q("k")
    line = F.when(kind == "signup", F.concat(F.lit("Failed: "), F.md5(_s(k).cast("binary")))).when(kind == "error", F.when(k % 2 == 0, "Failed downloading http://x to y").otherwise("Failed downloading  to y")).otherwise(kind)
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return runlogs.failed_downloads(log(spark, d).select(Q("user_id").alias("file"), number.alias("line_no"), line.alias("text")))


@query(f"WITH {ORDINALS_SQL} SELECT id, reason, array_to_string(list_sort(list(ordinal)), ',') AS ordinals FROM (SELECT id, ordinal, CASE WHEN size % 4 = 0 THEN 'empty' WHEN part % 3 = 0 THEN 'bad type' ELSE '' END AS reason FROM ordinals) WHERE reason <> '' GROUP BY 1, 2")
def skips_by_reason(spark: SparkSession, d: str) -> DataFrame:
    reason = media.skip_reason(F.when(Q("size") % 4 == 0, 0).otherwise(Q("size")), F.when(Q("part") % 3 == 0, "text/html").otherwise("image/jpeg"))
    return runlogs.skips_by_reason(ordinals(spark, d).select("id", "ordinal", reason.alias("reason"))).select("id", "reason", F.array_join("ordinals", ",").alias("ordinals"))


@query(f"WITH {LOG_SQL} SELECT string_agg(event_type || ': ' || n, chr(10) ORDER BY event_type) AS block FROM (SELECT event_type, count(*) AS n FROM log WHERE event_type <> 'click' GROUP BY 1)")
def counter_block(spark: SparkSession, d: str) -> DataFrame:
    counts = runlogs.counters(log(spark, d), "event_type")
    halves = [counts.where("result <> 'click'"), counts.select("result", F.lit(0).cast("bigint").alias("n"))]
    return runlogs.printed(runlogs.merge_counters(halves).where("result <> 'click'"))


@query(f"WITH {INSTITUTIONS_SQL} SELECT DISTINCT hub, inst, inst_qid FROM institutions WHERE inst_qid IS NOT NULL AND inst_qid NOT IN (SELECT 'Q' || o_custkey FROM orders)")
def missing_categories(spark: SparkSession, d: str) -> DataFrame:
    return selection.missing_categories(institutions(spark, d), table(spark, d, "orders").select(F.concat(F.lit("Q"), _s("o_custkey")).alias("qid")))


@query(
    f"""WITH {INSTITUTIONS_SQL}, t AS (SELECT DISTINCT n_name AS hub, CASE WHEN c_custkey % 3 > 0 THEN c_name || CASE WHEN c_custkey % 7 = 0 THEN '?' ELSE '' END END AS inst FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT t.hub, t.inst, CASE WHEN t.inst IS NULL THEN (SELECT max(hub_qid) FROM institutions i WHERE i.hub = t.hub) ELSE (SELECT max(inst_qid) FROM institutions i WHERE i.hub = t.hub AND i.inst = t.inst) END AS qid FROM t"""
)
def target_entities(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "customer").join(table(spark, d, "nation"), Q("c_nationkey") == Q("n_nationkey"))
    name = F.when(Q("c_custkey") % 3 > 0, F.concat("c_name", F.when(Q("c_custkey") % 7 == 0, "?").otherwise("")))
    return selection.entity_of_target(institutions(spark, d), joined.select(Q("n_name").alias("hub"), name.alias("inst")).distinct())


@query(f"WITH {INSTITUTIONS_SQL} SELECT qid, arg_min(name, (r, name)) AS name FROM (SELECT hub_qid AS qid, 0 AS r, hub AS name FROM institutions UNION ALL SELECT inst_qid, 1, inst FROM institutions) WHERE qid IS NOT NULL GROUP BY qid")
def entity_names(spark: SparkSession, d: str) -> DataFrame:
    return selection.names_of_entities(institutions(spark, d))


@query(
    """WITH w AS (SELECT DISTINCT CASE WHEN n_nationkey % 4 = 0 THEN 'no ' || n_name ELSE n_name END AS partner, n_nationkey FROM nation), h AS (SELECT n_name AS slug, n_nationkey % 3 = 0 AS eligible FROM nation)
SELECT partner, CASE WHEN eligible IS NULL THEN 'unknown' WHEN eligible THEN 'ok' ELSE 'no upload' END AS status FROM w LEFT JOIN h ON partner = slug"""
)
def partner_status(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    wanted = nation.select(F.when(Q("n_nationkey") % 4 == 0, F.concat(F.lit("no "), "n_name")).otherwise(Q("n_name")).alias("partner")).distinct()
    return uploads.partner_check(wanted, nation.select(Q("n_name").alias("slug"), (Q("n_nationkey") % 3 == 0).alias("eligible")))


@query(
    """WITH c AS (SELECT p_type AS term, count(DISTINCT p_partkey) AS count FROM part GROUP BY 1) SELECT term, count, (row_number() OVER (ORDER BY count, term) - 1) // 50 AS batch FROM c WHERE count < 50000 AND NOT regexp_matches(term, 'TIN|STEEL')"""
)
def collection_batches(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select(Q("p_partkey").alias("id"), "p_type")
    return selection.collection_batches(selection.facets(parts, "p_type"), ("TIN", "STEEL"), 50_000, 50)


@query(f"WITH {ORDINALS_SQL}, w AS (SELECT DISTINCT sha1(p_partkey::VARCHAR) AS sha1 FROM part WHERE p_partkey % 2 = 0) SELECT w.sha1 FROM w WHERE sha1 IN (SELECT sha1 FROM ordinals)")
def content_exists(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "part").where("p_partkey % 2 = 0").select(media.content_hash(_s("p_partkey")).alias("sha1")).distinct()
    return media.content_exists(wanted, ordinals(spark, d))


@query("SELECT doc_id AS path, CASE WHEN doc_id % 3 = 0 THEN 'known' ELSE sha1(text) END AS sha1 FROM documents")
def signed_objects(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(Q("doc_id").alias("path"), F.when(Q("doc_id") % 3 == 0, "known").when(Q("doc_id") % 3 == 1, "").alias("sha1"), Q("text").cast("binary").alias("content"))
    return media.signed(rows)
