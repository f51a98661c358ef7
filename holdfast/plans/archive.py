"""Selection, readiness, media and reconciliation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, urls
from ..operators import ordinals as media
from ..operators import readiness, relink, selection, series, statements
from .registry import Registry
from .roles import BANNED_SQL, INSTITUTIONS_SQL, ITEMS_SQL, ORDINALS_SQL, banned, institutions, items, ordinals, table

ARCHIVE = Registry()
query = ARCHIVE.query

_UP = "(coalesce(hub_upload, false) OR coalesce(inst_upload, false))"
_ELIGIBLE = f"coalesce(hub_qid <> '', false) AND coalesce(inst_qid <> '', false) AND {_UP}"


@query(f"WITH {INSTITUTIONS_SQL} SELECT * FROM institutions WHERE {_ELIGIBLE}")
def eligible_institutions(spark: SparkSession, d: str) -> DataFrame:
    return selection.eligible_institutions(institutions(spark, d))


@query(f"WITH {INSTITUTIONS_SQL} SELECT hub, bool_or({_UP}) AS eligible FROM institutions GROUP BY hub")
def hub_any_upload(spark: SparkSession, d: str) -> DataFrame:
    return selection.hub_uploads(institutions(spark, d))


_REASON = f"CASE WHEN hub_qid IS NULL THEN 'hub without id' WHEN inst_qid IS NULL THEN 'institution without id' WHEN NOT {_UP} THEN 'no upload' ELSE 'ok' END"


@query(f"WITH {INSTITUTIONS_SQL} SELECT hub, inst, {_REASON} = 'ok' AS ok, {_REASON} AS reason FROM institutions")
def eligibility_reason(spark: SparkSession, d: str) -> DataFrame:
    return selection.eligibility_reason(institutions(spark, d))


@query(
    f"""WITH {INSTITUTIONS_SQL}, {ITEMS_SQL}, {BANNED_SQL}
SELECT * FROM items WHERE rights = 'unlimited' AND has_asset AND id NOT IN (SELECT id FROM banned)
AND (hub, inst) IN (SELECT (hub, inst) FROM institutions WHERE {_ELIGIBLE})"""
)
def worklist(spark: SparkSession, d: str) -> DataFrame:
    return selection.worklist(items(spark, d), institutions(spark, d), banned(spark, d))


@query(
    f"""WITH {INSTITUTIONS_SQL}, {ITEMS_SQL}, {BANNED_SQL}
SELECT r.id, CASE WHEN i.id IS NULL THEN 'NOT_FOUND' WHEN b.id IS NOT NULL THEN 'BANNED' WHEN rights <> 'unlimited' THEN 'RIGHTS'
  WHEN NOT has_asset THEN 'NO_MEDIA' WHEN hub_qid IS NULL THEN 'UNKNOWN_HUB' WHEN inst_qid IS NULL OR NOT {_UP} THEN 'INSTITUTION' ELSE 'OK' END AS status
FROM (SELECT DISTINCT l_orderkey AS id FROM lineitem UNION SELECT DISTINCT -l_partkey FROM lineitem) r
LEFT JOIN items i USING (id) LEFT JOIN institutions n ON i.hub = n.hub AND i.inst = n.inst LEFT JOIN banned b ON r.id = b.id"""
)
def item_verdict(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem")
    requested = line.select(F.col("l_orderkey").alias("id")).union(line.select(-F.col("l_partkey"))).distinct()
    return selection.item_verdicts(requested, items(spark, d), institutions(spark, d), banned(spark, d))


@query(f"WITH {ITEMS_SQL} SELECT inst AS term, count(DISTINCT id) AS count FROM items GROUP BY inst")
def facet_counts(spark: SparkSession, d: str) -> DataFrame:
    return selection.facets(items(spark, d), "inst")


@query(
    """WITH c AS (SELECT p_type AS term, count(DISTINCT p_partkey) AS count FROM part GROUP BY p_type)
SELECT term, count, (row_number() OVER (ORDER BY count, term) - 1) // 6 AS batch FROM c WHERE count < 12000"""
)
def facet_batches(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_type")
    return selection.facet_batches(selection.facets(parts, "p_type"), 6, 12000)


@query(
    f"""WITH {ITEMS_SQL} SELECT id, min(scan)::INT AS scan FROM (SELECT id, 0 AS scan FROM items WHERE rights = 'unlimited'
UNION ALL SELECT id, 1 FROM items WHERE has_asset UNION ALL SELECT id, 2 FROM items WHERE old) GROUP BY id"""
)
def first_seen_union(spark: SparkSession, d: str) -> DataFrame:
    own = items(spark, d)
    return selection.first_seen([own.where("rights = 'unlimited'"), own.where("has_asset"), own.where("old")])


@query(
    """WITH w AS (SELECT DISTINCT p_brand AS name FROM part UNION SELECT n_name FROM nation UNION SELECT lower(n_name) FROM nation UNION SELECT r_name FROM region)
SELECT name, coalesce((SELECT min('n' || n_nationkey) FROM nation WHERE 'n' || n_nationkey = name), (SELECT min('n' || r_regionkey) FROM region WHERE r_name = name),
  (SELECT min('n' || n_nationkey) FROM nation WHERE lower(n_name) = lower(name))) AS slug FROM w"""
)
def dictionary_lookup_priority(spark: SparkSession, d: str) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    wanted = table(spark, d, "part").select(F.col("p_brand").alias("name")).union(nation.select("n_name")).union(nation.select(F.lower("n_name"))).union(region.select("r_name")).distinct()
    slug = lambda c: F.concat(F.lit("n"), F.col(c).cast("string"))
    return selection.resolve_names(wanted, nation.select(slug("n_nationkey").alias("slug"), F.col("n_name").alias("name")), region.select(F.col("r_name").alias("alias"), slug("r_regionkey").alias("slug")))


@query(
    f"""WITH {INSTITUTIONS_SQL} SELECT max(hub_qid) AS qid, hub, NULL::VARCHAR AS inst FROM institutions GROUP BY hub HAVING bool_or({_UP})
UNION ALL SELECT inst_qid, hub, inst FROM institutions WHERE inst_qid IS NOT NULL AND {_UP}"""
)
def reverse_lookup(spark: SparkSession, d: str) -> DataFrame:
    return selection.targets_of_entity(institutions(spark, d))


_LEVEL = "CASE WHEN unlim >= 5000 THEN 'very high' WHEN unlim >= 1000 THEN 'high' WHEN unlim >= 100 THEN 'moderate' WHEN unlim > 0 THEN 'low' ELSE 'very low' END"
_COUNTED = f"""counted AS (SELECT hub, inst, count(*) AS total, count(*) FILTER (rights = 'unlimited') AS unlim, count(*) FILTER (rights <> 'unlimited' AND old) AS old_other
  FROM items JOIN institutions USING (hub, inst) WHERE has_asset AND id NOT IN (SELECT id FROM banned) AND {_ELIGIBLE} GROUP BY hub, inst)"""


@query(
    f"""WITH {INSTITUTIONS_SQL}, {ITEMS_SQL}, {BANNED_SQL}, {_COUNTED}
SELECT hub, inst, total, unlim, old_other, {_LEVEL} AS level, CASE WHEN unlim > 0 AND total > 0 THEN round_even(unlim / total * 100, 0) ELSE 0 END::INT AS percent,
  row_number() OVER (PARTITION BY hub ORDER BY unlim DESC, old_other DESC, inst) AS rank FROM counted"""
)
def readiness_institution(spark: SparkSession, d: str) -> DataFrame:
    return readiness.by_institution(items(spark, d), institutions(spark, d), banned(spark, d))


@query(
    f"""WITH {INSTITUTIONS_SQL}, {ITEMS_SQL}, rec AS (
  SELECT n.hub AS domain, n.inst, bool_or(n.inst_qid IS NOT NULL) AS is_eligible, bool_or(n.inst_upload) AS is_partner, count(i.id) AS total,
    count(*) FILTER (rights = 'unlimited') AS unlim, count(*) FILTER (rights <> 'unlimited' AND old) AS old_other
  FROM institutions n LEFT JOIN items i ON n.hub = i.hub AND n.inst = i.inst GROUP BY n.hub, n.inst),
s AS (SELECT domain, sum(total)::BIGINT AS total, sum(unlim)::BIGINT AS unlim, sum(old_other)::BIGINT AS old_other, bool_or(is_eligible AND NOT is_partner) AS open,
  CASE WHEN max(total) > 0 THEN (array_agg(inst ORDER BY total DESC, inst))[1] ELSE '' END AS largest FROM rec GROUP BY domain)
SELECT domain, total, unlim, old_other, largest, {_LEVEL} AS level, row_number() OVER (ORDER BY unlim DESC, old_other DESC, domain) AS rank FROM s WHERE open"""
)
def readiness_domain(spark: SparkSession, d: str) -> DataFrame:
    own, found = institutions(spark, d), items(spark, d)
    records = own.join(found, ["hub", "inst"], "left").groupBy(F.col("hub").alias("domain"), "inst").agg(
        F.bool_or(F.col("inst_qid").isNotNull()).alias("is_eligible"),
        F.bool_or("inst_upload").alias("is_partner"),
        F.count("id").alias("total"),
        F.count_if(F.col("rights") == "unlimited").alias("unlim"),
        F.count_if((F.col("rights") != "unlimited") & F.col("old")).alias("old_other"),
    )
    return readiness.by_domain(records)


@query(
    """SELECT page_id, regexp_matches(url, '(?i)^https?://[^/]+/(?:digital|cdm(?:/ref)?)/collection/[^/]+/id/\\d+(?:/.*)?$') AS contentdm, contains(html, 'manifest.json') AS iiif, contains(html, '<img') AS media FROM pages"""
)
def media_platform_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.is_contentdm(F.col("url")).alias("contentdm"), F.contains("html", F.lit("manifest.json")).alias("iiif"), F.contains("html", F.lit("<img")).alias("media"))


_LABELLED = "labelled AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY id, ext) > 1 THEN (row_number() OVER (PARTITION BY id, ext ORDER BY ordinal))::VARCHAR ELSE '' END AS page FROM ordinals)"


@query(f"WITH {ORDINALS_SQL}, {_LABELLED} SELECT id, ordinal::INT AS ordinal, ext, page FROM labelled")
def page_labels(spark: SparkSession, d: str) -> DataFrame:
    return media.page_labels(ordinals(spark, d)).select("id", "ordinal", "ext", "page")


@query(f"WITH {ORDINALS_SQL.replace('ordinals AS', 'every AS', 1)}, ordinals AS (SELECT * FROM every WHERE status = 'F'), {_LABELLED} SELECT id, ordinal::INT AS ordinal, page FROM labelled")
def eligible_page_numbers(spark: SparkSession, d: str) -> DataFrame:
    return media.eligible_pages(ordinals(spark, d), F.col("status") == "F").select("id", "ordinal", "page")


@query(f"WITH {ORDINALS_SQL} SELECT id, sha1, count(*) AS copies FROM ordinals GROUP BY id, sha1 HAVING count(*) > 1")
def duplicate_content(spark: SparkSession, d: str) -> DataFrame:
    return media.duplicate_content(ordinals(spark, d))


@query(
    f"""WITH {ORDINALS_SQL}, {_LABELLED}, u AS (SELECT id, sha1, array_to_string(list_sort(list(DISTINCT page::INT)), ',') AS pages FROM labelled WHERE page <> '' GROUP BY id, sha1)
SELECT id, ordinal::INT AS ordinal, CASE WHEN page = '' THEN '' ELSE pages END AS pages FROM labelled LEFT JOIN u USING (id, sha1)"""
)
def page_union(spark: SparkSession, d: str) -> DataFrame:
    return media.page_union(ordinals(spark, d)).select("id", "ordinal", F.array_join("pages", ",").alias("pages"))


@query(
    f"""WITH {ORDINALS_SQL}, e AS (SELECT id, ordinal, id || '/' || ordinal AS title, sha1, status = 'F' AS eligible FROM ordinals),
f AS (SELECT id || '/' || ordinal AS title, CASE WHEN part % 10 = 0 THEN 'x' ELSE sha1 END AS found_sha1, part % 15 = 0 AS redirect FROM ordinals WHERE part % 7 <> 0)
SELECT id, ordinal::INT AS ordinal, CASE WHEN NOT eligible THEN 'SKIPPED' WHEN f.title IS NULL THEN 'MISSING' WHEN redirect THEN 'REDIRECT' WHEN sha1 = found_sha1 THEN 'CORRECT' ELSE 'MISMATCH' END AS status
FROM e LEFT JOIN f USING (title)"""
)
def verify_status(spark: SparkSession, d: str) -> DataFrame:
    own = ordinals(spark, d).withColumn("title", F.concat_ws("/", "id", "ordinal"))
    found = own.where("part % 7 <> 0").select("title", F.when(F.col("part") % 10 == 0, "x").otherwise(F.col("sha1")).alias("found_sha1"), (F.col("part") % 15 == 0).alias("redirect"))
    return media.verify(own.select("id", "ordinal", "title", "sha1", (F.col("status") == "F").alias("eligible")), found)


@query(
    """WITH c AS (SELECT l_orderkey AS id, count(*) AS found FROM lineitem GROUP BY 1)
SELECT id, listed, coalesce(found, 0) AS found FROM (SELECT o_orderkey AS id, o_orderkey % 7 + 1 AS listed FROM orders) LEFT JOIN c USING (id) WHERE listed <> coalesce(found, 0)"""
)
def incomplete_items(spark: SparkSession, d: str) -> DataFrame:
    return media.incomplete(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 7 + 1).alias("listed")), ordinals(spark, d))


@query(
    """WITH p AS (SELECT DISTINCT l_suppkey AS id, l_partkey % 700 + 1 AS page FROM lineitem), e AS (SELECT s_suppkey AS id, s_suppkey % 40 AS n FROM supplier),
b AS (SELECT p.id, page, CASE WHEN n = 1 THEN 0 ELSE n END AS start FROM p JOIN e USING (id) WHERE n >= 1 AND page > CASE WHEN n = 1 THEN 0 ELSE n END AND page <= CASE WHEN n = 1 THEN 0 ELSE n END + 500),
j AS (SELECT id, page, (page - coalesce(lag(page) OVER (PARTITION BY id ORDER BY page), start) - 1 > 2)::INT AS jump FROM b),
s AS (SELECT *, sum(jump) OVER (PARTITION BY id ORDER BY page) AS stops FROM j)
SELECT id, page FROM s WHERE stops = 0"""
)
def gap_audit(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), (F.col("l_partkey") % 700 + 1).alias("page")).distinct()
    return media.gap_audit(pages, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 40).alias("n")))


@query(
    f"""WITH {ORDINALS_SQL}, w AS (SELECT sha1(p_partkey::VARCHAR) AS sha1, p_partkey || '/1' AS preferred FROM part),
f AS (SELECT sha1, id || '/' || ordinal AS title, stamp AS uploaded FROM ordinals)
SELECT sha1, preferred, title, uploaded FROM (SELECT *, row_number() OVER (PARTITION BY sha1, preferred ORDER BY (title = preferred) DESC, uploaded NULLS LAST, title) AS n FROM w JOIN f USING (sha1)) WHERE n = 1"""
)
def earliest_by_hash(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "part").select(F.sha1(F.col("p_partkey").cast("string").cast("binary")).alias("sha1"), F.concat(F.col("p_partkey").cast("string"), F.lit("/1")).alias("preferred"))
    return media.by_hash(wanted, ordinals(spark, d).select("sha1", F.concat_ws("/", "id", "ordinal").alias("title"), F.col("stamp").alias("uploaded")))


@query(
    f"""WITH {ORDINALS_SQL} SELECT id, ordinal::INT AS ordinal, CASE WHEN size > 49 THEN 'ABSENT' WHEN size < 2 THEN 'BLANK' WHEN status <> 'F' THEN 'INELIGIBLE' WHEN part % 11 = 0 THEN 'NO_HASH'
WHEN owner % 9 = 0 THEN 'BAD_TYPE' WHEN ext = 'N' THEN 'BAD_EXTENSION' WHEN part % 2 = 0 THEN 'RETIRE' ELSE 'KEEP' END AS action FROM ordinals"""
)
def retire_decision(spark: SparkSession, d: str) -> DataFrame:
    size = F.when(F.col("size") > 49, None).when(F.col("size") < 2, 0).otherwise(F.col("size"))
    kind = F.when(F.col("owner") % 9 == 0, "text/html").otherwise("image/jpeg")
    action = media.retire_decision(size, F.col("status") == "F", F.when(F.col("part") % 11 != 0, F.col("sha1")), kind, F.when(F.col("ext") == "N", "").otherwise(F.col("ext")), F.col("part") % 2 == 0)
    return ordinals(spark, d).select("id", "ordinal", action.alias("action"))


@query(
    f"""WITH {ORDINALS_SQL}, a AS (SELECT *, CASE WHEN part % 3 <> 0 THEN date_diff('second', stamp, TIMESTAMP '1999-01-01') / 86400 END AS age FROM ordinals)
SELECT id, ordinal::INT AS ordinal, CASE WHEN age IS NOT NULL AND owner % 10 <> 0 AND age <= 730 THEN 'SKIPPED' WHEN status <> 'F' THEN 'REJECTED' WHEN age IS NOT NULL THEN 'REFRESHED' ELSE 'FETCHED' END AS action FROM a"""
)
def download_decision(spark: SparkSession, d: str) -> DataFrame:
    age = F.when(F.col("part") % 3 != 0, dates.age_days(F.lit("1999-01-01").cast("timestamp"), F.col("stamp").cast("timestamp")))
    return ordinals(spark, d).select("id", "ordinal", media.download_decision(age, F.col("owner") % 10 == 0, F.col("status") == "F", 730).alias("action"))


@query(
    f"""WITH {INSTITUTIONS_SQL}, {ITEMS_SQL}, i AS (SELECT id, hub_qid, inst_qid FROM items JOIN institutions USING (hub, inst) WHERE inst_qid IS NOT NULL)
SELECT id, 1 AS seq, 'P9126' AS prop, 'Q2944483' AS value, 'Q393351' AS role FROM i
UNION ALL SELECT id, 2, 'P9126', hub_qid, CASE WHEN hub_qid IN ('Q3', 'Q7') THEN 'Q108296843' ELSE 'Q393351' END FROM i
UNION ALL SELECT id, 3, 'P9126', inst_qid, CASE WHEN hub_qid IN ('Q3', 'Q7') THEN 'Q108296919' ELSE 'Q108296843' END FROM i"""
)
def claims_contributed(spark: SparkSession, d: str) -> DataFrame:
    return statements.contributed(items(spark, d).join(institutions(spark, d), ["hub", "inst"]).where("inst_qid is not null").select("id", "hub_qid", "inst_qid"), ["Q3", "Q7"])


@query(
    """WITH r AS (SELECT * FROM (VALUES ('F', 'P275', 'Q20007257'), ('O', 'P6426', 'Q47530911'), ('P', 'P6216', 'Q19652')) v(uri, prop, qid))
SELECT o_orderkey AS id, prop, qid AS value FROM orders JOIN r ON o_orderstatus = uri WHERE qid <> 'Q19652'
UNION ALL SELECT o_orderkey, 'P6216', CASE WHEN qid = 'Q19652' THEN 'Q19652' WHEN prop = 'P275' THEN 'Q50423863' ELSE 'Q19652' END FROM orders JOIN r ON o_orderstatus = uri"""
)
def claims_rights(spark: SparkSession, d: str) -> DataFrame:
    rights = spark.createDataFrame([("F", "P275", "Q20007257"), ("O", "P6426", "Q47530911"), ("P", "P6216", "Q19652")], "uri string, prop string, qid string")
    return statements.rights_statements(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("rights_uri")), rights)


_ACTION = """CASE WHEN wanted AND n IS NULL THEN 'add' WHEN wanted AND ours THEN 'keep' WHEN wanted AND f THEN 'add' WHEN wanted THEN 'annotate' WHEN ours AND prop <> 'P-R' THEN 'remove' ELSE 'ignore' END"""


@query(
    f"""WITH w AS (SELECT DISTINCT l_orderkey AS entity, 'P-' || l_returnflag AS prop, l_partkey AS value, true AS wanted FROM lineitem WHERE l_partkey % 5 <> 0),
h AS (SELECT l_orderkey AS entity, 'P-' || l_returnflag AS prop, l_partkey AS value, bool_or(l_suppkey % 2 = 0) AS ours, bool_or(l_suppkey % 3 = 0) AS f, count(*) AS n FROM lineitem WHERE l_partkey % 7 <> 0 GROUP BY ALL)
SELECT entity, prop, value, {_ACTION} AS action FROM w FULL JOIN h USING (entity, prop, value)"""
)
def reconcile_actions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("entity"), F.concat(F.lit("P-"), "l_returnflag").alias("prop"), F.col("l_partkey").alias("value"), (F.col("l_suppkey") % 2 == 0).alias("ours"), (F.col("l_suppkey") % 3 == 0).alias("foreign"))
    return statements.reconcile(rows.where("value % 5 <> 0"), rows.where("value % 7 <> 0"), ("P-R",))


@query(
    """WITH r AS (SELECT DISTINCT l_partkey AS entity, l_partkey || '-' || l_returnflag AS stmt, l_returnflag AS value, l_suppkey::VARCHAR AS owner FROM lineitem),
e AS (SELECT DISTINCT l_partkey AS entity, l_suppkey::VARCHAR AS owner, l_returnflag AS value FROM lineitem WHERE l_quantity > 30),
g AS (SELECT DISTINCT l_partkey AS entity, l_suppkey::VARCHAR AS owner FROM lineitem WHERE l_suppkey % 4 <> 0),
k AS (SELECT r.* FROM r LEFT JOIN e USING (entity, owner, value) LEFT JOIN g USING (entity, owner) WHERE e.owner IS NOT NULL OR g.owner IS NULL),
a AS (SELECT stmt, owner FROM k UNION SELECT s.stmt, e.owner FROM (SELECT DISTINCT entity, stmt, value FROM r) s JOIN e USING (entity, value))
SELECT entity, stmt, value, count(*) AS before, coalesce((SELECT string_agg(owner, ',' ORDER BY owner) FROM a WHERE a.stmt = r.stmt), '') AS owners,
  CASE WHEN (SELECT count(*) FROM a WHERE a.stmt = r.stmt) = 0 THEN 'remove' ELSE 'keep' END AS action FROM r GROUP BY entity, stmt, value"""
)
def reconcile_merged(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem")
    entity, owner, value = F.col("l_partkey").alias("entity"), F.col("l_suppkey").cast("string").alias("owner"), F.col("l_returnflag").alias("value")
    out = statements.reconcile_merged(
        line.select(entity, F.concat_ws("-", "l_partkey", "l_returnflag").alias("stmt"), value, owner),
        line.where("l_quantity > 30").select(entity, owner, value),
        line.where("l_suppkey % 4 <> 0").select(entity, owner),
    )
    return out.withColumn("owners", F.array_join("owners", ","))


@query(
    """SELECT stmt, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT l_orderkey AS stmt, l_partkey::VARCHAR AS item FROM lineitem WHERE l_quantity > 10
  EXCEPT SELECT l_orderkey, l_partkey::VARCHAR FROM lineitem WHERE l_discount > 0.05) GROUP BY stmt"""
)
def coalesce_patches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("stmt"), F.col("l_partkey").cast("string").alias("item"), "l_quantity", "l_discount")
    return statements.coalesce_patches(rows.where("l_quantity > 10").select("stmt", "item"), rows.where("l_discount > 0.05").select("stmt", "item")).withColumn("items", F.array_join("items", ","))


@query(
    """WITH e AS (SELECT DISTINCT l_orderkey AS id, l_linenumber AS page FROM lineitem WHERE l_returnflag <> 'R'), x AS (SELECT DISTINCT l_orderkey AS id, l_linenumber AS page FROM lineitem WHERE l_linestatus = 'O')
SELECT *, 'add' AS action FROM (SELECT * FROM e EXCEPT SELECT * FROM x) UNION ALL SELECT *, 'remove' FROM (SELECT * FROM x EXCEPT SELECT * FROM e)"""
)
def set_sync(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("page"), "l_returnflag", "l_linestatus")
    return statements.set_sync(rows.where("l_returnflag <> 'R'"), rows.where("l_linestatus = 'O'"), ["id"], "page", True)


@query(
    """SELECT l_orderkey AS id, l_linenumber AS n, CASE WHEN l_partkey % 13 = 0 THEN 'HAND_FIX_COMMUNITY' WHEN l_partkey % 11 = 0 THEN 'ALREADY_CORRECT' WHEN l_partkey % 7 = 0 THEN 'HAND_FIX'
WHEN l_partkey % 5 = 0 THEN 'MOVED' WHEN l_partkey % 3 = 0 THEN 'MOVED' WHEN l_suppkey % 2 = 0 THEN 'HAND_FIX' WHEN l_suppkey % 3 = 0 THEN 'MERGE_AND_REDIRECT' ELSE 'HAND_FIX' END AS outcome FROM lineitem"""
)
def drift_outcome(spark: SparkSession, d: str) -> DataFrame:
    every = lambda c, n: F.col(c) % n == 0
    community = F.when(every("l_partkey", 13), None).otherwise(F.lit(False))
    outcome = relink.drift_outcome(community, every("l_partkey", 11), every("l_partkey", 7), every("l_partkey", 5), every("l_partkey", 3), every("l_suppkey", 2), every("l_suppkey", 3))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), outcome.alias("outcome"))


@query(
    """WITH live AS (SELECT page_id AS id, url AS shown_at, page_id % 3 AS scope FROM pages),
f AS (SELECT page_id AS file, CASE WHEN page_id % 4 = 0 THEN page_id WHEN page_id % 4 = 1 THEN -1 END AS embedded_id,
  CASE WHEN page_id % 4 = 3 THEN regexp_replace(url, '^https?://[^/]*', 'http://old.example') WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8) ELSE url || '/' END AS url, page_id % 3 AS scope FROM pages),
v AS (SELECT file, unnest(list_distinct([u, CASE WHEN suffix(u, '/') THEN regexp_replace(u, '/+$', '') ELSE u || '/' END, o, CASE WHEN suffix(o, '/') THEN regexp_replace(o, '/+$', '') ELSE o || '/' END])) AS shown_at
  FROM (SELECT file, url AS u, CASE WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8) ELSE 'http://' || substr(url, 9) END AS o FROM f)),
x AS (SELECT file, min(id) AS exact, count(DISTINCT id) AS nx FROM v JOIN live USING (shown_at) GROUP BY file),
t AS (SELECT file, scope, (list_sort(list_transform(list_zip(ts, range(1, len(ts) + 1)), lambda z: {'w': -(2 * len(z[1]) + regexp_matches(z[1], '[0-9]')::INT), 'i': z[2], 't': z[1]})))[1].t AS token
  FROM (SELECT file, scope, list_filter(regexp_split_to_array(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*(?:\\?[^#]*)?)', 1), '[^A-Za-z0-9_-]+'), lambda s: s <> '') AS ts FROM f)),
s AS (SELECT file, min(id) AS scoped, count(DISTINCT id) AS ns FROM t JOIN live USING (scope) WHERE len(token) >= 6 AND contains(shown_at, token) GROUP BY file),
j AS (SELECT f.file, CASE WHEN e.id IS NOT NULL THEN 'embedded' WHEN nx = 1 THEN 'shown_at' WHEN nx > 1 THEN 'ambiguous' WHEN ns = 1 THEN 'token' WHEN ns > 1 THEN 'ambiguous' ELSE 'unresolved' END AS anchor, e.id AS direct, exact, scoped
  FROM f LEFT JOIN live e ON e.id = f.embedded_id LEFT JOIN x USING (file) LEFT JOIN s USING (file))
SELECT file, anchor, CASE anchor WHEN 'embedded' THEN direct WHEN 'shown_at' THEN exact WHEN 'token' THEN scoped END AS id FROM j"""
)
def relink_ladder(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    moved = F.regexp_replace("url", "^https?://[^/]*", "http://old.example")
    near = F.when(F.col("url").startswith("http://"), F.concat(F.lit("https://"), F.substr("url", F.lit(8)))).otherwise(F.concat("url", F.lit("/")))
    files = pages.select(
        F.col("page_id").alias("file"),
        F.when(F.col("page_id") % 4 == 0, F.col("page_id")).when(F.col("page_id") % 4 == 1, -1).alias("embedded_id"),
        F.when(F.col("page_id") % 4 == 3, moved).otherwise(near).alias("url"),
        (F.col("page_id") % 3).alias("scope"),
    )
    return relink.relink(files, pages.select(F.col("page_id").alias("id"), F.col("url").alias("shown_at"), (F.col("page_id") % 3).alias("scope")))


@query(
    """WITH edges AS (SELECT DISTINCT r_name AS parent, n_name AS child FROM region JOIN nation ON r_regionkey = n_regionkey UNION SELECT n_name, c_name FROM nation JOIN customer ON n_nationkey = c_nationkey)
SELECT a.child AS hub, b.child AS category FROM edges a JOIN edges b ON a.child = b.parent WHERE a.parent = (SELECT min(r_name) FROM region) AND starts_with(b.child, 'Customer')
AND b.child IN (SELECT c_name FROM customer WHERE c_acctbal > 0)"""
)
def category_two_hop(spark: SparkSession, d: str) -> DataFrame:
    region, nation, customer = (table(spark, d, t) for t in ("region", "nation", "customer"))
    edges = region.join(nation, region["r_regionkey"] == nation["n_regionkey"]).select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"))
    edges = edges.union(nation.join(customer, nation["n_nationkey"] == customer["c_nationkey"]).select("n_name", "c_name")).distinct()
    root = region.agg(F.min("r_name").alias("parent"))
    rooted = edges.join(F.broadcast(root), "parent").select(F.lit("root").alias("parent"), "child").union(edges)
    return series.two_hops(rooted, "root", customer.where("c_acctbal > 0").select(F.col("c_name").alias("category")), "Customer")


@query(
    """WITH t AS (SELECT DISTINCT c_name AS category FROM customer), a AS (SELECT c_name AS category FROM customer WHERE c_acctbal > 2000), q AS (SELECT DISTINCT c_name AS category FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT category, 'fulfilled' AS state FROM q WHERE category IN (SELECT category FROM a)
UNION ALL SELECT category, 'new' FROM t WHERE category NOT IN (SELECT category FROM a) AND category NOT IN (SELECT category FROM q)"""
)
def request_queue(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "customer").select(F.col("c_name").alias("category"), "c_acctbal", "c_mktsegment")
    return series.request_queue(own.select("category"), own.where("c_acctbal > 2000"), own.where("c_mktsegment = 'BUILDING'"))


@query("SELECT l_returnflag AS series, strftime(l_shipdate, '%Y-%m') AS month, sum(l_quantity) AS views FROM lineitem GROUP BY 1, 2")
def month_series(spark: SparkSession, d: str) -> DataFrame:
    return series.monthly(table(spark, d, "lineitem"), "l_returnflag", "l_shipdate", "l_quantity")


@query("SELECT l_suppkey AS series, max(strftime(l_shipdate, '%Y-%m')) AS last_month FROM lineitem GROUP BY 1 HAVING max(strftime(l_shipdate, '%Y-%m')) < '2002-01'")
def stale_series(spark: SparkSession, d: str) -> DataFrame:
    return series.stale(series.monthly(table(spark, d, "lineitem"), "l_suppkey", "l_shipdate", "l_quantity"), "2002-01")
