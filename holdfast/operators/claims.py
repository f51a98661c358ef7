"""Statements of an item: one row a statement, in the order in which they are written.

items: id, url, titles, descriptions, dates, creators, identifiers array<string>, subjects array<struct<name, qid>>, hub_qid, inst_qid,
rights_uri, manifest, numbers array<string>, access, level, ingest_date date.  Null lists count as empty.

A statement: seq, prop, kind ("value" or "somevalue"), datatype, value, language, precision, qualifiers (array of property and
value, in order), owner (the item that its reference names) and retrieved (the reference's date).
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text, urls
from .statements import AGGREGATOR, CONTRIBUTOR, COPYRIGHTED, CUSTODIAL, LICENSE, PUBLIC_DOMAIN, REPOSITORY, SELF, STATEMENT, STATUS

# Entities and properties of the statements that items get.
HEURISTIC, SOURCE_CATALOG, CIRCA = "Q61848113", "Q74228490", "Q5727902"
MARK_ENTITY, MARK_STATUS = "Q6938433", "Q88088423"
CONTENT_HUBS = ("Q518155", "Q131626")
PUBLIC_DOMAIN_MARK = "http://creativecommons.org/publicdomain/mark/1.0"
ITEM_URL, CATALOG_URL = "https://dp.la/item/", "https://catalog.archives.gov/id/"
# Access codes and levels of description, by entity.
ACCESS = {"10031403": "Q66739888", "10031402": "Q24238356", "10031399": "Q66739729", "10031400": "Q66739849", "10031401": "Q66739875"}
LEVELS = {"item": "Q11723795", "itemAv": "Q11723795", "fileUnit": "Q59221146"}

_QUALIFIERS = "array<struct<prop:string,value:string>>"
_STATEMENT = f"struct<prop:string,kind:string,datatype:string,value:string,language:string,precision:int,qualifiers:{_QUALIFIERS}>"


def qualifier(prop: str, value: Column) -> Column:
    return F.struct(F.lit(prop).alias("prop"), value.cast("string").alias("value"))


def statement(prop: str | Column, value: Column, datatype: str, *qualifiers: Column, language: Column | str | None = None, precision: Column | int | None = None, kind: Column | str = "value", method: bool = True) -> Column:
    """One statement: the method is its first qualifier (unless another wrote it); qualifiers without a value are left out.  A
    value that is not known has the kind "somevalue" and is null."""
    plain = lambda x: x if isinstance(x, Column) else F.lit(x)
    every = F.filter(F.array(qualifier("P459", F.lit(HEURISTIC if method else None)), *qualifiers), lambda q: q["value"].isNotNull())
    return F.struct(
        plain(prop).alias("prop"), plain(kind).alias("kind"), F.lit(datatype).alias("datatype"), F.when(plain(kind) == "value", value.cast("string")).alias("value"),
        plain(language).cast("string").alias("language"), plain(precision).cast("int").alias("precision"), every.alias("qualifiers"),
    ).cast(_STATEMENT)


def _none() -> Column:
    return F.array().cast(f"array<{_STATEMENT}>")


def _values(c: Column) -> Column:
    return F.coalesce(c.cast("array<string>"), F.array().cast("array<string>"))


def long_statements(values: Column, prop: str, datatype: str, *qualifiers: Column, language: str | None = None, after: Callable[[Column], Column] | None = None) -> Column:
    """Statements of texts: a text that is too long is cut into several, with its series letter and the part's number.  after:
    the statements that follow those of the text at an index."""
    cut = F.transform(_values(values), lambda v: dates.let(text.statement_value(v), lambda n: F.when(n == "", _values(F.lit(None))).otherwise(text.chunks(n))))

    def of_parts(parts: Column) -> Column:
        def of_value(own: Column, i: Column) -> Column:
            letter = text.series_letter(F.size(F.filter(F.slice(parts, 1, i + 1), lambda p: F.size(p) > 1)))
            own = F.transform(own, lambda p, k: statement(prop, p, datatype, qualifier("P1545", F.when(F.size(own) > 1, F.concat(letter, (k + 1).cast("string")))), *qualifiers, language=language))
            return own if after is None else F.concat(own, after(i))

        return F.flatten(F.transform(parts, of_value))

    return dates.let(cut, of_parts)


def rights_statements(uri: Column, prop: Column, qid: Column) -> Column:
    """Statements of an item's rights: prop and qid are what the table of rights has for its URI, null if nothing.  The mark of
    the public domain is a status alone; a license or rights statement brings the status that follows from it."""
    entity = lambda p, v: statement(p, v, "wikibase-item")
    status = F.when(qid == MARK_ENTITY, MARK_STATUS).when(prop == LICENSE, COPYRIGHTED).when(prop == STATEMENT, PUBLIC_DOMAIN)
    mapped = F.array_compact(F.array(entity(prop, qid), F.when(status.isNotNull(), entity(STATUS, status))))
    return F.when(urls.rights_key(uri) == PUBLIC_DOMAIN_MARK, F.array(entity(STATUS, F.lit(PUBLIC_DOMAIN)))).when(qid.isNotNull(), mapped).otherwise(_none())


def contributed_statements(hub: Column, inst: Column) -> Column:
    """This aggregator, the hub and the institution, each with its role."""
    content = hub.isin(*CONTENT_HUBS)
    row = lambda value, role: statement(CONTRIBUTOR, value, "wikibase-item", qualifier("P3831", role))
    return F.array(row(F.lit(SELF), F.lit(AGGREGATOR)), row(hub, F.when(content, REPOSITORY).otherwise(AGGREGATOR)), row(inst, F.when(content, CUSTODIAL).otherwise(REPOSITORY)))


def source_statement(hub: Column, url: Column, manifest: Column) -> Column:
    """Where the item is described: its page, who runs it, and its manifest if that is a URL."""
    bare = text.strip(manifest)
    usable = F.when(bare.startswith("http://") | bare.startswith("https://"), bare)
    return statement("P7482", F.lit(SOURCE_CATALOG), "wikibase-item", qualifier("P973", url), qualifier("P137", hub), qualifier("P6108", usable))


def creator_statements(creators: Column) -> Column:
    """Creators are wordings of someone who is not told apart."""
    named = F.filter(F.transform(_values(creators), text.cut_value), lambda v: v != "")
    return F.transform(named, lambda v: statement("P170", F.lit(None), "wikibase-item", qualifier("P2093", v), kind="somevalue"))


def date_statements(shown: Column) -> Column:
    """Dates with what they parse to, if they do; always with their wording, and marked where they are approximate."""

    def of_date(v: Column) -> Column:
        return dates.let(
            dates.partial_date(v),
            lambda d: statement(
                "P571", d["time"], "time", qualifier("P1480", F.when(d["approximate"], CIRCA)), qualifier("P1932", v), precision=d["precision"], kind=F.when(d.isNotNull(), "value").otherwise("somevalue")
            ),
        )

    return F.transform(F.filter(F.transform(_values(shown), text.cut_value), lambda v: v != ""), of_date)


def subject_statements(subjects: Column) -> Column:
    """A subject's name (a string) and its entity; names that are too long are cut as other texts."""
    own = F.coalesce(subjects, F.array().cast("array<struct<name:string,qid:string>>"))

    def entity(i: Column) -> Column:
        qid = F.element_at(own, i + 1)["qid"]
        return F.when(F.coalesce(qid, F.lit("")) != "", F.array(statement("P921", qid, "wikibase-item"))).otherwise(_none())

    return long_statements(F.transform(own, lambda s: s["name"]), "P4272", "string", after=entity)


def build(items: DataFrame, rights: DataFrame) -> DataFrame:
    """All statements of items, in the order of their families; rights: uri (normalised), prop, qid.

    One projection of each item: the table of rights alone, which is short, is sent to all of them (many items share a URI, so
    that those of one URI must not meet in one task).  An item without a date of ingestion has none.
    """
    entity = lambda prop, c: F.when(F.coalesce(c, F.lit("")) != "", F.array(statement(prop, c, "wikibase-item"))).otherwise(_none())
    known = items.withColumn("_key", urls.rights_key(F.col("rights_uri"))).join(F.broadcast(rights.select(F.col("uri").alias("_key"), F.col("prop").alias("_prop"), F.col("qid").alias("_qid"))), "_key", "left")
    collection = F.when(F.col("hub_qid").isin(*CONTENT_HUBS), F.col("hub_qid")).otherwise(F.col("inst_qid"))
    families = [
        rights_statements(F.col("rights_uri"), F.col("_prop"), F.col("_qid")),
        long_statements(F.array(F.col("id").cast("string")), "P760", "string"),
        long_statements(F.col("titles"), "P1476", "monolingualtext", language="en"),
        F.when(F.coalesce("inst_qid", F.lit("")) != "", entity("P195", collection)).otherwise(_none()),
        creator_statements(F.col("creators")),
        date_statements(F.col("dates")),
        subject_statements(F.col("subjects")),
        long_statements(F.col("descriptions"), "P10358", "monolingualtext", language="en"),
        contributed_statements(F.col("hub_qid"), F.col("inst_qid")),
        F.array(source_statement(F.col("hub_qid"), F.col("url"), F.col("manifest"))),
        long_statements(F.col("identifiers"), "P217", "string", qualifier("P195", F.col("inst_qid"))),
        long_statements(F.col("numbers"), "P1225", "string"),
        entity("P7228", F.col("access")),
        entity("P6224", F.col("level")),
    ]
    rows = known.where("ingest_date is not null").select(
        "id", F.posexplode(F.concat(*families)).alias("seq", "s"), F.concat(F.lit(ITEM_URL), F.col("id").cast("string")).alias("owner"), F.col("ingest_date").alias("retrieved")
    )
    return rows.select("id", "seq", "s.*", "owner", "retrieved")


# ---------------------------------------------------------------- subjects and levels


def subject_number(exact_match: Column) -> Column:
    """The catalogue number of a subject, from the first of its exact matches."""
    return F.replace(F.try_element_at(exact_match, F.lit(1)), F.lit(CATALOG_URL), F.lit(""))


def subject_queries(items: DataFrame) -> DataFrame:
    """(id, subjects array<struct<name, exact_match array<string>>>) -> distinct (name, number) to be looked up."""
    every = items.select(F.explode("subjects").alias("s")).where("size(s.exact_match) > 0")
    return every.select(F.coalesce("s.name", F.lit("")).alias("name"), subject_number(F.col("s.exact_match")).alias("number")).where("number is not null").distinct()


def first_answers(queries: DataFrame, answers: DataFrame) -> DataFrame:
    """The first answer to each query; answers: name, number, rank, qid.  Queries without a named answer go."""
    best = answers.where("qid <> ''").groupBy("name", "number").agg(F.min_by("qid", "rank").alias("qid"))
    return queries.join(best, ["name", "number"])


def resolve_subjects(items: DataFrame, known: DataFrame, found: DataFrame) -> DataFrame:
    """Each item's subjects with their entities: (id, pos, name, qid), an empty qid where nothing is known, one row a subject at
    least.  The table of names (name, qid) goes first and gives each entity once in an item; else what was found for (name,
    number)."""
    every = items.select("id", F.posexplode("subjects").alias("pos", "s")).select("id", "pos", F.coalesce("s.name", F.lit("")).alias("name"), subject_number(F.col("s.exact_match")).alias("number"))
    by_name = known.where("qid <> ''").groupBy("name").agg(F.array_sort(F.collect_set("qid")).alias("qids"))
    joined = every.join(by_name, "name", "left").join(found.withColumnRenamed("qid", "one"), ["name", "number"], "left")
    rows = joined.select("id", "pos", "name", F.explode(F.coalesce("qids", F.array(F.coalesce("one", F.lit(""))))).alias("qid"), F.col("qids").isNotNull().alias("_named"))
    # an entity that an earlier name of the item brought is not said again
    first = rows.where("_named").groupBy("id", "qid").agg(F.min("pos").alias("_first"))
    kept = rows.join(first, ["id", "qid"], "left").where("not _named or pos = _first")
    bare = every.join(kept.select("id", "pos").distinct(), ["id", "pos"], "left_anti").select("id", "pos", "name", F.lit("").alias("qid"))
    return kept.select("id", "pos", "name", "qid").union(bare)


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("access", "level", "error")]))
def access_level(records: pd.Series) -> pd.DataFrame:
    """Access and level entities of an XML record: empty where it says nothing, an error where it is no XML.

    The level is the name of the record's outermost element; the access, the first status of a restriction.
    """

    def parse(record: str | None) -> tuple[str | None, str | None, str | None]:
        if record is None:
            return None, None, "no record"
        try:
            root = ET.fromstring(record)
        except ET.ParseError as error:
            return None, None, str(error)
        number = root.findtext(".//{*}accessRestriction/{*}status/{*}naId") or ""
        return ACCESS.get(number.strip(), ""), LEVELS.get(root.tag.rpartition("}")[2], ""), None

    return pd.DataFrame([parse(r) for r in records], columns=["access", "level", "error"])
