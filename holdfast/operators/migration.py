"""From older templates to statements: what of a page's parameters is ours, what others wrote, and where that goes.

params: page, key, value, canonical (what we would write), by ("bot" or "community").
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text, urls, wiki
from .claims import CIRCA, qualifier, statement
from .compare import is_imported, references

# Older templates, the names that they have for parameters, and what parameters become.
TEMPLATES = ("artwork", "information", "photograph", "nara-image-full")
KEYS = {"title": "title", "description": "description", "date": "date", "author": "creator", "artist": "creator", "creator": "creator", "source": "source", "institution": "institution", "permission": "permission"}
PROPERTIES = {"title": "P1476", "description": "P10358", "date": "P571", "creator": "P2093"}
FOLDED_KEYS = ("title", "description", "permission", "creator")
RELATED_IMAGE, OWN_TEMPLATES = "P6802", ("dpla", "dpla metadata")
# How the public domain used to be said, and entities of the roles of unknown creators.
OLD_BLURB = "Public Domain: This image is in the public domain and may be used free of charge without permissions or fees."
ROLES = {"photographer": "Q33231", "artist": "Q483501", "author": "Q482980", "engraver": "Q329439", "painter": "Q1028181", "illustrator": "Q644687"}
_UNKNOWN = r"\{\{\s*[Uu]nknown\s*(?:\|\s*([^}|]*?)\s*)?\}\}"
_PAGE = r"\{\{\s*[Cc]reator\s*:\s*([^}|]+?)\s*\}\}"
_EMBEDDED = r"\{\{\s*(?:[Uu]nknown\s*(?:\|[^}|]*)?|[Cc]reator\s*:[^}|]+)\}\}"


def creator_shape(value: Column) -> Column:
    """struct(kind, value): "qid" with its entity, "page" with its title, "unknown" with a role, or "text"; null for templates
    that are not worth keeping."""
    v = F.trim(value)
    found = lambda pattern: F.regexp_extract(v, pattern, 1)
    shape = lambda kind, content: F.struct(F.lit(kind).alias("kind"), content.alias("value"))
    qid, page = r"(?i)^\{\{\s*creator\s*\|\s*wikidata\s*=\s*(Q\d+)\s*\}\}$", r"(?i)^\{\{\s*creator:([^}|]+?)\s*\}\}$"
    return (
        F.when(v.rlike(r"(?i)^\{\{\s*NARA-Author\s*\|"), F.lit(None))
        .when(v.rlike(qid), shape("qid", found(qid)))
        .when(v.rlike(page), shape("page", F.trim(found(page))))
        .when(v.rlike(f"^{_UNKNOWN}$"), shape("unknown", found(f"^{_UNKNOWN}$")))
        .when(v.rlike(_UNKNOWN) | v.rlike(_PAGE) | ~(v.startswith("{{") & v.endswith("}}")), shape("text", v))
    )


def embedded_creators(value: Column) -> Column:
    """struct(parts, rest): templates of creators inside a text, in order, as "unknown" with a role or "page" with a title, and
    the text without them and without the words that joined them."""
    every = F.regexp_extract_all(value, F.lit(_EMBEDDED), 0)
    part = lambda t: F.when(t.rlike(f"^{_UNKNOWN}$"), F.struct(F.lit("unknown").alias("kind"), F.regexp_extract(t, _UNKNOWN, 1).alias("value"))).otherwise(
        F.struct(F.lit("page").alias("kind"), F.trim(F.regexp_extract(t, _PAGE, 1)).alias("value"))
    )
    rest = F.trim(F.regexp_replace(F.regexp_replace(value, _UNKNOWN, ""), _PAGE, ""), F.lit(" ;,·—–-\t\n"))
    joined = rest.rlike(r"(?i)^(?:and|und|et|&|,|;|/|·|—|–|-|\s)+$")
    return F.struct(F.transform(every, part).alias("parts"), F.when(joined, "").otherwise(rest).alias("rest"))


def clean_creator(value: Column) -> Column:
    """Beside embedded creators there is plain text only."""
    rest = embedded_creators(value)["rest"]
    return ~rest.contains("{{") & ~rest.contains("[[")


def only_links(value: Column) -> Column:
    """External links, one at least, and white space or line breaks."""
    link = r"\[https?://[^\]\s]+(?:\s[^\]]*)?\]|https?://[^\s<>\[\]]+"
    rest = F.regexp_replace(F.regexp_replace(value, link, ""), r"(?i)<br\s*/?>", "")
    return value.rlike(link) & (F.trim(F.regexp_replace(rest, r"\s+", "")) == "")


@F.pandas_udf(T.BooleanType())
def _own_templates(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v is not None and wiki.only_templates(v, OWN_TEMPLATES))


def generated(key: Column, value: Column) -> Column:
    """The value is what an upload writes by itself: our templates alone, a link as source or institution, links to rights
    statements (or the old blurb) as permission."""
    near = F.lower(value).contains("dpla")
    ours = near & _own_templates(F.when(near, value))
    links = F.regexp_extract_all(value, F.lit(r"https?://[^\s<>\[\]]+"), 0)
    rights = only_links(value) & F.forall(links, urls.is_rights_url)
    blurb = text.folded(value) == text.folded(F.lit(OLD_BLURB))
    return F.coalesce(ours | (key.isin("source", "institution") & only_links(value)) | ((key == "permission") & (blurb | rights)), F.lit(False))


def unfit(key: Column, value: Column) -> Column:
    """The value cannot be a statement: the parameter has no property, or a text has line breaks or markup."""
    broken, plain = value.rlike(r"[\n\r\t]"), wiki.unwrap_language(value)["text"]
    marked = F.when(key == "creator", ~clean_creator(value)).otherwise(plain.contains("{{") | plain.contains("[["))
    return ~key.isin(*PROPERTIES) | ((key != "date") & (broken | marked))


def equivalent(key: Column, value: Column, canonical: Column) -> Column:
    """The value says what we would: alike, or the same date, institution, text but for case and punctuation, or some of the
    parts of a joined text."""
    said = F.when(key.isin("title", "description"), wiki.unwrap_language(value)["text"]).otherwise(value)
    institution = wiki.institution_of(value)
    same = text.folded(said)
    folded = key.isin(*FOLDED_KEYS) & (((same != "") & (same == text.folded(canonical))) | text.multi_value_subset(said, canonical))
    return F.coalesce(
        (said == canonical)
        | ((key == "date") & dates.same_date(value, canonical))
        | ((key == "institution") & institution.isNotNull() & (institution == F.coalesce(wiki.institution_of(canonical), F.trim(canonical))))
        | folded,
        F.lit(False),
    )


def plan(params: DataFrame) -> DataFrame:
    """Each parameter with what becomes of it and the text that goes there: "drop" (generated), "originated" (ours), "extend"
    (ours, with text behind a line break that stays on the page), "preserve" (stays on the page whole) or "import" (becomes a
    statement)."""
    key, value, canonical = F.col("key"), F.col("value"), F.coalesce("canonical", F.lit(""))
    theirs = (F.col("by") == "community") & ~equivalent(key, value, canonical)
    extra = wiki.split_extra(value, canonical)
    action = (
        F.when(generated(key, value), "drop").when(~F.coalesce(theirs, F.lit(False)), "originated").when(extra.isNotNull(), "extend").when(unfit(key, value), "preserve").otherwise("import")
    )
    kept = F.when(key == "institution", F.coalesce(wiki.institution_of(value), value)).otherwise(value)
    planned = params.withColumn("action", action).withColumn("_extra", extra).withColumn("_kept", kept)
    content = F.when(F.col("action") == "extend", F.col("_extra")).when(F.col("action") == "preserve", F.col("_kept")).otherwise(F.col("value"))
    return planned.select("page", "key", "action", content.alias("content"))


def import_claims(key: Column, value: Column) -> Column:
    """Statements of an imported value.  A date that is none is a wording; creators are entities, pages (a statement whose value
    is the page's title, to be resolved), unknown persons with a role, or names."""
    words = wiki.unwrap_language(value)
    said = lambda prop: statement(prop, words["text"], "monolingualtext", language=words["language"], method=False)
    shown = dates.plain_date(value)
    date = dates.let(
        dates.partial_date(shown),
        lambda d: statement("P571", d["time"], "time", qualifier("P1480", F.when(d["approximate"], CIRCA)), qualifier("P1932", F.when(d.isNull(), shown)), precision=d["precision"], kind=F.when(d.isNotNull(), "value").otherwise("somevalue"), method=False),
    )
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    unknown = lambda r: statement("P170", F.lit(None), "wikibase-item", qualifier("P3831", F.try_element_at(role, F.lower(r))), kind="somevalue", method=False)
    page = lambda p: statement("P170", p, "creator-page", method=False)
    name = lambda n: statement("P170", F.lit(None), "wikibase-item", qualifier("P2093", n), kind="somevalue", method=False)
    parts = embedded_creators(value)
    listed = F.concat(
        F.transform(parts["parts"], lambda p: F.when(p["kind"] == "unknown", unknown(p["value"])).otherwise(page(p["value"]))),
        F.when(parts["rest"] != "", F.array(name(parts["rest"]))).otherwise(F.slice(F.array(name(parts["rest"])), 1, 0)),
    )
    shape = creator_shape(value)
    creator = F.when(shape["kind"] == "qid", F.array(statement("P170", shape["value"], "wikibase-item", method=False))).when(shape["kind"] == "page", F.array(page(shape["value"]))).when(shape["kind"] == "unknown", F.array(unknown(shape["value"]))).otherwise(listed)
    return F.when(key == "title", F.array(said("P1476"))).when(key == "description", F.array(said("P10358"))).when(key == "date", F.array(date)).when(key == "creator", creator)


def build_imports(planned: DataFrame, related: DataFrame) -> DataFrame:
    """Statements of all values to import, and of related files; related: page, file.  Returns page, s.* ."""
    own = planned.where("action = 'import'").select("page", F.explode(import_claims(F.col("key"), F.col("content"))).alias("s"))
    files = related.select("page", statement(RELATED_IMAGE, F.col("file"), "commonsMedia", method=False).alias("s"))
    return own.union(files).select("page", "s.*")


def materialize(imports: DataFrame, creators: DataFrame, files: DataFrame, existing: DataFrame) -> DataFrame:
    """Imports made ready: pages of creators become their entities (a name where a page has none), files must exist, and what
    a page's entity has already is left out.

    creators: title, qid; files: title; existing: page, prop, value.
    """
    resolved = imports.join(creators.select(F.col("title").alias("value"), "qid"), "value", "left").select(*imports.columns, "qid")
    is_page = F.col("datatype") == "creator-page"
    named = F.concat("qualifiers", F.array(qualifier("P2093", F.col("value"))))
    ready = resolved.select(
        "page", "prop", F.when(is_page & F.col("qid").isNull(), "somevalue").otherwise(F.col("kind")).alias("kind"), F.when(is_page, "wikibase-item").otherwise(F.col("datatype")).alias("datatype"),
        F.when(is_page, F.col("qid")).otherwise(F.col("value")).alias("value"), "language", "precision", F.when(is_page & F.col("qid").isNull(), named).otherwise(F.col("qualifiers")).alias("qualifiers"),
    )
    there = ready.join(files.select(F.col("title").alias("value"), F.lit(True).alias("_there")).distinct(), "value", "left").where((F.col("datatype") != "commonsMedia") | F.col("_there"))
    return there.select(*ready.columns).join(existing.select("page", "prop", "value").distinct(), ["page", "prop", "value"], "left_anti").select(*ready.columns)


def already_migrated(statements: DataFrame) -> DataFrame:
    """Entities with an imported statement of one of the properties that parameters become."""
    return statements.where(F.col("prop").isin(*PROPERTIES.values()) & F.exists(references(), is_imported)).select("entity").distinct()


def value_matches(value: Column, expected: Column, languages: Column, key: Column) -> Column:
    """The page shows what we would write: alike, in a wrapper of one of the item's languages, the same date, or the same text
    but for case and punctuation.  Other templates are the editors' own."""
    wrapper = wiki.language_wrapper(value)
    templates = value.contains("{{")
    inner = F.when(wrapper.isNotNull(), F.regexp_extract(F.trim(value), r"(?s)^\{\{[^|]*\|(.*)\}\}$", 1)).otherwise(value)
    open_ = ~templates | (wrapper.isNotNull() & F.coalesce(F.array_contains(languages, wrapper), F.lit(False)))
    plain, wanted = F.trim(inner), F.trim(expected)
    folded = text.folded(plain)
    alike = (plain == wanted) | ((key == "date") & dates.same_date(plain, wanted)) | (key.isin(*FOLDED_KEYS) & (folded != "") & (folded == text.folded(wanted)))
    return F.coalesce((F.trim(value) == wanted) | (open_ & alike), F.lit(False))


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def _old_parameters(values: pd.Series) -> pd.Series:
    def one(page: str | None) -> dict[str, str] | None:
        found = [(p, p[0]) for p in (wiki.find_template(page or "", n) for n in TEMPLATES) if p]
        if not found:
            return None
        place = min(found, key=lambda x: x[1])[0]
        rows: list[list[str]] = []
        open_ = False
        for name, value in wiki.arguments(page[place[0] + 2 : place[1] - 2]):
            if name is None:  # a pipe inside a value
                if open_:
                    rows[-1][1] += "|" + value
                continue
            name = name.casefold()
            key = KEYS.get(name)
            if key is None and name.startswith("other fields"):
                wrapped = wiki.parameters(value, "InFi") or {}
                if wrapped.get("1", "").casefold() == "creator" and "2" in wrapped:
                    key, value = "creator", wrapped["2"]
            elif name in ("other versions", "other_versions"):
                key = "other versions"
            open_ = key is not None and key != "other versions"
            if key is not None:
                rows.append([key, value])
        return {k: v for k, v in rows if v}

    return values.map(one)


def old_parameters(page: Column) -> Column:
    """map of canonical names to values of a page's first older template, magic words undone; null without one.

    Unnamed arguments belong to the value before them, which a bare pipe has cut; creators inside a wrapper are taken out;
    junk and creators that are not worth keeping are left out.
    """
    near = F.lower(F.translate(page, "_", " ")).rlike("|".join(TEMPLATES))
    found = F.transform_values(F.when(near, _old_parameters(F.when(near, page))), lambda _, v: text.magic_unescaped(v))
    return F.map_filter(found, lambda k, v: ~text.is_junk_value(v) & ((k != "creator") | creator_shape(v).isNotNull()))
