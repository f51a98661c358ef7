"""Statements of a file against what its items say: keys of facts, whose references they carry, what to remove or renew.

statements: entity, stmt, prop, kind, datatype, value, language, precision, qualifiers array<struct<prop, value>>,
refs array<struct<publisher, url, retrieved date, basis>>.  Null lists count as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, urls
from .claims import CIRCA, ITEM_URL
from .statements import SELF

# The basis of imported statements; the property of an item's own id; qualifiers that we write, by property.
IMPORTED, ITEM_ID, METHOD = "Q131783016", "P760", "P459"
OWN_QUALIFIERS = {
    "P170": ("P2093",), "P571": ("P1932", "P1480"), "P9126": ("P3831",), "P217": ("P195", "P1545"), "P7482": ("P973", "P137", "P2699", "P6108"),
    "P760": ("P304", "P1545"), "P4272": ("P1545",), "P1225": ("P1545",), "P1476": ("P1545",), "P10358": ("P1545",),
}
REFERENCE = "struct<publisher:string,url:string,retrieved:date,basis:string>"


def _list(c: Column | str, kind: str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast(f"array<{kind}>"))


def references() -> Column:
    return _list("refs", REFERENCE)


def qualifier_values(prop: str, qualifiers: str = "qualifiers") -> Column:
    """Values of a property among a statement's qualifiers, in order; those without a value are left out."""
    own = F.filter(_list(qualifiers, "struct<prop:string,value:string>"), lambda q: (q["prop"] == prop) & q["value"].isNotNull())
    return F.transform(own, lambda q: q["value"])


def first_qualifier(prop: str) -> Column:
    return F.try_element_at(qualifier_values(prop), F.lit(1))


def is_own(reference: Column) -> Column:
    """We publish what it refers to."""
    return F.coalesce(reference["publisher"] == SELF, F.lit(False))


def is_imported(reference: Column) -> Column:
    """It says that the statement was taken from a page's text."""
    return F.coalesce(reference["basis"] == IMPORTED, F.lit(False))


def has_own_reference() -> Column:
    return F.exists(references(), is_own)


def attributed_entities(statements: DataFrame) -> DataFrame:
    """Entities with a statement that has a reference of ours."""
    return statements.where(has_own_reference()).select("entity").distinct()


def contributors(statements: DataFrame) -> DataFrame:
    """The items that each file says it belongs to, and whether there are several."""
    own = statements.where((F.col("prop") == ITEM_ID) & F.col("value").isNotNull()).groupBy("entity").agg(F.array_sort(F.collect_set("value")).alias("items"))
    return own.withColumn("merged", F.size("items") > 1)


def amendable() -> Column:
    """Nobody else has a share in the statement: all its qualifiers are of the kinds that we write for its property, and all
    its references are ours."""
    allowed = F.array(F.lit(METHOD))
    for prop, own in OWN_QUALIFIERS.items():
        allowed = F.when(F.col("prop") == prop, F.array(F.lit(METHOD), *[F.lit(q) for q in own])).otherwise(allowed)
    used = F.transform(_list("qualifiers", "struct<prop:string,value:string>"), lambda q: q["prop"])
    return (F.size(F.array_except(used, allowed)) == 0) & F.forall(references(), is_own)


def time_key(time: Column, precision: Column, approximate: Column) -> Column:
    return F.concat(time, F.lit("|P"), precision.cast("string"), F.when(approximate, "|circa").otherwise(""))


def comparable() -> Column:
    """One key of a statement's value for comparing what an item says with what is there; null where it cannot be told.

    Unknown values count by their wording, the source by its page, texts with their part's number.
    """
    wording = F.when(F.col("prop") == "P571", first_qualifier("P1932")).otherwise(first_qualifier("P2093"))
    part = F.concat(F.col("value"), F.lit("#"), F.coalesce(first_qualifier("P1545"), F.lit("")))
    time = time_key(F.col("value"), F.col("precision"), F.array_contains(qualifier_values("P1480"), CIRCA))
    return (
        F.when(F.col("kind") == "somevalue", wording)
        .when(F.col("kind") != "value", F.lit(None))
        .when(F.col("prop") == "P7482", first_qualifier("P973"))
        .when(F.col("datatype") == "wikibase-item", F.col("value"))
        .when(F.col("datatype").isin("string", "monolingualtext"), part)
        .when(F.col("datatype") == "time", time)
    )


def expected_values(claims: DataFrame) -> DataFrame:
    """(id, prop, values): the keys that an item's statements have, by property; those that cannot be told are left out."""
    keyed = claims.withColumn("_key", comparable())
    return keyed.where("_key is not null").groupBy("id", "prop").agg(F.array_sort(F.collect_list("_key")).alias("values"))


FACT = "struct<shape:string,first:string,second:string>"


def fact() -> Column:
    """A key that equal facts share however they are written: a date as a time or as words, a range of years in any of its
    forms, texts whatever their case and the punctuation at their ends.  Null where it cannot be told."""
    key = lambda shape, first, second: F.struct(F.lit(shape).alias("shape"), first.cast("string").alias("first"), second.cast("string").alias("second")).cast(FACT)
    nothing = F.lit(None)
    folded = text.folded(F.when(F.col("kind") == "value", F.col("value")).otherwise(_wording()))
    full = F.when(folded != "", folded)
    time = time_key(F.col("value"), F.col("precision"), F.array_contains(qualifier_values("P1480"), CIRCA))
    of_value = (
        F.when((F.col("datatype") == "time") & time.isNotNull(), key("time", time, nothing))
        .when((F.col("datatype") == "string") & full.isNotNull(), key("string", full, nothing))
        .when((F.col("datatype") == "monolingualtext") & full.isNotNull(), key("monolingual", full, F.col("language")))
        .when(F.col("datatype") == "wikibase-item", key("item", F.col("value"), nothing))
    )

    def of_words(words: Column) -> Column:
        parsed = dates.partial_date(F.coalesce(dates.of_other_date(words), words))
        span = dates.year_range(words)
        return F.coalesce(
            dates.let(parsed, lambda p: F.when(p.isNotNull(), key("time", time_key(p["time"], p["precision"], p["approximate"]), nothing))),
            dates.let(span, lambda r: F.when(r.isNotNull(), key("date-range", r["first"], r["last"]))),
        )

    worded = F.coalesce(dates.let(_wording(), of_words), F.when(full.isNotNull(), key("p1932-string", full, nothing)))
    return F.when(F.col("kind") == "value", of_value).when((F.col("kind") == "somevalue") & _wording().isNotNull(), worded)


def _wording() -> Column:
    """The first wording that is not blank."""
    return F.try_element_at(F.filter(F.transform(qualifier_values("P1932"), text.strip), lambda x: x != ""), F.lit(1))


def stored_text() -> Column:
    """The text that a statement shows; null for those of entities and times."""
    return F.when((F.col("kind") == "value") & F.col("datatype").isin("string", "monolingualtext"), F.col("value")).when(F.col("kind") == "somevalue", first_qualifier("P1932"))


def imported_duplicates(statements: DataFrame) -> DataFrame:
    """(entity, stmt) of imported statements that say what one of ours of the same property says, or that join several texts
    of ours."""
    marked = statements.select("entity", "stmt", "prop", has_own_reference().alias("ours"), F.exists(references(), is_imported).alias("imported"), fact().alias("fact"), text.folded_parts(stored_text()).alias("parts"), stored_text().contains("; ").alias("several"))
    ours = marked.where("ours and fact is not null").select("entity", "prop", "fact").distinct()
    imported = marked.where("imported and not ours")
    equal = imported.join(ours, ["entity", "prop", "fact"], "left_semi").select("entity", "stmt")
    texts = ours.where(F.col("fact.shape").isin("monolingual", "string")).groupBy("entity", "prop").agg(F.collect_set("fact.first").alias("texts"))
    joined = imported.where(F.col("several") & (F.size("parts") > 0)).join(texts, ["entity", "prop"]).where(F.size(F.array_except("parts", "texts")) == 0).select("entity", "stmt")
    return equal.union(joined).distinct()


def imported_junk(statements: DataFrame) -> DataFrame:
    """(entity, stmt) of imported statements whose text is a mark or two."""
    return statements.where(F.exists(references(), is_imported) & F.coalesce(text.is_junk_value(stored_text()), F.lit(False))).select("entity", "stmt")


# ---------------------------------------------------------------- references


def own_reference(item: Column, retrieved: Column) -> Column:
    return F.struct(F.lit(SELF).alias("publisher"), F.concat(F.lit(ITEM_URL), item).alias("url"), retrieved.alias("retrieved"), F.lit(None).cast("string").alias("basis")).cast(REFERENCE)


def belongs(reference: Column, item: Column) -> Column:
    """It is ours, and names this item."""
    return is_own(reference) & F.coalesce(reference["url"] == F.concat(F.lit(ITEM_URL), item), F.lit(False))


def is_canonical(reference: Column, item: Column, retrieved: Column) -> Column:
    """It names this item and the date of its ingestion."""
    return belongs(reference, item) & F.coalesce(reference["retrieved"] == retrieved, F.lit(False))


def owner(reference: Column) -> Column:
    return urls.owner_of_reference(reference["url"])


def _renewed(mine: Callable, item: Column, retrieved: Column) -> Column:
    """References with the first of ours renewed and its repetitions dropped."""
    flags = F.transform(references(), mine)
    first = F.array_position(flags, True)
    kept = F.filter(references(), lambda r, i: ~mine(r) | (i + 1 == first))
    return F.transform(kept, lambda r: F.when(mine(r) & ~is_canonical(r, item, retrieved), own_reference(item, retrieved)).otherwise(r))


def refreshed(statements: DataFrame, items: DataFrame) -> DataFrame:
    """References of files of one item made current: the first of ours renewed, others of ours dropped, those of others kept.

    items: entity, item, retrieved.  Returns entity, stmt, refs of the statements that change.
    """
    own = statements.join(items, "entity").withColumn("new", _renewed(is_own, F.col("item"), F.col("retrieved")))
    return own.where(~F.col("new").eqNullSafe(references())).select("entity", "stmt", F.col("new").alias("refs"))


def is_expected(statements: DataFrame, expected: DataFrame) -> DataFrame:
    """Statements with ``expected``: whether their item says them, null where it cannot be told.

    expected: entity, prop, key.
    """
    wanted = expected.select("entity", "prop", F.col("key").alias("_key")).distinct().withColumn("_said", F.lit(True))
    keyed = statements.withColumn("_key", comparable())
    joined = keyed.join(wanted, ["entity", "prop", "_key"], "left")
    return joined.withColumn("expected", F.when(F.col("_key").isNotNull(), F.coalesce("_said", F.lit(False)))).drop("_key", "_said")


def merged_references(statements: DataFrame, items: DataFrame, expected: DataFrame) -> DataFrame:
    """References of files of several items, for one of them: what it says gets one current reference of its own, what it
    does not say loses it; references of others stay, and so does what cannot be told.

    Returns entity, stmt, refs of the statements that change.
    """
    known = is_expected(statements, expected).where("expected is not null").join(items, "entity")
    mine = lambda r: belongs(r, F.col("item"))
    said = _renewed(mine, F.col("item"), F.col("retrieved"))
    added = F.when(F.exists(references(), mine), said).otherwise(F.concat(references(), F.array(own_reference(F.col("item"), F.col("retrieved")))))
    own = known.withColumn("new", F.when(F.col("expected"), added).otherwise(F.filter(references(), lambda r: ~mine(r))))
    return own.where(~F.col("new").eqNullSafe(references())).select("entity", "stmt", F.col("new").alias("refs"))


# ---------------------------------------------------------------- qualifiers and snaks


def with_qualifiers(existing: Column, additions: Column) -> Column:
    """map of property to snaks, with additions behind those that are there; nothing is taken out."""
    return F.map_zip_with(existing, additions, lambda _, a, b: F.concat(F.coalesce(a, F.slice(b, 1, 0)), F.coalesce(b, F.slice(a, 1, 0))))


def without_snaks(existing: Column, hashes: Column) -> Column:
    """map of property to snaks without those of these hashes; properties that keep none go."""
    kept = F.transform_values(existing, lambda _, snaks: F.filter(snaks, lambda s: ~F.coalesce(F.array_contains(hashes, s["hash"]), F.lit(False))))
    return F.map_filter(kept, lambda _, snaks: F.size(snaks) > 0)


def snak_key(snak: Column) -> Column:
    """Content of a snak (struct of prop, kind, value, hash) whatever its hash."""
    return F.to_json(F.struct(snak["kind"].alias("kind"), snak["prop"].alias("prop"), snak["value"].alias("value")))


def reference_key(snaks: Column) -> Column:
    """Content of a reference (map of property to snaks) whatever the order and the hashes of its snaks."""
    entries = F.transform(F.map_entries(snaks), lambda e: F.struct(e["key"].alias("key"), F.array_sort(F.transform(e["value"], snak_key)).alias("snaks")))
    return F.to_json(F.array_sort(entries))


def edits(added: DataFrame, references_: DataFrame, removed: DataFrame) -> DataFrame:
    """One edit a file: statements to add, statements whose references change, and statements to remove.

    A statement that goes is not changed as well.
    """
    changed = references_.join(removed.select("entity", "stmt").distinct(), ["entity", "stmt"], "left_anti")
    gather = lambda df, c, name: df.groupBy("entity").agg(F.array_sort(F.collect_set(c)).alias(name))
    parts = gather(added, "claim", "add").join(gather(changed, "stmt", "change"), "entity", "full").join(gather(removed, "stmt", "remove"), "entity", "full")
    none = F.array().cast("array<string>")
    return parts.select("entity", *[F.coalesce(c, none).alias(c) for c in ("add", "change", "remove")])
