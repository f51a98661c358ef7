"""Records as JSON documents of any shape, kept as variants and projected with types.

A field counts only if it has exactly the wanted type; a record without what it must have goes to quarantine instead of
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, urls


def _typed(path: str, kind: str, name: str = "raw") -> Column:
    """The value at a path where it is of that JSON type, else null."""
    value = F.try_variant_get(F.col(name), path, "variant")
    return F.when(F.schema_of_variant(value) == kind, F.try_variant_get(F.col(name), path, "string"))


def text_field(path: str, name: str = "raw") -> Column:
    """A string, else empty."""
    return F.coalesce(_typed(path, "STRING", name), F.lit(""))


def list_field(path: str, name: str = "raw") -> Column:
    """A list of strings; one string is a list of one; all else is empty."""
    many = F.try_variant_get(F.col(name), path, "array<string>")
    one = _typed(path, "STRING", name)
    kind = F.schema_of_variant(F.try_variant_get(F.col(name), path, "variant"))
    return F.when(kind.startswith("ARRAY"), F.filter(many, lambda x: x.isNotNull())).when(one.isNotNull(), F.array(one)).otherwise(F.array().cast("array<string>"))


def object_field(path: str, name: str = "raw") -> Column:
    """An object as a variant, else null."""
    value = F.try_variant_get(F.col(name), path, "variant")
    return F.when(F.schema_of_variant(value).startswith("OBJECT"), value)


def objects_field(path: str, kind: str, name: str = "raw") -> Column:
    """A list of objects as structs; one object is a list of one, members of other kinds are left out, all else is empty."""
    value = F.try_variant_get(F.col(name), path, "variant")
    shape = F.schema_of_variant(value)
    members = F.when(shape.startswith("ARRAY"), F.try_variant_get(F.col(name), path, "array<variant>")).when(shape.startswith("OBJECT"), F.array(value))
    found = F.transform(F.filter(members, lambda x: F.schema_of_variant(x).startswith("OBJECT")), lambda x: F.from_json(F.to_json(x), kind))
    return F.coalesce(F.filter(found, lambda x: x.isNotNull()), F.array().cast(f"array<{kind}>"))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document a line, below any folders: raw variant, or null with the line where it is no JSON."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.try_parse_json("value").alias("raw"), F.col("value").alias("line"))


def project(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): typed items, and the lines of those without an id or a valid ingest date, with the reason."""
    day = F.try_to_date(F.substring(_typed("$.ingestDate", "STRING"), 1, 10), "yyyy-MM-dd")
    reason = F.when(F.col("raw").isNull(), "not JSON").when(text_field("$.id") == "", "no id").when(day.isNull(), "no ingest date")
    judged = items.withColumn("reason", reason)
    good = judged.where("reason is null").select(
        text_field("$.id").alias("id"),
        text_field("$.provider.name").alias("hub"),
        text_field("$.dataProvider.name").alias("inst"),
        text_field("$.rightsCategory").alias("rights_category"),
        text_field("$.rights").alias("rights"),
        text_field("$.isShownAt").alias("shown_at"),
        list_field("$.sourceResource.title").alias("titles"),
        list_field("$.sourceResource.creator").alias("creators"),
        list_field("$.sourceResource.description").alias("descriptions"),
        list_field("$.sourceResource.identifier").alias("identifiers"),
        F.filter(F.transform(objects_field("$.sourceResource.date", "struct<displayDate:string>"), lambda d: d["displayDate"]), lambda x: x.isNotNull()).alias("dates"),
        F.transform(
            objects_field("$.sourceResource.subject", "struct<name:string,exactMatch:array<string>>"), lambda s: F.struct(s["name"].alias("name"), s["exactMatch"].alias("exact_match"))
        ).alias("subjects"),
        F.filter(F.transform(objects_field("$.sourceResource.language", "struct<name:string>"), lambda x: x["name"]), lambda x: x.isNotNull()).alias("languages"),
        text_field("$.originalRecord.stringValue").alias("original"),
        list_field("$.mediaMaster").alias("media"),
        text_field("$.iiifManifest").alias("manifest"),
        day.alias("ingest_date"),
        "raw",
    )
    return good, judged.where("reason is not null").select("line", "reason")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """{hub: {Wikidata, upload, institutions: {name: {Wikidata, upload}}}} -> a row for each institution."""
    inner = "struct<Wikidata:string,upload:boolean>"
    kind = f"map<string,struct<Wikidata:string,upload:boolean,institutions:map<string,{inner}>>>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("m"))
    hubs = whole.select(F.explode("m").alias("hub", "h"))
    return hubs.select("hub", F.col("h.Wikidata").alias("hub_qid"), F.coalesce("h.upload", F.lit(False)).alias("hub_upload"), F.explode_outer("h.institutions").alias("inst", "i")).select(
        "hub", "hub_qid", "hub_upload", "inst", F.col("i.Wikidata").alias("inst_qid"), F.coalesce("i.upload", F.lit(False)).alias("inst_upload")
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a CSV without a header."""
    return spark.read.csv(path).select(F.trim("_c0").alias("id")).where("id <> ''")


def write_ids(ids: DataFrame, path: str) -> None:
    """Sorted over files, one column."""
    ids.select("id").distinct().repartitionByRange("id").sortWithinPartitions("id").write.csv(path)


def read_file_lists(spark: SparkSession, path: str) -> DataFrame:
    """Lists of URLs, one file an item: the file's name, and each URL with its number from 1.  A list is as long as an item has
    media, so that it is one row first."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), "([^/]+?)(?:\\.[^/.]*)?$", 1).alias("id"), "value")
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    return files.select("id", F.posexplode(lines).alias("n", "url")).select("id", (F.col("n") + 1).alias("ordinal"), "url")


def write_file_lists(urls: DataFrame, path: str) -> None:
    """(id, ordinal, url) -> a folder an item with its URLs in order, a line each."""
    listed = urls.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "url"))).alias("u"))
    listed.select("id", F.array_join(F.transform("u", lambda x: x["url"]), "\n").alias("value")).write.partitionBy("id").text(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with their file and a number that grows with the line, split as any text: the number comes from where the
    line's block begins and from the line's place among those that the task reads."""
    place = F.col("_metadata.file_block_start") * 1024 + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), place.alias("line_no"), F.col("value").alias("text"))


def id_shard(item: Column) -> Column:
    """The part of a partitioned table that an item lies in: two digits of its id."""
    return F.lower(F.substring(item, 1, 2))


def item_path(partner: Column, item: Column, name: Column) -> Column:
    """Where a file of an item lies: partner, the first four digits of the id as folders, the id."""
    return F.concat_ws("/", partner, F.lit("images"), *[F.substring(item, k, 1) for k in range(1, 5)], item, name)


def media_path(partner: Column, item: Column, ordinal: Column) -> Column:
    return item_path(partner, item, F.concat(ordinal.cast("string"), F.lit("_"), item))


def write_by_item(rows: DataFrame, path: str) -> None:
    """Rows of items, partitioned by the shard of their id; only the partitions that have rows are replaced."""
    rows.withColumn("shard", id_shard(F.col("id"))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)


def _content(value: Column) -> Column:
    """A datavalue in one text: a string, or what an object names."""
    of = lambda path: F.try_variant_get(value, path, "string")
    plain = F.when(F.schema_of_variant(value) == "STRING", of("$"))
    return F.coalesce(plain, of("$.id"), F.concat(F.lit("Q"), of("$['numeric-id']")), of("$.text"), of("$.time"))


def entity_statements(entities: DataFrame) -> DataFrame:
    """(entity, raw: an entity's JSON) -> its statements, a row each, with qualifiers and references."""
    snak = "struct<snaktype:string,datavalue:struct<type:string,value:variant>>"
    kind = f"struct<statements:map<string,array<struct<id:string,mainsnak:{snak},qualifiers:map<string,array<{snak}>>,references:array<struct<snaks:map<string,array<{snak}>>>>>>>>"
    every = entities.select("entity", F.explode(F.from_json("raw", kind)["statements"]).alias("prop", "list")).select("entity", "prop", F.explode("list").alias("s"))
    value = F.col("s.mainsnak.datavalue.value")
    pairs = F.flatten(F.transform(F.map_entries("s.qualifiers"), lambda e: F.transform(F.filter(e["value"], lambda q: q["snaktype"] == "value"), lambda q: F.struct(e["key"].alias("prop"), _content(q["datavalue"]["value"]).alias("value")))))
    first = lambda snaks, prop: _content(F.try_element_at(F.try_element_at(snaks, F.lit(prop)), F.lit(1))["datavalue"]["value"])
    refs = F.transform(
        "s.references",
        lambda r: F.struct(first(r["snaks"], "P123").alias("publisher"), first(r["snaks"], "P854").alias("url"), F.try_to_date(F.substring(first(r["snaks"], "P813"), 2, 10)).alias("retrieved"), first(r["snaks"], "P887").alias("basis")),
    )
    datatype = F.when(F.col("s.mainsnak.datavalue.type") == "wikibase-entityid", "wikibase-item").otherwise(F.col("s.mainsnak.datavalue.type"))
    return every.select(
        "entity", F.col("s.id").alias("stmt"), "prop", F.col("s.mainsnak.snaktype").alias("kind"), datatype.alias("datatype"), _content(value).alias("value"), F.try_variant_get(value, "$.language", "string").alias("language"),
        F.try_variant_get(value, "$.precision", "int").alias("precision"), pairs.alias("qualifiers"), refs.alias("refs"),
    )


def append_records(rows: DataFrame, path: str) -> None:
    """JSON lines behind those that are there."""
    rows.write.mode("append").json(path)


# The two versions of manifests.
MANIFEST_2, MANIFEST_3 = "http://iiif.io/api/presentation/2/context.json", "http://iiif.io/api/presentation/3/context.json"


def manifest_images(raw: Column) -> Column:
    """struct(urls, error): the full-size image URLs of a manifest of version 2 or 3, and why there are none.

    A canvas that is not well formed empties a version 3 manifest; services whose URL is not known are left out.
    """
    v2 = F.from_json(raw, "struct<sequences:array<struct<canvases:array<struct<images:array<struct<resource:struct<service:struct<`@id`:string>>>>>>>>>")
    two = F.flatten(F.transform(F.flatten(F.transform(v2["sequences"], lambda s: s["canvases"])), lambda c: F.transform(c["images"], lambda i: i["resource"]["service"]["@id"])))
    v3 = F.from_json(raw, "struct<items:array<struct<items:array<struct<items:array<struct<body:struct<id:string>>>>>>>>")
    canvases = F.transform(v3["items"], lambda c: F.try_element_at(F.try_element_at(c["items"], F.lit(1))["items"], F.lit(1)))
    broken = F.exists(canvases, lambda x: x.isNull())
    empty = F.array().cast("array<string>")
    large = lambda found: F.coalesce(F.filter(F.transform(found, urls.full_size_image), lambda x: x.isNotNull()), empty)
    context = F.get_json_object(raw, "$['@context']")
    versions = F.when(context.startswith("["), F.from_json(context, "array<string>")).otherwise(F.array(context))
    is_2, is_3 = F.array_contains(versions, MANIFEST_2), F.array_contains(versions, MANIFEST_3)
    found = F.when(is_3, F.when(broken, empty).otherwise(large(F.transform(canvases, lambda x: x["body"]["id"])))).when(is_2, large(two)).otherwise(empty)
    error = F.when(context.isNull(), "no version").when(~F.coalesce(is_2 | is_3, F.lit(False)), "unknown version").when(is_3 & broken, "malformed")
    return F.struct(found.alias("urls"), error.alias("error"))


def valid_ids(ids: DataFrame) -> DataFrame:
    return ids.where(text.is_item_id(F.col("id")))
