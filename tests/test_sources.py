import json

from pyspark.sql import functions as F

from holdfast.sources import records


def test_items_and_quarantine(spark, tmp_path):
    good = {"id": "x", "provider": {"name": "h"}, "ingestDate": "2024-05-06T00:00:00Z", "sourceResource": {"title": "one", "creator": ["a", "b"], "identifier": 7, "date": {"displayDate": "1900"}, "subject": [{"name": "s", "exactMatch": ["u"]}, "x"], "language": [{"name": "English"}, {}]}, "rights": 5}
    lines = [json.dumps(good), json.dumps({"id": "y"}), "{broken", json.dumps({"ingestDate": "2024-05-06"})]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "items.json").write_text("\n".join(lines))
    kept, bad = records.project(records.read_items(spark, f"file://{tmp_path}"))
    row = kept.first()
    assert (row["id"], row["hub"], row["titles"], row["creators"], row["identifiers"], row["rights"]) == ("x", "h", ["one"], ["a", "b"], [], "")
    assert (row["dates"], [tuple(x) for x in row["subjects"]], row["languages"]) == (["1900"], [("s", ["u"])], ["English"])
    assert kept.select(F.to_json(records.object_field("$.provider")).alias("p"), records.object_field("$.rights").alias("q")).first()["p"] == '{"name":"h"}'
    assert sorted(r["reason"] for r in bad.collect()) == ["no id", "no ingest date", "not JSON"]


def test_registry(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"h": {"Wikidata": "Q1", "institutions": {"i": {"Wikidata": "Q2", "upload": True}}}, "k": {"Wikidata": "", "upload": True}}))
    found = {tuple(r) for r in records.read_registry(spark, f"file://{tmp_path}/r.json").collect()}
    assert found == {("h", "Q1", False, "i", "Q2", True), ("k", "", True, None, None, False)}


def test_ids_round_trip(spark, tmp_path):
    records.write_ids(spark.createDataFrame([("b",), ("a",), ("a",)], "id string"), f"file://{tmp_path}/ids")
    assert sorted(r["id"] for r in records.read_ids(spark, f"file://{tmp_path}/ids").collect()) == ["a", "b"]


def test_file_lists_and_logs(spark, tmp_path):
    (tmp_path / "x1.txt").write_text("http://a\n\nhttp://b\n")
    assert [tuple(r) for r in records.read_file_lists(spark, f"file://{tmp_path}/x1.txt").orderBy("ordinal").collect()] == [("x1", 1, "http://a"), ("x1", 2, "http://b")]
    lines = records.read_logs(spark, f"file://{tmp_path}/x1.txt").orderBy("line_no").collect()
    assert [r["text"] for r in lines] == ["http://a", "", "http://b"] and lines[0]["file"].endswith("x1.txt")


def test_lines_of_a_split_log_keep_their_order(spark, tmp_path):
    (tmp_path / "long.log").write_text("".join(f"line {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        log = records.read_logs(spark, f"file://{tmp_path}/long.log")
        assert log.rdd.getNumPartitions() > 2
        assert [r["text"] for r in log.orderBy("line_no").collect()] == [f"line {i}" for i in range(5000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_paths_and_sinks(spark, tmp_path):
    item = "abcd" + "0" * 28
    row = spark.range(1).select(records.media_path(F.lit("p"), F.lit(item), F.lit(3)).alias("m"), records.id_shard(F.lit(item)).alias("s")).first()
    assert tuple(row) == (f"p/images/a/b/c/d/{item}/3_{item}", "ab")
    urls = spark.createDataFrame([("x", 2, "u2"), ("x", 1, "u1"), ("y", 1, "v")], "id string, ordinal int, url string")
    records.write_file_lists(urls, f"file://{tmp_path}/lists")
    back = spark.read.text(f"file://{tmp_path}/lists/id=x").collect()
    assert [r["value"] for r in back] == ["u1", "u2"]
    for status in ("a", "b"):
        records.write_by_item(spark.createDataFrame([(item, status)], "id string, status string"), f"file://{tmp_path}/results")
    records.write_by_item(spark.createDataFrame([("ff", "c")], "id string, status string"), f"file://{tmp_path}/results")
    assert sorted(r["status"] for r in spark.read.parquet(f"file://{tmp_path}/results").collect()) == ["b", "c"]
    for k in range(2):
        records.append_records(spark.createDataFrame([(k,)], "k int"), f"file://{tmp_path}/fixes")
    assert spark.read.json(f"file://{tmp_path}/fixes").count() == 2
    assert records.valid_ids(spark.createDataFrame([("a" * 32,), ("x",), (None,)], "id string")).count() == 1


def test_entities(spark):
    q = lambda v: [{"snaktype": "value", "datavalue": {"value": v, "type": "string"}}]
    raw = {
        "statements": {
            "P1476": [{"id": "s1", "mainsnak": {"snaktype": "value", "datavalue": {"type": "monolingualtext", "value": {"text": "T", "language": "en"}}}, "qualifiers": {"P1545": q("A1"), "P9": [{"snaktype": "novalue"}]}}],
            "P571": [{"id": "s2", "mainsnak": {"snaktype": "value", "datavalue": {"type": "time", "value": {"time": "+1945-01-01T00:00:00Z", "precision": 9}}}}],
            "P170": [{"id": "s3", "mainsnak": {"snaktype": "somevalue"}, "qualifiers": {"P2093": q("Ann")}}],
            "P195": [{"id": "s4", "mainsnak": {"snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": {"numeric-id": 5}}},
                      "references": [{"snaks": {"P123": [{"snaktype": "value", "datavalue": {"value": {"id": "Q2944483"}}}], "P854": q("https://dp.la/item/x"), "P813": [{"datavalue": {"value": {"time": "+2024-05-01T00:00:00Z"}}}]}}]}],
        }
    }
    found = {r["stmt"]: r for r in records.entity_statements(spark.createDataFrame([("M1", json.dumps(raw)), ("M2", "{}")], "entity string, raw string")).collect()}
    assert (found["s1"]["value"], found["s1"]["language"], [tuple(x) for x in found["s1"]["qualifiers"]]) == ("T", "en", [("P1545", "A1")])
    assert (found["s2"]["value"], found["s2"]["precision"], found["s2"]["datatype"]) == ("+1945-01-01T00:00:00Z", 9, "time")
    assert (found["s3"]["kind"], found["s3"]["value"]) == ("somevalue", None)
    assert found["s4"]["value"] == "Q5" and found["s4"]["refs"][0]["publisher"] == "Q2944483" and str(found["s4"]["refs"][0]["retrieved"]) == "2024-05-01"


def test_manifests(spark):
    v2 = {"@context": "http://iiif.io/api/presentation/2/context.json", "sequences": [{"canvases": [{"images": [{"resource": {"service": {"@id": "http://s/u1"}}}, {"resource": {}}]}]}]}
    v3 = {"@context": ["x", "http://iiif.io/api/presentation/3/context.json"], "items": [{"items": [{"items": [{"body": {"id": "http://s/iiif/w1/full/200,/0/a.jpg"}}]}]}]}
    broken = {**v3, "items": [*v3["items"], {"items": []}]}
    df = spark.createDataFrame([(json.dumps(x),) for x in (v2, v3, broken, {"@context": "else"}, {})], "raw string")
    found = [tuple(r["r"]) for r in df.select(records.manifest_images(F.col("raw")).alias("r")).collect()]
    size = "/full/max/0/default.jpg"
    assert found == [([f"http://s/u1{size}"], None), ([f"http://s/iiif/w1{size}"], None), ([], "malformed"), ([], "unknown version"), ([], "no version")]
