from pyspark.sql import functions as F

from holdfast.functions import wiki

TEXT = "x {{Artwork |title = {{en|1=A|b}} |date={{other date|~|1900}} | [[File:a.jpg|thumb]] |plain|url=http://a?b=c}} y"


def test_parameters_mind_nesting():
    assert wiki.parameters(TEXT, "artwork") == {"title": "{{en|1=A|b}}", "date": "{{other date|~|1900}}", "1": "[[File:a.jpg|thumb]]", "2": "plain", "url": "http://a?b=c"}
    assert wiki.parameters(TEXT, "other_date") == {"1": "~", "2": "1900"}
    assert wiki.parameters("{{broken", "broken") is None and wiki.parameters(None, "x") is None
    assert wiki.parameters("{{x}}", "x") == {}


def test_columns(spark):
    df = spark.createDataFrame([(TEXT,), ("nothing",), (None,)], "t string")
    assert [r[0] and r[0]["2"] for r in df.select(wiki.template_parameters(F.col("t"), "Artwork")).collect()] == ["plain", None, None]
    one = lambda v, f: tuple(spark.createDataFrame([(v,)], "v string").select(f(F.col("v")).alias("r")).first()["r"] or ())
    assert one("{{de|1= Haus }}", wiki.unwrap_language) == ("Haus", "de")
    assert one("Haus", wiki.unwrap_language) == ("Haus", "en")
    got = spark.createDataFrame([("Q5", "Title\nmore", "title"), ("{{Institution|wikidata=Q7}}", "Other\nmore", "title")], "q string, v string, c string")
    assert [tuple(r) for r in got.select(wiki.institution_of(F.col("q")), wiki.split_extra(F.col("v"), F.col("c"))).collect()] == [("Q5", "\nmore"), ("Q7", None)]
    row = df.limit(1).select(wiki.normalize(F.col("t"), "Artwork", F.create_map(F.lit("2"), F.lit("Plain "), F.lit("date"), F.lit("1901"))).alias("r")).first()["r"]
    assert row["stripped"] == ["2"] and "date" in row["kept"]


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


def test_language_templates(spark):
    cases = {"{{EN|a [[b|c]] d}}": ("a [[b|c]] d", "en"), "{{xx|a}}": ("{{xx|a}}", "en"), "{{en|a|b}}": ("{{en|a|b}}", "en"), "{{de|{{x}} y}}": ("{{x}} y", "de"), "x {{en|a}}": ("x {{en|a}}", "en")}
    assert {v: tuple(one(spark, v, wiki.unwrap_language)) for v in cases} == cases
    assert one(spark, "{{es|hola}}", wiki.language_wrapper) == "es" and one(spark, "{{es|1=hola}}", wiki.language_wrapper) is None and one(spark, "hola", wiki.language_wrapper) is None


def test_pages(spark):
    assert one(spark, "File:some_ file.jpg ", wiki.file_name) == "Some file.jpg"
    assert one(spark, "{{other version|a_b.jpg}} {{Other_versions}} {{other version|File:A b.jpg|x}}{{other version|c.png}}", wiki.related_files) == ["A b.jpg", "C.png"]
    assert one(spark, "x {{Institution|a=b|wikidata = Q5}} {{DPLA|x|hub=Q7}}", wiki.institution_in_page) == "Q5"
    assert one(spark, "x {{Institution}} | wikidata=Q5 {{DPLA|x|hub=Q7}}", wiki.institution_in_page) is None
    assert one(spark, "x {{DPLA|x|hub=Q7}}", wiki.hub_in_page) == "Q7"
    assert one(spark, "a {{dpla_metadata|x=1}}", wiki.has_metadata_template) is True and one(spark, "a {{dpla}}", wiki.has_metadata_template) is False
    assert wiki.only_templates(" {{DPLA|a|{{x}}}}\n{{DPLA metadata}} ", ("dpla", "dpla metadata")) and not wiki.only_templates("{{DPLA}} by me", ("dpla",)) and not wiki.only_templates("", ("dpla",))
    langs = spark.createDataFrame([(["French", "Klingon", " german "],), (None,)], "l array<string>").select(wiki.language_codes(F.col("l")).alias("r")).collect()
    assert [r["r"] for r in langs] == [["de", "en", "fr"], ["en"]]
    page = spark.range(1).select(wiki.metadata_page({n: F.lit("" if n == "creator" else n.upper()) for n in wiki.PARAMETERS}).alias("r")).first()["r"]
    assert page.startswith("== {{int:filedesc}} ==\n\n{{DPLA metadata\n| title = TITLE\n") and page.endswith("\n| local_id = LOCAL_ID\n}}")
    assert one(spark, "== {{int:filedesc}} ==\n{{DPLA metadata|a= 1 |b = {{x|y}} }}\nrest", wiki.canonical_page) == "== {{int:filedesc}} ==\n\n{{DPLA metadata\n| a = 1\n| b = {{x|y}}\n}}\nrest"
    assert one(spark, "no template", wiki.canonical_page) == "no template"


def test_merged_page(spark):
    old = "x {{Featured picture}} {{PD-USGov-NASA}} {{Image extracted|a.jpg}} [[Category:A]] [[Category:B]] [[Category:A]]"
    merge = lambda o, n: spark.createDataFrame([(o, n)], "o string, n string").select(wiki.merged_page(F.col("o"), F.col("n")).alias("r")).first()["r"]
    assert merge(old, "new\n") == "new\n\n=={{Assessment}}==\n{{Featured picture}}\n\n{{PD-USGov-NASA}}\n\n{{Image extracted|a.jpg}}\n\n[[Category:A]]\n[[Category:B]]\n"
    assert merge(old, "new {{PD-USGov-NASA}} {{Image extracted|a.jpg}}{{Featured picture}}\n[[Category:A]]") == "new {{PD-USGov-NASA}} {{Image extracted|a.jpg}}{{Featured picture}}\n[[Category:A]]\n[[Category:B]]\n"
    assert merge("nothing", "new") == "new\n"
