import datetime
import random

import pytest
from pyspark.sql import functions as F

from holdfast.functions import dates, fmt, rights, text, urls, wiki


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("shown", "expected"),
    [
        ("1945-06-07", ("+1945-06-07T00:00:00Z", 11, False)),
        ("6/7/1945", ("+1945-06-07T00:00:00Z", 11, False)),
        ("June 7, 1945", ("+1945-06-07T00:00:00Z", 11, False)),
        ("7 Sept. 945", ("+0945-09-07T00:00:00Z", 11, False)),
        ("1945-06", ("+1945-06-01T00:00:00Z", 10, False)),
        ("Nov 1902", ("+1902-11-01T00:00:00Z", 10, False)),
        ("1940s", ("+1940-01-01T00:00:00Z", 8, False)),
        ("1945", ("+1945-01-01T00:00:00Z", 9, False)),
        ("[circa 1945?]", ("+1945-01-01T00:00:00Z", 9, True)),
        ("1945s", None),
        ("30 February 1945", None),
        ("0", None),
        ("1945 AD", None),
        ("", None),
        (None, None),
    ],
)
def test_partial_date(spark, shown, expected):
    found = one(spark, shown, dates.partial_date)
    assert (tuple(found) if found else None) == expected


@pytest.mark.parametrize(("shown", "expected"), [("1950-1945", (1945, 1950)), ("between 1900 and 1910", (1900, 1910)), ("from 1900 to 1910", (1900, 1910)), ("1900 to 0000", None), ("1945", None), (None, None)])
def test_year_range(spark, shown, expected):
    found = one(spark, shown, dates.year_range)
    assert (tuple(found) if found else None) == expected


def test_month_before(spark):
    assert spark.range(1).select(dates.month_before(F.lit(datetime.date(2024, 1, 15)))).first()[0] == "2023-12"


def test_titles(spark):
    build = lambda c: text.page_title(c, F.lit("a" * 32), F.lit(".jpg"))
    assert one(spark, "doris_ulmann: 1/2 [x]", build) == f"Doris ulmann- 1-2 (x) - DPLA - {'a' * 32}.jpg"
    assert one(spark, "a & b = c", build).startswith("A + b - c - DPLA")
    assert one(spark, f"T - DPLA - {'0' * 32} (page 12).jpg", text.page_in_title) == 12
    assert one(spark, "no page.jpg", text.page_in_title) is None
    assert one(spark, "x.TAR.GZ", text.extension) == "gz"
    assert one(spark, "x", text.extension) == ""


def test_values(spark):
    assert one(spark, "  a\r\n\tb‎ ", text.statement_value) == "a b"
    assert one(spark, None, text.statement_value) == ""
    assert one(spark, "‘Straße’ ", text.folded) == "strasse"
    assert one(spark, "--", text.is_junk_value) is True
    assert one(spark, "é", text.is_junk_value) is False


@pytest.mark.parametrize(("n", "letter"), [(1, "A"), (26, "Z"), (27, "AA"), (702, "ZZ"), (703, "AAA")])
def test_series_letter(spark, n, letter):
    assert one(spark, n, text.series_letter, "int") == letter


def plain_chunks(value, limit):
    out = []
    while len(value) > limit:
        cut = limit
        while cut and (value[cut - 1].isspace() or value[cut].isspace()):
            cut -= 1
        out.append(value[: cut or limit])
        value = value[cut or limit :]
    return [*out, value]


def test_chunks(spark):
    rng = random.Random(1)
    values = ["".join(rng.choices("abcdefgh  ", k=n)) for n in (0, 5, 30, 31, 100, 400)] + ["a" + " " * 100 + "b", "ab" + " " * 70 + "cd", "x" * 95]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert {r["v"]: r["c"] for r in df.select("v", text.chunks(F.col("v"), 30).alias("c")).collect()} == {v: plain_chunks(v, 30) for v in values}


@pytest.mark.parametrize(
    ("value", "expected"),
    [("a{{!}}b{{((}}!}}", "a|b{{!}}"), ("{{((}}))}}", "{{))}}"), ("x{{=}}y{{!(}}{{)!}}", "x=y{||}"), (None, None)],
)
def test_magic_words_in_one_pass(spark, value, expected):
    assert one(spark, value, text.magic_unescaped) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("[A title.]", "a title"), ("A\n  B", "a b"), ("x{{!}}y", "x|y"), ("...", ""), (None, ""), ("“STRASSE” – ẞ", "strasse” – ss")],
)
def test_folded(spark, value, expected):
    assert one(spark, value, text.folded) == expected


def test_subsets(spark):
    rows = [("A; b", "B; a; C", True), ("A", "a; b", True), ("A", "a", False), ("A; d", "a; b", False), ("", "a; b", False), (None, "a; b", False), ("a", None, False)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v string, c string, e boolean")
    found = df.orderBy("i").select(text.multi_value_subset(F.col("v"), F.col("c")).alias("r")).collect()
    assert [r["r"] for r in found] == [r[2] for r in rows]


def test_date_templates(spark):
    cases = {
        "{{other date|~|1911}}": "circa 1911", "{{other_date|ca.|1911}}": "circa 1911", "{{other date|?|1911}}": "1911?", "{{other date|s|1910}}": "1910s", "{{other date|before|1911}}": None, "1911": None,
    }
    assert {v: one(spark, v, dates.of_other_date) for v in cases} == cases
    cases = {"{{Taken on|1921-09-21|location=x}}": "1921-09-21", "{{taken circa|1921}}": "circa 1921", "{{Taken_in||1921}}": "1921", "{{Taken on|location=x}}": None, "{{Other|1}}": None}
    assert {v: one(spark, v, dates.of_taken_on) for v in cases} == cases
    same = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(dates.same_date(F.col("a"), F.col("b")).alias("r")).first()["r"]
    assert same("19 November 1902", "1902-11-19") and same("{{other date|~|1910}}", "1910?") and not same("[1902]", "1902") and not same("foo", "foo")


def test_small_values(spark):
    assert one(spark, " " * 3 + "x" * 2000, text.cut_value) == "   " + "x" * 1496
    assert one(spark, "x" * 12, lambda c: text.ellipsis(c, 10)) == "x" * 10 + "... [truncated, 12 chars total]"
    assert one(spark, None, lambda c: text.ellipsis(c, 10)) == ""
    assert one(spark, "a=b", text.escape_parameter) == "a{{=}}b"
    assert one(spark, "A__b \t c_", text.canonical_title) == "A b c"
    assert one(spark, "Q12", text.is_entity_id) is True and one(spark, "q12", text.is_entity_id) is False
    assert one(spark, datetime.date(2026, 3, 1), dates.cutoff_year, "date") == 1906
    assert one(spark, 3725, dates.runtime, "int") == "1h 2m 5s" and one(spark, 65, dates.runtime, "int") == "1m 5s"
    assert one(spark, "https/x.org/a", urls.repaired_scheme) == "https:/x.org/a"
    assert one(spark, "https://dp.la/item/abc", urls.owner_of_reference) == "abc" and one(spark, "https://x.org", urls.owner_of_reference) is None
    assert one(spark, "A_%26_B%27s", urls.category_name) == "A & B's"
    assert one(spark, 'A "b"', lambda c: urls.search_url(c, F.lit("h"))).endswith("partner=%22h%22")
    assert one(spark, "A b.jpg", urls.file_page) == "https://commons.wikimedia.org/wiki/File:A_b.jpg"
    now = F.lit(datetime.datetime(2026, 1, 1))
    assert one(spark, "120", lambda c: dates.retry_after(c, now, 60)) == 120 and one(spark, "Thu, 01 Jan 2026 00:00:30 GMT", lambda c: dates.retry_after(c, now, 60)) == 30
    assert one(spark, "soon", lambda c: dates.retry_after(c, now, 60)) == 60


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("https://x.org/abc", "https://x.org/abc"),
        ("https://x.org/iiif/abc/", "https://x.org/iiif/abc"),
        ("https://x.org/a/iiif/abc", "https://x.org/a/iiif/abc"),
        ("https://x.org/a/b/iiif/abc", "https://x.org/a/b/iiif/abc"),
        ("http://x.org/abc/full/200,/0/default.jpg", "http://x.org/abc"),
        ("http://x.org/iiif/abc/0,0,9,9/!200,200/0/native.png", "http://x.org/iiif/abc"),
        ("http://x.org/a/iiif/abc/full/full/0/default.jpg", "http://x.org/a/iiif/abc"),
        ("http://x.org/a/b/iiif/abc/full/full/0/default.jpg", "http://x.org/a/b/iiif/abc"),
        ("http://x.org/iiif/ab/cd/ef", "http://x.org/iiif/ab/cd/ef"),
        ("http://x.org/a/b/c", None),
        ("ftp://x.org/abc", None),
        (None, None),
    ],
)
def test_full_size_image(spark, url, expected):
    assert one(spark, url, urls.full_size_image) == (expected and expected + "/full/max/0/default.jpg")


def test_rights(spark, tmp_path):
    cases = {
        "http://rightsstatements.org/vocab/NoC-US/1.0/": "NoC-US", "http://rightsstatements.org/vocab/NKC/1.0/": "NKC", "http://creativecommons.org/licenses/by-sa/4.0/": "Cc-by-sa-4.0",
        "http://creativecommons.org/licenses/by/3.0/us/": "Cc-by-3.0-us", "http://creativecommons.org/publicdomain/zero/1.0/": "cc-zero", "http://creativecommons.org/publicdomain/mark/1.0/": "PD-US", "http://x.org": "",
    }
    assert {v: one(spark, v, rights.permission_template) for v in cases} == cases
    assert one(spark, "http://rightsstatements.org/vocab/NKC/1.0/", lambda c: rights.permission(c, F.lit("NKC"), F.lit("Q1"))) == "NKC | Q1"
    assert one(spark, "http://x.org", lambda c: rights.permission(c, F.lit("t"), F.lit("Q1"))) == "t"
    file = tmp_path / "rights.json"
    file.write_text('{"https://r.org/https-only/": {"P275": "Q1"}, "http://r.org/b": {"P6426": "Q2"}}')
    assert sorted(map(tuple, rights.read_rights(spark, str(file)).collect())) == [("http://r.org/b", "P6426", "Q2"), ("http://r.org/https-only", "P275", "Q1")]
    for url, expected in (("https://sub.rightsstatements.org/x", True), ("https://rightsstatements.org@evil.example/", False), ("https://www.archives.gov/social-media/flickr-faqs.html", True), ("https://x.org/rightsstatements.org", False)):
        assert one(spark, url, urls.is_rights_url) is expected


def test_urls(spark):
    assert one(spark, "http://a.org/x/", urls.variants) == ["http://a.org/x/", "http://a.org/x", "https://a.org/x/", "https://a.org/x"]
    assert one(spark, None, urls.variants) == []
    assert one(spark, "https://x.org/record/100550?q=abc", urls.stable_token) == "100550"
    assert one(spark, "https://x.org/a", urls.stable_token) is None
    assert one(spark, "https://x.org:80/a", urls.authority) == "x.org:80"
    assert one(spark, "no url at all", urls.authority) is None
    assert one(spark, "http://h.org/cdm/ref/collection/c/id/7", urls.contentdm_manifest) == "http://h.org/iiif/info/c/7/manifest.json"
    assert one(spark, "https://r.org/vocab/x/1.0//", urls.rights_key) == "http://r.org/vocab/x/1.0"


def test_formats(spark):
    assert one(spark, 137, fmt.exit_text, "int") == " (exit 137 — SIGKILL — likely OOM)" and one(spark, 140, fmt.exit_text, "int") == " (exit 140 — signal 12)" and one(spark, 0, fmt.exit_text, "int") == ""
    assert one(spark, 1536, fmt.human_bytes, "bigint") == "1.5 KB" and one(spark, 5, fmt.human_bytes, "bigint") == "5.0 B"
    assert one(spark, 1200, lambda c: fmt.progress(c, F.lit(4800)), "int") == "1,200 / 4,800 files, ~25.0%"
    assert one(spark, 100 * 2**20, lambda c: fmt.upload_chunk(c, F.lit(True)), "bigint") == 20_000_000 and one(spark, 5, lambda c: fmt.upload_chunk(c, F.lit(True)), "bigint") == 0


def test_numbers(spark):
    row = spark.createDataFrame([(5, 200), (0, 10), (5000, 5000)], "a int, b int").select(fmt.percent(F.col("a"), F.col("b")).alias("p"), fmt.level(F.col("a")).alias("l")).collect()
    assert [tuple(r) for r in row] == [(2, "low"), (0, "very low"), (100, "very high")]


def test_sentences(spark):
    df = spark.createDataFrame([("d.org", 1200, 1, 4800, "Inst", "Hub"), ("d.org", 1, 0, 3, None, None), ("d.org", 0, 2, 3, None, None), ("d.org", 0, 0, 0, None, None)], "n string, u int, o int, t int, a string, h string")
    cols = [F.col(c) for c in "nuot"]
    domain = [r["s"] for r in df.select(fmt.readiness_sentence(*cols, aside=F.col("a"), hub=F.col("h")).alias("s")).collect()]
    assert domain[0].startswith("'[**d.org**](https://d.org)' *(e.g. '[Inst](https://") and "**high** readiness score because it has **1,200** eligible public domain items (**25%** of **4,800** total items) across all" in domain[0]
    assert domain[0].endswith(", and **1** additional item over 120 years old in other rights categories that could become eligible with rights review.")
    assert "**1** eligible public domain item (**33%**" in domain[1] and domain[1].endswith("a media location.")
    assert domain[2].endswith("no public domain items, but has **2** items over 120 years old in other rights categories that could become eligible with rights review.")
    assert domain[3].endswith("no public domain items and no items dated over 120 years old.")
    inst = df.select(fmt.readiness_sentence(F.lit("A [b]"), F.lit(5), F.lit(0), F.lit(5), "institution", F.lit("d.org")).alias("s")).first()["s"]
    assert inst.startswith("'**A \\[b\\]**' *([d.org](https://d.org))* has a **low**") and " already in CONTENTdm" in inst


def test_types_by_content(spark):
    files = {"FFD8FFE0": "image/jpeg", "0000001866747970717420": "video/quicktime", "000000186674797069736F6D": "video/mp4", "524946460000000057454250": "image/webp", "00": "application/octet-stream", "": "application/octet-stream"}
    df = spark.createDataFrame([(bytearray.fromhex(h),) for h in files], "c binary")
    assert [r["t"] for r in df.select(fmt.sniffed_type(F.col("c")).alias("t")).collect()] == list(files.values())


def test_move_reasons(spark):
    reason = lambda n: spark.range(1).select(wiki.move_reason(F.lit("x" * n), F.lit("é" * n), F.lit("a" * 32), F.lit("bot")).alias("r")).first()["r"]
    found = [reason(n) for n in (10, 115, 125, 137, 150)]
    assert found[0].endswith(f"(DPLA ID [[dpla:{'a' * 32}|{'a' * 32}]])") and found[-1] == "Title drift correction"
    assert all(len(r.encode()) + 36 + 3 + 3 * n <= 500 for r, n in zip(found[:-1], (10, 115, 125, 137)))
    assert [len(r) for r in found] == sorted((len(r) for r in found), reverse=True)


def test_capitals_are_one_code_point(spark):
    """As DuckDB has them, for every code point."""
    import duckdb

    letters = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    text_of = "".join(letters)
    mine = spark.createDataFrame([(text_of,)], "v string").select(text.capital(F.col("v"))).first()[0]
    theirs = dict(duckdb.sql("SELECT chr(i::INT), upper(chr(i::INT)) FROM range(1, 1114112) t(i) WHERE i NOT BETWEEN 55296 AND 57343").fetchall())
    assert len(mine) == len(letters) and [theirs[c] for c in letters] == list(mine)
    build = lambda c: text.page_title(c, F.lit("a"), F.lit(".jpg"))
    assert [one(spark, v, build) for v in ("ßx", "ﬁx", "ᾳx", "éx", "")] == [f"{v} - DPLA - a.jpg" for v in ("ẞx", "ﬁx", "ᾼx", "Éx", "")]


def test_values_of_any_shape(spark):
    """Texts that need nothing and those that need something, against a plain rule."""
    import re

    def plain(v):
        kept = re.sub("[\x00-\x1f\x7f-\x9f]+", " ", "".join(c for c in v or "" if c not in text.BAD_CHARACTERS))
        return re.sub(r"^\s+|\s+\Z", "", kept)

    made = random.Random(3)
    values = ["".join(made.choices("ab ~!\n\x00\x7f\x85\xa0é﻿ ", k=made.randrange(6))) for _ in range(2000)] + ["a", " ", "x" * 5000, "a\n", None]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", text.statement_value(F.col("v")).alias("r")).collect()
    assert {r["i"]: r["r"] for r in rows} == {i: plain(v) for i, v in enumerate(values)}
