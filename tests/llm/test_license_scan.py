import pytest

from holdfast.llm import license_scan as ls
from holdfast.llm import license_texts as lt


def scan(spark, rows):
    df = spark.createDataFrame([(*r, "mine", 1.0, "x") for r in rows], "path string, text string, license string, cosine double, row string")
    out = ls.scan(df)
    assert out.columns == ["path", "license_given", "cosine_given", "row", "license", "cosine", "origin", "inherited_from"]
    rows = out.collect()
    assert all(r["license_given"] == "mine" and r["row"] == "x" for r in rows)
    return {r["path"]: (r["license"], r["origin"], r["inherited_from"]) for r in rows}


def test_headers_files_and_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    found = scan(
        spark,
        [
            ("a/LICENSE", mit), ("a/b/c/d.txt", "nothing here"), ("a/x/LICENSE", gpl), ("a/x/y.txt", None), ("a/x/z.txt", f"code\n{mit}\n" + "more words " * 40),
            ("q/r.txt", "a licence of no kind: license to kill"), ("top.txt", ""), (None, mit), ("h/one_line.txt", f"{mit} " + "And then the text goes on. " * 30),
            ("h/short.txt", "Copyright (c) 2020 A. Author. Released under the MIT License."), ("h/spdx.c", "/* SPDX-License-Identifier: GPL-2.0-or-later */ int main() {}"),
        ],
    )
    assert found["a/LICENSE"][:2] == ("MIT", "header")
    assert found["a/b/c/d.txt"] == ("MIT", "inherited", "a")
    assert found["a/x/y.txt"] == ("GPL-3.0", "inherited", "a/x")
    assert found["a/x/z.txt"] == ("MIT", "header", None)
    assert found["q/r.txt"] == (None, None, None) and found["top.txt"] == (None, None, None)
    assert found[None][:2] == ("MIT", "header")
    assert found["h/one_line.txt"][:2] == found["h/short.txt"][:2] == ("MIT", "header")
    assert found["h/spdx.c"][:2] == ("GPL-2.0", "header")


@pytest.mark.parametrize(("name", "which"), [(n, i) for n, texts in lt.BODIES.items() for i in range(len(texts))])
def test_whole_licences(spark, name, which):
    """Of any length, with a copyright line; without their disclaimers, too."""
    text = f"The {name} licence\n\nCopyright (c) 2021 Some Author and others\n\n" + lt.BODIES[name][which].replace(": ", ":\n\n")
    found = scan(spark, [("p/LICENSE", text), ("p/src/a.c", "int x;"), ("other/b.c", "int y;")])
    assert found["p/LICENSE"][0] == name and found["p/src/a.c"] == (name, "inherited", "p") and found["other/b.c"] == (None, None, None)


def test_long_licences_by_their_opening(spark):
    terms = "each term of these conditions holds for all uses " * 600
    found = scan(spark, [(f"{n}/COPYING", texts[0] + "\n\n" + terms) for n, texts in lt.OPENINGS.items()] + [("late/f", terms + lt.OPENINGS["GPL-3.0"][0])])
    assert {p: v[:2] for p, v in found.items()} == {f"{n}/COPYING": (n, "file") for n in lt.OPENINGS} | {"late/f": (None, None)}


def test_anchor_words_lose_no_match():
    """A text without a template's anchor words has a lower cosine than is asked for."""
    templates = ls.Templates(ls.standard())
    for t in templates.every:
        left = sum(v * v for w, v in t.weights.items() if w not in t.anchors)
        assert (left / t.norm**2) ** 0.5 < ls.FILE_COSINE < ls.HEADER_COSINE


def test_ties_go_to_the_first_name(spark):
    same = ls.Templates([("B", "header", "made free for everyone"), ("A", "header", "made free for everyone")])
    df = spark.createDataFrame([("p", "this is made free for everyone here")], "path string, text string")
    assert ls.scan(df, same).first()["license"] == "A"


def test_root_licence_reaches_everything(spark):
    found = scan(spark, [("LICENSE", "Licensed under the Apache License, Version 2.0."), ("deep/er/file", "x"), ("deep/er/file", "x")])
    assert found["deep/er/file"] == ("Apache-2.0", "inherited", "")


def test_empty_and_odd(spark, documents, odd_rows):
    assert ls.scanned_documents(documents([])).count() == 0
    assert ls.scanned_documents(documents(odd_rows)).count() == len(odd_rows)


def test_every_header_matches_itself(spark):
    found = scan(spark, [(f"d{i}/f", text) for i, (name, kind, text) in enumerate(ls.standard()) if kind == "header"])
    assert {p: v[0] for p, v in found.items()} == {f"d{i}/f": name for i, (name, kind, text) in enumerate(ls.standard()) if kind == "header"}


def test_length_is_no_switch(spark, documents):
    """A licence over and over is as like it as once: as its SQL has it, and as a licence file."""
    import duckdb

    rows = [(i, (text + "\n\n") * times) for i, (text, times) in enumerate((text, times) for texts in lt.BODIES.values() for text in texts for times in (1, 100))]
    df = documents([*rows, (1000, "x " * 5000 + rows[0][1])])
    found = {r["doc_id"]: r for r in ls.scanned_documents(df).collect()}
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "source").toArrow())
    theirs = {r[0]: r[1:] for r in con.sql(f"SELECT doc_id, license, origin FROM ({ls.scan_sql()})").fetchall()}
    assert {i: (r["license"], r["origin"]) for i, r in found.items()} == theirs
    for i in range(0, len(rows), 2):
        assert found[i]["origin"] is not None and (found[i]["license"], found[i]["origin"]) == (found[i + 1]["license"], found[i + 1]["origin"])
