"""Queries with SQL against DuckDB, and the pipeline's stages over the smallest tables."""

import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from holdfast.llm import mixing, registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    mine = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    theirs = sorted((tuple(map(plain, r)) for r in con.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()), key=repr)
    assert mine == theirs


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_against_brute_force(spark, tmp_path):
    """Each stage over what the stage before it kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, tables = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{k}")
        tables.append([r.asDict() for r in docs.collect()])
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
    ids = lambda rows: sorted(r["doc_id"] for r in rows)
    first, named, single, clean, mixed = tables

    assert ids(named) == ids(r for r in first if any(c.isalpha() for c in r["text"] or ""))

    sets, parent = [(r["doc_id"], shingles(r["text"])) for r in named], {r["doc_id"]: r["doc_id"] for r in named}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, one) in enumerate(sets):
        for j, other in sets[:k]:
            if one and other and 100 * len(one & other) >= 75 * len(one | other):
                low, high = sorted((top(i), top(j)))
                parent[high] = low
    assert ids(single) == sorted({top(i) for i in parent})

    split = lambda text: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    windows = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        words = split(r["text"])
        windows |= {tuple(words[i : i + 13]) for i in range(max(1, len(words) - 12))} if words else set()

    def contaminated(text):
        words, hit = split(text), set()
        for n in {len(w) for w in windows}:
            for at in range(len(words) - n + 1):
                if tuple(words[at : at + n]) in windows:
                    hit.update(range(at, at + n))
        return bool(hit) and 20 * len(hit) >= len(words)

    assert ids(clean) == ids(r for r in single if not contaminated(r["text"]))

    mix = {r["doc_id"]: r for r in mixing.mix_sources(spark.read.parquet(f"{tmp_path}/2")).collect()}
    copies = Counter(r["doc_id"] for r in mixed)
    assert copies == {i: r["taken"] // r["size"] for i, r in mix.items() if r["taken"]}
    assert sorted(str(r) for r in {r["doc_id"]: r for r in mixed}.values()) == sorted(str(r) for r in clean if copies[r["doc_id"]])

    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    files = spark.read.parquet(f"{tmp_path}/3").select("doc_id", "text", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()
    expected, start = [], 0
    for r in files:  # in training order
        own = [*encoder.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        expected.append((r["doc_id"], start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert [tuple(r) for r in docs.orderBy("start").collect()] == expected
    places = spark.read.parquet(f"{tmp_path}/2")
    order = [r["doc_id"] for r in mixing.mix(places).orderBy("_position").select("doc_id").collect()]
    assert sorted(order) == sorted(r["doc_id"] for r in files) and sum(a == r["doc_id"] for a, r in zip(order, files)) > 0.95 * len(order)


def test_pipeline_on_odd_rows(spark, documents, odd_rows):
    docs = documents(odd_rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_pipeline_on_empty_tables(spark, documents, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0
