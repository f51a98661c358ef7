"""Helpers shared by the operators: tables, shared storage, bounded batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most text bytes that one Python step holds at a time (a longer single text goes alone).
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, from ``spark.checkpoint.dir``.

    A temporary folder of this machine serves only local sessions that name none.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="holdfast-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/holdfast-{name}-{uuid.uuid4().hex}"


#: Paths of the tables written in each open ``scratch`` block, the innermost last.
_OPEN: list[list[str]] = []


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    if path is None:
        path = new_path(spark, name)
        if _OPEN:
            _OPEN[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    # shuffle files go when the plan that wrote them is collected
    spark._jvm.java.lang.System.gc()
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables that are materialized in the block at its end, but for those handed to what it yields."""
    own: list[str] = []
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        files = df.inputFiles()
        kept.extend(path for path in own if not files or any(path.rsplit("/", 1)[1] in f for f in files))
        return df

    _OPEN.append(own)
    try:
        yield keep
    finally:
        _OPEN.remove(own)
        if _OPEN:
            _OPEN[-1].extend(kept)
        for path in own:
            if path not in kept:
                remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written folder on whatever file system holds it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


#: What operators keep in a Python worker from task to task, by key.
KEPT: list[dict] = []


def drop_kept(own: dict | None = None) -> None:
    """At the start of a task: what other operators than the ``own`` keep in this worker goes, and its memory with it."""
    others = [kept for kept in KEPT if kept is not own]
    if any(others):
        for kept in others:
            kept.clear()
        gc.collect()
        release()


def release() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, which leaves an idle worker without what its task has freed."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def row_hash(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A hash that spreads rows even where many ids are null."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the column's bytes stay under ``limit`` in each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words_of(column: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """All words `[^\\x20\\x09-\\x0D]+` of the texts, as binary, and the number in each text (null: none)."""
    texts = pc.fill_null(column.cast(pa.string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():  # leading and trailing white space give empty pieces
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[full], minlength=len(counts)).astype(np.int64)
        flat = flat.filter(pa.array(full))
    return flat, counts


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + sizes[i] - 1 for each i in turn."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    while base in df.columns:
        base = f"_{base}"
    return base
