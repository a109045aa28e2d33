"""Helpers shared by the pipeline operators: shared storage, Arrow buffers and vectorised hashing."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.session import ship_package

CHUNK_BYTES = 1 << 20
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor see.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master, where all tasks run on this
    machine, may fall back to a temporary folder.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="trellis-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[app], ignore_errors=True)
    return "file://" + _LOCAL_DIRS[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage at a durable table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._trellis_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` of which every reader has been written to a later one."""
    for table in tables:
        spark, path = table.sparkSession, table._trellis_path
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Rows and bytes in an Arrow batch, each where the session has Spark's default: whole texts make large rows.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864", "16777216")}


def _release_memory() -> None:
    """Give freed memory back to the system: Python workers are reused by later stages, and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package importable on the executors, small batches and memory given back at the end."""
    spark = df.sparkSession
    ship_package(spark)
    for key, (default, bound) in BATCH.items():
        if spark.conf.get(key, default) in (default, "64MB"):
            spark.conf.set(key, bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _release_memory()

    return df.mapInArrow(run, schema)


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text (null: empty) under fixed names, whatever other columns ``docs`` has."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def hash_limit(share: float) -> int:
    """The 64-bit signed hash below or at which about this share of all hashes lies."""
    return min((1 << 63) - 1, int(-(1 << 63) + min(1.0, share) * ((1 << 64) - 1)))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about ``limit`` bytes; a longer row is alone in its chunk, and is never cut."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n``; kept in the worker up to a few MB."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 4096), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial Karp-Rabin hash of ``values``, modulo 2**64."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed Karp-Rabin hashes of the spans [start, end)."""
    inverse = powers(len(prefix), _INVERSE)
    raw = (prefix[ends] - prefix[starts]) * inverse[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def separator_table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(separators, dtype=np.uint8)] = True
    return table


def word_spans(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of non-separators; no run crosses a row."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separators[buf]
    begins = np.zeros(len(buf) + 1, dtype=bool)
    begins[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | begins[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def popcount(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
