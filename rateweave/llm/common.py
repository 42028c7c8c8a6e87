"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import fresh_path
from ..sources.versioned import materialize

# Words are maximal runs without these characters (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A broadcast of key prefixes has at most 2**PREFIX_BITS rows, whatever the input.
PREFIX_BITS = 20

written = materialize
# Where copies of whole tables are noted for whoever frees them, see ``noting``.
_copies: list[DataFrame] | None = None


def copied(df: DataFrame) -> DataFrame:
    """``written`` for a copy of a caller's whole table."""
    table = written(df, "copy")
    if _copies is not None:
        _copies.append(table)
    return table


@contextlib.contextmanager
def noting(tables: list[DataFrame]):
    """Note in ``tables`` the copies made meanwhile, to ``release`` once the results are written."""
    global _copies
    before, _copies = _copies, tables
    try:
        yield
    finally:
        _copies = before


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_fields(df: DataFrame, **kinds) -> StructType:
    """The schema of ``df`` followed by new fields (name=type)."""
    return StructType([*df.schema.fields, *(StructField(k, t) for k, t in kinds.items())])


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20,
             rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``limit`` bytes of ``column``.

    A single longer value still comes whole, alone in its slice.  (Spark
    itself fills a batch by rows: spark.sql.execution.arrow.maxRecordsPerBatch.)
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
        give_back()


def give_back() -> None:
    """Return memory that this Python worker has freed; it outlives its tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where there is no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


# With this setting a query's shuffle files go as soon as it has ended; otherwise
# they lie until the driver's JVM happens to collect the plan.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def setting(spark: SparkSession, values: dict[str, str]):
    """Settings of the session for the queries that run meanwhile, put back afterwards."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def in_buckets(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``written`` in buckets of ``key``, each task's rows as they lie; a join by it does not shuffle the table.

    ``release`` frees it.  The catalogue entry lasts as long as its session.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "buckets")
    name = "rateweave_" + path.rpartition("-")[2]
    df.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    out = spark.table(name)
    out.materialized_path = path
    return out


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % mod


def prefix_of(key: Column) -> Column:
    """The leading PREFIX_BITS of a bigint key."""
    return F.shiftrightunsigned(key, 64 - PREFIX_BITS)


def by_prefix(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows whose ``key`` may and rows whose ``key`` cannot be in ``keys``.

    Only the distinct key prefixes are broadcast: at most 2**PREFIX_BITS rows.
    The rows that cannot match are never shuffled.
    """
    name = free_name(df, "prefix")
    seen = F.broadcast(keys.select(prefix_of(F.col(keys.columns[0])).alias(name)).distinct())
    tagged = df.withColumn(name, prefix_of(F.col(key)))
    return (tagged.join(seen, name, "left_semi").drop(name),
            tagged.join(seen, name, "left_anti").drop(name))


def without(df: DataFrame, row: str, key: str, dropped: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``row`` id is not in ``dropped`` (columns row, key).

    Rows whose key prefix occurs among the dropped ones are shuffled for the
    exact anti join; all others pass straight through.
    """
    maybe, clear = by_prefix(df, key, dropped.select(key))
    return clear.unionByName(maybe.join(dropped.select(row), row, "left_anti").select(df.columns))
