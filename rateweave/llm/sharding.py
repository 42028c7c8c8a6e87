"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A row's shard follows from its key and the number of shards alone.  When one
shard is appended, a row either stays or moves into the new shard, so only
about 1/(shards + 1) of the rows move; no ring table is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_fields, written

STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key among ``shards`` shards."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = keys.astype(np.uint64, copy=True)
    last = np.zeros(len(key), np.int64)
    todo = np.arange(len(key))
    here = np.full(len(key), -1, np.int64)
    ahead = np.zeros(len(key), np.int64)
    while len(todo):
        here, last[todo] = ahead, ahead
        k = key[todo] * STEP + np.uint64(1)
        key[todo] = k
        ahead = ((here + 1) * (2147483648.0 / ((k >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        more = ahead < shards
        todo, ahead = todo[more], ahead[more]
    return last


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard) of every row.

    size: UTF-8 bytes of the text plus 8, a null text has none.  slot numbers
    the rows of a shard without gaps from 0.  grown_shard: the shard with one
    shard more.  Equal ids share a shard, as do all rows with a null id.
    Repeated rows get slots of their own; columns other than id and text are
    not read; an empty table gives no rows.

    Nothing but the digests moves: each task numbers its own rows by shard,
    and a table with one row per (task, shard) carries the numbers on.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.col(id_col)).alias("key"))

    def place(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            shard = jump_hash(key, shards)
            order = np.argsort(shard, kind="stable")
            count = np.bincount(shard, minlength=shards)
            local = np.empty(len(shard), np.int64)
            local[order] = np.arange(len(shard)) - np.repeat(np.cumsum(count) - count, count)
            local += seen[shard]
            seen += count
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard.astype(np.int32)),
                 pa.array(jump_hash(key, shards + 1).astype(np.int32)),
                 pa.array(np.full(len(shard), task, np.int32)), pa.array(local)],
                names=[*batch.schema.names, "shard", "grown_shard", "task", "local"])

    schema = with_fields(narrow, shard=T.IntegerType(), grown_shard=T.IntegerType(),
                         task=T.IntegerType(), local=T.LongType())
    placed = written(narrow.mapInArrow(place, schema), "shards")
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = placed.groupBy("task", "shard").agg(F.count(F.lit(1)).alias("n")).select(
        "task", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, ["task", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("start") + F.col("local")).alias("slot"), "grown_shard")
