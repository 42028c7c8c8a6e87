"""Near-duplicates by SimHash fingerprints and deletion-variant signatures.

Two fingerprints that differ in at most three bits differ in at most one bit
in one of their two halves.  Every half is therefore indexed as it is and with
each one of its bits left out; fingerprints that share such a variant meet in
an equality join and are verified bit by bit.  Where too many fingerprints
share a variant, their other bits are indexed in the same way, half by half.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, copied, free_name, with_fields, without, written
from .components import components

SHINGLE_WORDS = 3
MOST_BITS = 3
SEED = 42
# Fingerprints that share a variant and are joined directly; more are indexed further.
CELL_ROWS = 256
# Below this width the remaining bits bound a cell, so it is always joined.
LEAST_WIDTH = 8
CHUNK_BYTES = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_chunks(raw: bytes):
    """Lists of consecutive words, a bounded part of the text at a time."""
    at = 0
    while at < len(raw):
        m = SPACE.search(raw, at + CHUNK_BYTES)
        end = m.start() if m else len(raw)
        yield raw[at:end].split()
        at = end


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a whole text; 0 for a text without words."""
    from xxhash import xxh64_digest

    ones, count, kept = np.zeros(64, np.int64), 0, []

    def add(shingles):
        nonlocal ones, count
        for i in range(0, len(shingles), 8192):
            part = b"".join([xxh64_digest(s, SEED) for s in shingles[i:i + 8192]])
            bits = np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.uint32)
        count += len(shingles)

    for more in word_chunks((text or "").encode().lower()):
        kept += more
        if len(kept) < words:
            continue
        joined = b" ".join(kept)
        ends = np.cumsum(np.fromiter(map(len, kept), np.int64, len(kept)) + 1) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        add([joined[a:z] for a, z in zip(starts, ends[words - 1:].tolist(), strict=False)])
        kept = kept[len(kept) - words + 1:]
    if not count and kept:
        add([b" ".join(kept)])
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big") if count else 0


def with_simhash(docs: DataFrame, name: str, text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """Add the fingerprint of the text as a bigint column."""
    def add(batches):
        for batch in by_bytes(batches, text_col):
            prints = [simhash(t, words) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(prints, np.uint64).view(np.int64))],
                names=[*batch.schema.names, name])

    return docs.mapInArrow(add, with_fields(docs, **{name: T.LongType()}))


def variants(rows: DataFrame, width: int) -> DataFrame:
    """Index two segments of ``width`` bits that begin at bit ``at`` of ``print``.

    Rows (cell, print, at) give (cell, print, at, side): a cell for each
    segment as it is (side 2) and with each bit left out (side: that bit).
    ``at`` becomes the start of the other segment.
    """
    step = width + 1
    start = F.col("at") + F.when(F.col("k") >= step, width).otherwise(0)
    value = F.expr("shiftrightunsigned(print, start)").bitwiseAND(F.lit((1 << width) - 1))
    bit = F.expr("shiftleft(1L, j)")
    whole = F.col("j") == width
    return (
        rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2 * step - 1))))
        .withColumn("j", (F.col("k") % step).cast("int")).withColumn("start", start.cast("int"))
        .withColumn("value", value)
        .withColumn("side", F.when(whole, 2).when(F.col("value").bitwiseAND(bit) != 0, 1).otherwise(0))
        .withColumn("value", F.when(whole, F.col("value")).otherwise(F.col("value").bitwiseAND(F.bitwise_not(bit))))
        .select(F.xxhash64("cell", "k", "value").alias("cell"), "print",
                F.when(F.col("k") >= step, F.col("at")).otherwise(F.col("at") + width).cast("int").alias("at"), "side"))


def near_pairs(prints: DataFrame, most_bits: int = MOST_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in at most ``most_bits`` bits.

    prints: one distinct bigint column ``print``.  ``most_bits`` is 3 at most,
    so that one of two segments differs in at most one bit.  A cell gives at
    most ``cell_rows`` partners a row, or what the last bits allow.
    """
    if not 0 <= most_bits <= 3:
        raise ValueError("most_bits must be from 0 to 3")
    rows, width, found = prints.select(F.lit(0).cast("long").alias("cell"), "print", F.lit(0).alias("at")), 32, None
    while True:
        index = variants(rows, width)
        cells = index.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("side").alias("low"), F.max("side").alias("high"))
        # a variant with a bit left out pairs the rows with that bit and those without
        cells = written(cells.filter("n > 1 and (high = 2 or low < high)").select("cell", "n"), "cells")
        met = written(index.join(cells, "cell"), "met")
        final = width <= LEAST_WIDTH
        near = met if final else met.filter(F.col("n") <= cell_rows)
        left = near.filter("side != 1").select("cell", F.col("print").alias("a"), F.col("side").alias("l"))
        right = near.filter("side != 0").select("cell", F.col("print").alias("b"), F.col("side").alias("r"))
        differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
        pairs = left.join(right, "cell").filter(
            (differ <= most_bits) & (F.col("l") == F.col("r")) & (F.col("a") < F.col("b"))
            | (differ <= most_bits) & (F.col("l") != F.col("r")) & (F.col("a") != F.col("b")))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        found = pairs if found is None else found.unionByName(pairs)
        hot = None if final else met.filter(F.col("n") > cell_rows).select("cell", "print", "at")
        if hot is None or not hot.limit(1).count():
            return found.distinct()
        rows, width = hot, width // 2


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                most_bits: int = MOST_BITS, print_col: str | None = None, row_col: str | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept, print, row) of every row.

    fingerprint: 16 hex digits; null and empty texts have zeros and link like
    others.  component_id: the smallest id reachable over fingerprints that
    differ in at most ``most_bits`` bits.  One row of a component is kept: its
    smallest id's, and of rows that repeat that id the first; null ids come
    last.  ``print_col`` and ``row_col`` name the fingerprint and a unique
    bigint where the caller has them.  Other columns are not read; an empty
    table gives no rows.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).alias("doc_id"), row.alias("row"),
                       *([F.col(print_col).alias("print")] if print_col else [F.col(text_col).alias("text")]))
    if not print_col:
        rows = written(with_simhash(rows, "print", "text", words).drop("text"), "prints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    prints = written(rows.groupBy("print").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")), "prints")
    linked = components(near_pairs(prints.select("print"), most_bits))
    joined = linked.join(prints, F.col("node") == F.col("print"))
    heads = written(joined.groupBy("component").agg(F.min("first").alias("head")), "heads")
    shared = joined.select("print", "component").join(heads, "component").select("print", "head")
    copied = prints.filter("n > 1").join(linked.select(F.col("node").alias("print")), "print", "left_anti")
    heads = written(shared.unionByName(copied.select("print", F.col("first").alias("head"))), "heads")
    told = rows.join(heads, "print", "left")
    return told.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (F.col("head").isNull() | (F.col("head.row") == F.col("row"))).alias("kept"), "print", "row")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, with all their columns, whatever these are called.

    One row of each group stays, also where rows repeat; null texts are
    empty.  An empty table gives no rows.
    """
    row, mark = free_name(docs, "row"), free_name(docs, "print")
    rows = copied(with_simhash(docs.withColumn(row, F.monotonically_increasing_id()), mark, text_col, words))
    told = near_groups(rows, id_col, text_col, words, most_bits, mark, row)
    dropped = written(told.filter("not kept").select(F.col("row").alias(row), F.col("print").alias(mark)), "dropped")
    return without(rows, row, mark, dropped).select(docs.columns)
