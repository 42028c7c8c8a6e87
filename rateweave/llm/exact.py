"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Each task cuts its rows into runs.  A run sends its distinct fingerprints,
sorted and Golomb-coded, to the owners of their ranges; an owner answers every
run with a bitmap of the fingerprints that other runs hold too.  Only rows
whose fingerprint repeats are suspects: their texts alone are shuffled, as
grouping keys, so that equal means equal bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, by_prefix, copied, free_name, without, written

# Leading bits of the 64-bit fingerprint that are exchanged.
BITS = 48
RUN_ROWS = 1 << 16
# Documents for which one owner answers, and the fewest owners.
OWNER_DOCS = 2_000_000
LEAST_OWNERS = 8


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """(remainder bits, code) of sorted distinct unsigned numbers.

    The gaps are coded with a power of two as parameter: all quotients in
    unary, then all remainders.
    """
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    low = max(0, int(np.log2(max(float(gaps.mean()) * 0.6931, 1.0))))
    quotients = (gaps >> np.uint64(low)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(low, dtype=np.uint64)
    remainders = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return low, np.packbits(unary).tobytes() + np.packbits(remainders).tobytes()


def golomb_decode(count: int, low: int, code: bytes) -> np.ndarray:
    """The numbers coded by ``golomb_encode``."""
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    ends = np.flatnonzero(bits == 0)[:count]
    quotients = np.diff(ends, prepend=-1) - 1
    start = (int(ends[-1]) // 8 + 1) * 8 if count else 0
    remainders = bits[start:start + count * low].reshape(count, low).astype(np.uint64)
    gaps = (quotients.astype(np.uint64) << np.uint64(low)) + (
        remainders << np.arange(low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def exchanged(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct sorted fingerprints, each row's index among them, counts), cut to BITS."""
    return np.unique(prints.view(np.uint64) >> np.uint64(64 - BITS), return_inverse=True, return_counts=True)


def owner_starts(owners: int) -> np.ndarray:
    """The first fingerprint of each owner's range."""
    return np.array([(k << BITS) // owners for k in range(owners + 1)], np.uint64)


def runs_of(rows: DataFrame, print_col: str) -> DataFrame:
    """(run, items, prints): the rows of each task in runs of at most RUN_ROWS."""
    item = T.StructType(rows.schema.fields)
    schema = T.StructType([T.StructField("run", T.LongType()), T.StructField("items", T.ArrayType(item)),
                           T.StructField("prints", T.BinaryType())])

    def cut(batches):
        from pyspark import TaskContext

        run, held, count = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            items = pa.StructArray.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns], table.column_names)
            prints = table.column(print_col).to_numpy().astype("<i8").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([run], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items),
                 pa.array([prints], pa.binary())], names=["run", "items", "prints"])

        for batch in batches:
            while len(batch):
                part = batch.slice(0, RUN_ROWS - count)
                held.append(part)
                count += len(part)
                batch = batch.slice(len(part))
                if count == RUN_ROWS:
                    yield flush()
                    run, held, count = run + 1, [], 0
        if count:
            yield flush()

    return rows.mapInArrow(cut, schema)


def suspects_of(runs: DataFrame, owners: int) -> DataFrame:
    """The rows of the runs, flat, with ``suspect``: its fingerprint occurs in another row."""
    starts = owner_starts(owners)

    def send(batches):
        for batch in batches:
            for run, raw in zip(batch.column("run").to_pylist(), batch.column("prints").to_pylist(), strict=True):
                values, _, _ = exchanged(np.frombuffer(raw, "<i8"))
                cut = np.searchsorted(values, starts)
                to = [k for k in range(owners) if cut[k] < cut[k + 1]]
                codes = [golomb_encode(values[cut[k]:cut[k + 1]] - starts[k]) for k in to]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), pa.array([run] * len(to), pa.int64()),
                     pa.array([int(cut[k + 1] - cut[k]) for k in to], pa.int32()),
                     pa.array([low for low, _ in codes], pa.int32()), pa.array([code for _, code in codes], pa.binary())],
                    names=["owner", "run", "count", "low", "code"])

    def answer(table: pa.Table) -> pa.Table:
        sent = [golomb_decode(n, low, code) for n, low, code in zip(
            *(table.column(c).to_pylist() for c in ("count", "low", "code")), strict=True)]
        values, counts = np.unique(np.concatenate(sent), return_counts=True)
        again = values[counts > 1]
        found = [np.packbits(np.isin(v, again, assume_unique=True)).tobytes() for v in sent]
        return pa.table({"run": table.column("run"), "owner": table.column("owner"), "count": table.column("count"),
                         "bits": pa.array(found, pa.binary())})

    messages = runs.select("run", "prints").mapInArrow(
        send, "owner int, run long, count int, low int, code binary")
    answers = messages.groupBy("owner").applyInArrow(answer, "run long, owner int, count int, bits binary")
    answers = answers.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("owner", "count", "bits"))).alias("answers"))
    flat = T.StructType([*runs.schema["items"].dataType.elementType.fields, T.StructField("suspect", T.BooleanType())])

    def mark(batches):
        for batch in batches:
            items = batch.column("items")
            for k, (raw, told) in enumerate(zip(batch.column("prints").to_pylist(), batch.column("answers").to_pylist(), strict=True)):
                _, place, counts = exchanged(np.frombuffer(raw, "<i8"))
                away = np.concatenate([np.unpackbits(np.frombuffer(t["bits"], np.uint8), count=t["count"]) for t in told])
                suspect = ((counts > 1) | (away > 0))[place]
                rows = items.slice(k, 1).flatten()
                yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.array(suspect)], names=flat.names)

    return runs.join(answers, "run").select("items", "prints", "answers").mapInArrow(mark, flat)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 row_col: str | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, fingerprint, row) of every row.

    Texts are equal when the same after lower-casing A-Z; null is empty.  Of
    equal texts the row with the largest id is kept, null ids last; of rows
    that repeat that id too, the first.  ``row_col`` names a unique bigint of
    the caller's, given back as ``row``; otherwise rows are numbered here.
    Other columns are not read.  An empty table gives no rows.
    """
    text = ascii_lower(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), F.xxhash64(text).alias("fingerprint"),
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"))
    runs = written(runs_of(rows, "fingerprint"), "runs")
    n = runs.agg(F.coalesce(F.sum(F.size("items")), F.lit(0))).first()[0]
    marked = written(suspects_of(runs, max(LEAST_OWNERS, -(-n // OWNER_DOCS))), "marked")
    suspects = marked.filter("suspect").drop("suspect")

    texts = docs.select(text.alias("text")).withColumn("fingerprint", F.xxhash64("text"))
    texts, _ = by_prefix(texts, "fingerprint", suspects.select("fingerprint"))
    equal = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select(
        F.sha2("text", 256).alias("text_sha256"), "copies")
    groups = suspects.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("doc_id", (-F.col("row")).alias("row"))).alias("top"))
    # a digest stands for its text: each digest has one text and as many copies as rows
    differs = F.raise_error(F.lit("different texts with equal SHA-256 digests"))
    groups = written(groups.join(equal, "text_sha256").select(
        "text_sha256", F.when(F.col("group_size") == F.col("copies"), F.col("group_size"))
        .otherwise(differs.cast("long")).alias("group_size"),
        F.col("top.doc_id").alias("keep_id"), (-F.col("top.row")).alias("keep_row")), "groups")

    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256", "fingerprint", "row")
    grouped = suspects.join(groups, "text_sha256").withColumn("kept", F.col("row") == F.col("keep_row"))
    alone = marked.filter("not suspect").withColumns(
        {"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    return grouped.select(*names).unionByName(alone.select(*names))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns, whatever these are called.

    One row of each text stays, also where rows repeat it with its id; null
    texts are empty, null ids last.  An empty table gives no rows.
    """
    row, mark = free_name(docs, "row"), free_name(docs, "fingerprint")
    rows = copied(docs.withColumns({
        row: F.monotonically_increasing_id(), mark: F.xxhash64(ascii_lower(F.col(text_col)))}))
    dropped = written(exact_groups(rows, id_col, text_col, row).filter("not kept").select(
        F.col("row").alias(row), F.col("fingerprint").alias(mark)), "dropped")
    return without(rows, row, mark, dropped).select(docs.columns)
