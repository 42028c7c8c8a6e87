"""How filters interact: what each removes, in any order, alone or with others.

Documents are counted by part and by the set of filters that they fail, so a
part has at most 2**k cells for k filters.  A Gray-code walk over the subsets
of filters toggles one at a time and keeps, for each cell, how many of its
failed filters are switched on, and the running survivors.  The survivors of
every subset are stored; each step of each order is the difference of two.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, written

# The states of a part are 2**k and its orders k!.
MOST_FILTERS = 8
# Documents of a cell, those labelled good, those labelled toxic.
MEASURES = ("n", "good", "toxic")
SPECIAL = "[#$%&*|]"


def text_filters(text: Column) -> dict[str, Column]:
    """The conditions on a text under which filters A to D fail (E is about other texts)."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike(SPECIAL),
    }


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask): per row the part and the bits of the filters A to E that it fails.

    Null texts are empty.  E fails if a smaller id has the same text anywhere;
    a null id is neither smaller nor larger than any, and rows that repeat id
    and text are not smaller than each other.  Texts are told by SHA-256.
    Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("doc_id"),
                         F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    checks = text_filters(F.col("text"))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(checks.values())), F.lit(0))
    rows = written(source.select("doc_id", "part", mask.alias("mask"),
                                 F.unhex(F.sha2("text", 256)).alias("print")), "masks")
    # one row per text that more than one row has; both inputs of the join are
    # plain exchanges, so that a text with very many copies can be split
    firsts = written(rows.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
                     .filter("copies > 1").drop("copies"), "firsts")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(firsts, "print", "left").select(
        "doc_id", "part", (F.col("mask") + F.when(later, 1 << len(checks)).otherwise(0)).alias("mask"))


def cells_of(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic) from rows (doc_id, part, mask).

    A row is good or toxic if any label of its id says 1; a null id has none.
    """
    marked = written(labels.groupBy(F.col(id_col).alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).filter("good = 1 or toxic = 1"), "marked")
    return failed.join(marked, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.coalesce(F.sum(F.col(x).cast("long")), F.lit(0)).alias(x) for x in ("good", "toxic")))


def survivors(masks: np.ndarray, counts: np.ndarray, filters: int) -> np.ndarray:
    """[subset, measure]: what is left when the filters of each subset are on.

    masks: the failed filters of each cell; counts: [cell, measure].
    """
    states = np.zeros((1 << filters, counts.shape[1]), np.int64)
    active = np.zeros(len(masks), np.int64)
    left = counts.sum(axis=0)
    states[0] = left
    on = 0
    for step in range(1, 1 << filters):
        k = (step & -step).bit_length() - 1  # the bit in which this Gray code differs from the last
        failing = (masks >> k & 1).astype(bool)
        on ^= 1 << k
        if on >> k & 1:
            left = left - counts[failing & (active == 0)].sum(axis=0)
            active[failing] += 1
        else:
            active[failing] -= 1
            left = left + counts[failing & (active == 0)].sum(axis=0)
        states[on] = left
    return states


def shapley(states: np.ndarray, filters: int) -> list[int]:
    """What each filter removes, summed over all orders of the filters, at any step."""
    total = [0] * filters
    for subset in range(1 << filters):
        size = subset.bit_count()
        orders = math.factorial(size) * math.factorial(filters - size - 1) if size < filters else 0
        for k in range(filters):
            if not subset >> k & 1:
                total[k] += orders * int(states[subset, 0] - states[subset | 1 << k, 0])
    return total


def audit(cells: DataFrame, names: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, from ``cells_of``'s rows.

    names: a letter for each bit of the mask, at most MOST_FILTERS.  A part is
    whatever occurs in ``cells``; no cells give no rows.
    """
    if not 0 < len(names) <= MOST_FILTERS or len(set(names)) != len(names):
        raise ValueError(f"1 to {MOST_FILTERS} different letters are needed")
    k = len(names)
    numbers = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
                           T.StructField("step", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in numbers)])

    def walk(table: pa.Table) -> pa.Table:
        masks = table.column("mask").to_numpy()
        counts = np.stack([table.column(x).to_numpy() for x in MEASURES], axis=1)
        states, part = survivors(masks, counts, k), table.column("part")[0].as_py()
        fails = [int(counts[masks >> b & 1 == 1, 0].sum()) for b in range(k)]
        alone = [int(counts[masks == 1 << b, 0].sum()) for b in range(k)]
        share = shapley(states, k)
        rows = []
        for order in itertools.permutations(range(k)):
            on, name = 0, "".join(names[b] for b in order)
            for step, b in enumerate(order, 1):
                lost = states[on] - states[on | 1 << b]
                on |= 1 << b
                rows.append((part, name, step, int(states[on, 0]), int(lost[0]), fails[b] - int(lost[0]),
                             alone[b], int(lost[1]), int(lost[2]), share[b]))
        return pa.table(dict(zip(schema.names, zip(*rows, strict=True), strict=True))).cast(
            pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                       *((x, pa.int64()) for x in numbers)]))

    return cells.groupBy("part").applyInArrow(walk, schema)


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    For every value of ``part_col`` (null: the empty string) and each of the
    120 orders of A to E, five rows, zeros included.  Null and empty texts,
    null and repeated ids: see ``failures``; repeated rows count as often as
    they occur, repeated labels of an id once.  Texts are read whole, other
    columns not at all.  An empty table gives no rows.
    """
    return audit(cells_of(failures(docs, id_col, text_col, part_col), labels, id_col))
