"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies, its
source's target over its source's size.  The expected copies are summed along
the source in order of size, one offset is added, and a copy is emitted for
every integer boundary a document crosses.  Neighbours in that order have
nearly equal sizes, so the words taken differ from the target by little more
than the largest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, copied, free_name, written

# A source supplies at most so many times its own size.
MOST_COPIES = 3
# Weights of the sources in code point order, null last, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def rank_in(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: the 1-based rank of a row among those with equal ``groups``.

    Range partitions over (groups, order) keep a group that holds most rows in
    many tasks; a table with one row per (task, group) carries the counts on.
    Null groups form a group of their own.
    """
    task, local, start = (free_name(df, x) for x in ("task", "local", "start"))
    keys = [*groups, *order]
    inside = Window.partitionBy(task, *groups).orderBy(*order)
    ranged = written(df.repartitionByRange(*keys).withColumn(task, F.spark_partition_id()), "ranged")
    ranked = ranged.withColumn(local, F.row_number().over(inside))
    before = Window.partitionBy(*groups).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(task, *groups).agg(F.count(F.lit(1)).alias(start)).select(
        F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start),
        *(F.col(c).alias("of_" + c) for c in (task, *groups)))
    cond = F.lit(True)
    for c in (task, *groups):
        cond = cond & F.col(c).eqNullSafe(F.col("of_" + c))
    return ranked.join(starts, cond).select(*df.columns, (F.col(local) + F.col(start)).alias(name))


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    The weights share the total size; a target stops at MOST_COPIES times its
    source's size and the excess is reshared by weight among the others, until
    none is above.  Each round is one aggregate over the sources.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("last", F.col("source").isNull().cast("int")).withColumn(
        "all", F.lit(0))
    ranked = rank_in(sources, ["all"], ["last", "source"], "rank")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    table = written(ranked.withColumn("weight", weight.cast("long")), "sources")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    most = F.col("source_size") * MOST_COPIES
    left, weights, capped = total, None, F.lit(False)
    while True:
        fixed, weights = table.agg(
            F.coalesce(F.sum(F.when(capped, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))).first()
        left = total - fixed
        if not weights:
            break
        share = F.lit(float(left)) * F.col("weight") / F.lit(float(weights))
        over = capped | (share > most)
        if not table.filter(over & ~capped).limit(1).count():
            break
        capped = over
    target = most.cast("double") if not weights else F.when(capped, most.cast("double")).otherwise(share)
    return table.select("source", "source_size", target.alias("target"))


def offset_of(source: Column) -> Column:
    """The one offset in [0, 1) of a source, from a digest of its name."""
    digest = F.md5(F.concat(F.lit(SEED), F.coalesce(F.concat(F.lit("/"), source), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken, keep...) of every row.

    size: words of the text, 0 for null or empty.  A document is taken
    ``copies`` times, 0 to MOST_COPIES.  Ties in size go by id; rows with a
    null id come first; repeated rows are sampled apart; a source without
    words takes nothing.  Columns other than those named are not read.  An
    empty table gives no rows.
    """
    sized = written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), *keep), "sizes")
    ranked = rank_in(sized, ["source"], ["size", "doc_id"], "rank")
    targets = source_targets(sized)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    reached = lambda n: F.floor(n * F.col("rate") + F.col("offset"))
    return (
        ranked.join(targets.withColumnRenamed("source", "of"), ranked.source.eqNullSafe(F.col("of")))
        .withColumn("rate", rate).withColumn("offset", offset_of(F.col("source")))
        .withColumn("copies", (reached(F.col("rank")) - reached(F.col("rank") - 1)).cast("int"))
        .select("doc_id", "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"), *keep))


def resample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` with all their columns, whatever these are called, each as often as the mix takes it.

    Repeated rows are taken each for itself; nulls and ties: see
    ``mix_sources``.  An empty table gives no rows.
    """
    row, times = free_name(docs, "row"), free_name(docs, "times")
    rows = copied(docs.withColumn(row, F.monotonically_increasing_id()))
    taken = mix_sources(rows, id_col, text_col, source_col, keep=(row,)).filter("copies > 0").select(
        row, F.col("copies").alias(times))
    return rows.join(taken, row).withColumn(
        times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(docs.columns)
