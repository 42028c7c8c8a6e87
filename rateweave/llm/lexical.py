"""Ranked lexical search by NRA over impact-sorted lists.

The queries are taken in blocks with a bounded number of (query, term) pairs.
For a block every document is read whole once; what remains of it is its
length and the counts of the block's terms, written as a table.  The counts of
documents, terms and documents per term are sums over that table.  Documents
are then dealt, as they lie, into shards.  A shard sorts its postings of each
term by impact, and a query reads the lists of its terms from the top, all at
once and in growing steps.  Each document seen has a lower bound, what was
read of it, and an upper bound, that plus the next impact of each list in
which it was not met.  Reading ends when no document whose interval is still
open could be among the best or tie with them.  The bests of all shards are
then ranked together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, give_back, written

TOP = 10
# (query, term) pairs of a block; a longer query is a block of its own.
BLOCK_PAIRS = 500_000
# Documents and postings of a shard, at most (one document may have more).
SHARD_DOCS = 1 << 15
SHARD_POSTINGS = 4_000_000
# Postings first read of each list; every further read is four times as long.
FIRST_READ = 64
UNIT = 1_000_000_000

# Bytes of words stay, A-Z as a-z; all others part words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term, times): the distinct terms of each row of ``items``, which ``item`` numbers."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def split(batches):
        for batch in by_bytes(batches, "text"):
            whose, terms, times = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                found: dict[bytes, int] = {}
                for term in terms_of(text):
                    found[term] = found.get(term, 0) + 1
                whose += [row] * len(found)
                terms += found.keys()
                times += found.values()
            at = pa.array(whose, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(at), batch.column("item_id").take(at), pa.array(terms, pa.binary()),
                 pa.array(times, pa.int64())], names=["item", "item_id", "term", "times"])

    return rows.mapInArrow(split, T.StructType([
        rows.schema["item"], rows.schema["item_id"], T.StructField("term", T.BinaryType()), T.StructField("times", T.LongType())]))


def postings_of(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, counts) of the rows with a term; terms: numbers in the vocabulary."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches):
        known = vocabulary.get
        for batch in by_bytes(batches, "text"):
            kept, sizes, terms, counts, starts = [], [], [], [], [0]
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                number, times = np.unique(np.fromiter((known(w, -1) for w in words), np.int32, len(words)), return_counts=True)
                if number[0] < 0:
                    number, times = number[1:], times[1:]
                kept.append(row)
                sizes.append(len(words))
                terms.append(number)
                counts.append(times)
                starts.append(starts[-1] + len(number))
            ends = pa.array(starts, pa.int32())
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(flat[0], pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(flat[1], pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])

    return rows.mapInArrow(count, T.StructType([
        rows.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.LongType()))]))


def best(lists: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``top`` best with a score above 0, by score and then ``order``.

    lists: for each term (documents, parts of the score, from the largest), a
    document once in a list.  ``order`` ranks the documents among equals.
    """
    lower = np.zeros(len(order), np.int64)
    read, step = [0] * len(lists), FIRST_READ
    while True:
        nexts = []
        for k, (docs, parts) in enumerate(lists):
            end = min(read[k] + step, len(docs))
            lower[docs[read[k]:end]] += parts[read[k]:end]
            read[k] = end
            nexts.append(int(parts[end]) if end < len(docs) else 0)
        step *= 4
        # what a document may still get: the next part of each list it was not met in
        more = np.full(len(order), sum(nexts), np.int64)
        for (docs, _), end, part in zip(lists, read, nexts, strict=True):
            if part:
                more[docs[:end]] -= part
        least = max(1, int(np.partition(lower, -top)[-top]) if len(lower) > top else 1)
        if not ((more > 0) & (lower + more >= least)).any():
            break
    found = np.flatnonzero(lower >= least)
    found = found[np.lexsort((order[found], -lower[found]))][:top]
    return found, lower[found]


def shard_bests(shard: pa.Table, queries: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, n_terms: int,
                top: int) -> tuple[list[np.ndarray], list[np.ndarray], list[int]]:
    """(rows, scores, items) of the best of one shard; queries: (item, terms, weights)."""
    n = shard.column("n").to_numpy()
    # Python's numbers where 64 bits might not hold the product
    norm = (75 * n * n_docs // n_terms if int(n.max()) < (1 << 62) // (75 * n_docs)
            else np.array([75 * int(x) * n_docs // n_terms for x in n], np.int64)) + 25
    lists = [shard.column(c).combine_chunks() for c in ("terms", "counts")]
    term, count = (x.flatten().to_numpy() for x in lists)
    doc = np.repeat(np.arange(len(n)), lists[0].value_lengths().to_numpy())
    impact = UNIT * count // (1000 * count + 8 * norm[doc])
    by_impact = np.lexsort((-impact, term))
    term, doc, impact = term[by_impact], doc[by_impact], impact[by_impact]
    order = pc.rank(shard.column("doc_id").combine_chunks(), sort_keys="ascending", null_placement="at_end",
                    tiebreaker="first").to_numpy().astype(np.int64)
    rows, scores, items = [], [], []
    for item, terms, weights in queries:
        start, end = np.searchsorted(term, terms), np.searchsorted(term, terms, "right")
        found, score = best([(doc[a:z], w * impact[a:z]) for a, z, w in zip(start, end, weights, strict=True) if a < z and w > 0],
                            order, top)
        rows.append(found)
        scores.append(score)
        items += [item] * len(found)
    return rows, scores, items


def candidates(postings: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, n_terms: int,
               top: int) -> DataFrame:
    """(item, doc_id, score): the best of every shard."""
    schema = T.StructType([T.StructField("item", T.LongType()), postings.schema["doc_id"], T.StructField("score", T.LongType())])

    def search(batches):
        held, docs, entries = [], 0, 0

        def flush():
            shard = pa.Table.from_batches(held)
            rows, scores, items = shard_bests(shard, queries, n_docs, n_terms, top)
            if items:
                ids = shard.column("doc_id").combine_chunks().take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), ids, pa.array(np.concatenate(scores))],
                                                 names=schema.names)

        for batch in batches:
            while len(batch):
                sizes = np.cumsum(batch.column("terms").value_lengths().to_numpy())
                take = min(SHARD_DOCS - docs, int(np.searchsorted(sizes, SHARD_POSTINGS - entries, "right")))
                if not held:
                    take = max(take, 1)
                if take:
                    held.append(batch.slice(0, take))
                    docs, entries = docs + take, entries + int(sizes[take - 1])
                if take < len(batch):
                    yield from flush()
                    held, docs, entries = [], 0, 0
                batch = batch.slice(take)
        if held:
            yield from flush()
        give_back()

    return postings.mapInArrow(search, schema)


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", top: int = TOP,
                   block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item, or all above 0 if fewer.

    Every row of ``items`` is a query and every row of ``docs`` a document, so
    repeated ids are ranked each for itself.  Of equal scores the smaller
    doc_id comes first, a null id last.  Null and empty texts have no terms;
    an item without terms, without matches, or over an empty table gives no
    rows.  Texts are read whole; other columns are not read.
    """
    pairs = written(query_terms(items, item_col, item_text_col), "query-terms")
    blocks = max(1, -(-pairs.count() // block_pairs))
    results = []
    for block in range(blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "term").toArrow()
        vocabulary = {term: k for k, term in enumerate(pc.unique(own.column("term")).to_pylist())}
        postings = written(postings_of(docs, vocabulary, id_col, text_col), "postings")
        n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
        df[held.column("term").to_numpy()] = held.column("df").to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        whose, number = own.column("item").to_numpy(), np.array([vocabulary[t] for t in own.column("term").to_pylist()], np.int32)
        times, cut = own.column("times").to_numpy(), np.flatnonzero(np.diff(whose, prepend=-1, append=-1))
        queries = [(int(whose[a]), number[a:z], times[a:z] * weight[number[a:z]]) for a, z in zip(cut[:-1], cut[1:], strict=True)]
        found = candidates(postings, queries, n_docs, n_terms, top)
        results.append(found if blocks == 1 else written(found, "bests"))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    names = pairs.select("item", "item_id").distinct()
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= top).join(
        names, "item").select("item_id", "rank", "doc_id", "score")
