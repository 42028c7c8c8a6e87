"""Near-duplicate vectors by quantised tile products with error bounds.

Vectors with the same label are dealt into tiles and these into strips, about
as many as a strip has tiles, so that a tile is sent to the square root of the
number of tiles and not to each.  A task multiplies the tiles of two strips,
pair by pair, as 8-bit codes; each vector's own quantisation error bounds how
far a product can be from the cosine, and only pairs that may reach the
threshold are computed again in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

THRESHOLD = 0.93
TILE = 1024
# The most tiles of a strip; a task holds two strips.
STRIP_TILES = 16
# Products of 8-bit codes over so many dimensions are exact in single precision.
EXACT_DIMS = 1024


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, error, norm) of double vectors: unit = codes * scale + rest, |rest| <= error.

    Components are below 1 in size and the largest at least a half, see ``even``.
    """
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    unit = vectors / norm[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rest = unit - codes * scale[:, None]
    return codes, scale, np.sqrt((rest * rest).sum(axis=1)) + 1e-9, norm


def even(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, without rounding: squares neither over- nor underflow."""
    vectors = vectors.astype(np.float64)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def near_in_tiles(a: np.ndarray, b: np.ndarray | None, threshold: float):
    """Index arrays (i, j), a block of rows at a time, of pairs with cosine >= threshold.

    With ``b`` None the pairs i < j within ``a``.
    """
    qa, sa, ea, na = quantised(a)
    qb, sb, eb, nb = (qa, sa, ea, na) if b is None else quantised(b)
    other = a if b is None else b
    codes = qb.astype(np.float32)
    for start in range(0, len(a), 256):
        rows = slice(start, start + 256)
        dots = np.zeros((len(qa[rows]), len(other)))
        for d in range(0, a.shape[1], EXACT_DIMS):
            dots += qa[rows, d:d + EXACT_DIMS].astype(np.float32) @ codes[:, d:d + EXACT_DIMS].T
        # |x.y - x'.y'| <= |x| |y - y'| + |x - x'| |y'| with |x| = 1 and |y'| <= 1 + |y - y'|
        bound = eb[None, :] + ea[rows, None] * (1 + eb[None, :]) + 1e-9
        i, j = np.nonzero(dots * sa[rows, None] * sb[None, :] + bound >= threshold)
        i += start
        if b is None:
            upper = i < j
            i, j = i[upper], j[upper]
        for k in range(0, len(i), 1 << 15):
            p, q = i[k:k + (1 << 15)], j[k:k + (1 << 15)]
            near = np.einsum("ij,ij->i", a[p], other[q]) / (na[p] * nb[q]) >= threshold
            yield p[near], q[near]


def hang(tree: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each node's smallest known node after also linking i with j."""
    while True:
        low = np.minimum(tree[i], tree[j])
        new = tree.copy()
        for at in (i, j, tree[i], tree[j]):
            np.minimum.at(new, at, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, tree):
            return tree
        tree = new


def near_links(classes: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(row, links, near) for each pair of strips: a vector's links there, and a node it reaches.

    classes: (row, copies, label, dim, vector), all unlike.  ``near`` spans
    the links that a pair of strips holds with one link a vector at most, so
    the output grows with the strips and not with the links.  Vectors travel
    in their own precision.
    """
    classes = written(classes, "classes")
    sizes = written(classes.groupBy("label", "dim").agg(
        F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")), "sizes")
    dealt = classes.join(sizes, ["label", "dim"]).withColumn(
        "tile", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int"))

    item = "<f4" if classes.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        first = {c: table.column(c).slice(0, 1) for c in ("label", "dim", "tiles", "tile")}
        data = np.concatenate(table.column("vector").to_pylist()).astype(item)
        return pa.table(first | {
            "rows": pa.array([table.column("row").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "copies": pa.array([table.column("copies").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "data": pa.array([data.tobytes()], pa.binary())})

    kind = classes.schema["label"].dataType.simpleString()
    tiles = written(dealt.groupBy("label", "dim", "tile").applyInArrow(
        pack, f"label {kind}, dim int, tiles int, tile int, rows binary, copies binary, data binary"), "tiles")
    strips = F.greatest(F.ceil(F.sqrt(F.col("tiles").cast("double"))), F.ceil(F.col("tiles") / STRIP_TILES)).cast("int")
    pairs = tiles.withColumn("strips", strips).withColumn("strip", F.pmod("tile", "strips")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("strips") - 1))).select(
        "label", "dim", F.least("strip", "with").alias("low"), F.greatest("strip", "with").alias("high"),
        "strip", "tile", "rows", "copies", "data")

    def multiply(table: pa.Table) -> pa.Table:
        sides = table.sort_by("tile").to_pylist()
        low, one_strip = sides[0]["low"], sides[0]["low"] == sides[0]["high"]
        ids = [np.frombuffer(s["rows"], "<i8") for s in sides]
        copies = np.concatenate([np.frombuffer(s["copies"], "<i8") for s in sides])
        data = [even(np.frombuffer(s["data"], item).reshape(-1, s["dim"])) for s in sides]
        starts = np.cumsum([0, *map(len, ids)])
        links, tree = np.zeros(len(copies), np.int64), np.arange(len(copies))
        for a, one in enumerate(sides):
            for b, two in enumerate(sides):
                if (a <= b) if one_strip else one["strip"] == low != two["strip"]:
                    for i, j in near_in_tiles(data[a], data[b] if a != b else None, threshold):
                        i, j = i + starts[a], j + starts[b]
                        np.add.at(links, i, copies[j])
                        np.add.at(links, j, copies[i])
                        tree = hang(tree, i, j)
        ids, found = np.concatenate(ids), links > 0
        return pa.table({"row": ids[found], "links": links[found], "near": ids[tree[found]]})

    return pairs.groupBy("label", "dim", "low", "high").applyInArrow(multiply, "row long, links long, near long")


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Two rows link when their labels are equal and not null, their vectors are
    as long and the cosine is at least ``threshold``.  A vector that is null,
    empty, zero or holds a null or non-finite number has no links.  Equal
    vectors are one class that is compared once and counted as often as it
    occurs; classes are told by two 64-bit digests of label and vector.
    component_id: the smallest id reachable (null ids aside, but for a
    component that has no other).  Rows that repeat an id are vectors of
    their own.  Other columns are not read; an empty table gives no rows.
    """
    vector = F.col(vector_col)
    sound = F.col(label_col).isNotNull() & vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = written(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
        F.size(vector).alias("dim"), vector.alias("vector"), F.coalesce(sound, F.lit(False)).alias("sound"),
        F.xxhash64(label_col, vector_col).alias("one"), F.xxhash64(F.lit("two"), label_col, vector_col).alias("two")), "vectors")
    told = ["one", "two"]
    classes = written(rows.filter("sound").groupBy(*told).agg(
        F.min("row").alias("row"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"),
        F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vector").alias("vector")), "classes")
    found = written(near_links(classes.select("row", "copies", "label", "dim", "vector"), threshold, tile), "links")
    linked = components(found.filter("row != near").select(F.col("row").alias("a"), F.col("near").alias("b")))
    placed = classes.select("row", "least").join(linked, F.col("row") == F.col("node"))
    heads = written(placed.groupBy("component").agg(F.min("least").alias("component_id")), "heads")
    counts = found.groupBy("row").agg(F.sum("links").alias("links"))
    reached = placed.select("row", "component").join(heads, "component").select("row", "component_id")
    result = written(
        classes.select(*told, "row", "least", "copies").join(counts, "row", "left").join(reached, "row", "left").select(
            *told, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id")), "result")
    names = ("vec_id", "n_links", "component_id")
    whole = rows.filter("sound").join(result, told).select(*names).unionByName(
        rows.filter("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return whole.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
