"""User-user Pearson similarity.

Design
------
* Correlations are computed on the ratings themselves.  Pearson r is unchanged
  by a per-user positive affine map, so r on the reference's z-scores equals
  r on raw ratings; the only difference is that a user with std 0 (z = 0) has
  an undefined r, which the variance test also reports as null.  Integer
  moments are exact, so the threshold and ranking do not depend on summation
  order.
* Blocking: users are split into ``n_blocks`` blocks and only pairs inside a
  block are compared (reference design).  The count is a parameter and never
  follows from the data, so more users change no correlation among the
  others.  Work inside a block grows with the square of its users; a caller
  with a large table passes a larger count.
* Inside a block, users are dealt into tiles of about TRAIN_TILE users and the
  tiles into strips.  A task takes a pair of strips and computes the co-moments
  of their tiles, pair by pair, as matrix products: no pair row is shuffled,
  ratings travel once per strip, and a task holds at most two strips.
* One block is the exact answer.  It is pruned where that is safe: r over the
  shared items has no bound from either user's own ratings, but a pair needs
  its support.  Users with fewer ratings are left out before the shuffle, and
  in each pair of tiles those who share too few items with the other tile.
* ``corated_pairs`` and ``pair_moments`` are the same as plain relational
  operators: a blocked self join and a hash aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (CORR_DIGITS, MIN_CORR, MIN_SUPPORT, N_BLOCKS, STRIP_RATINGS, STRIP_TILES, TOP_STRIP_TILES,
                         TRAIN_TASKS, TRAIN_TILE)
from ..functions.columns import block_of, pearson_from_moments, rounded_corr, tile_of

INTEGRAL = ("tinyint", "smallint", "int", "bigint")
FLOAT_VAR_EPS = 1e-9


def assign_blocks(ratings: DataFrame, n_blocks: int = N_BLOCKS, method: str = "mix") -> DataFrame:
    """Add ``block``."""
    return ratings.withColumn("block", block_of("user_id", n_blocks, method))


def block_tiles(blocked: DataFrame, **tiles: int) -> DataFrame:
    """(block, name...): into how many tiles of so many users each block falls.

    A table with one row per block.  Tiles only divide the work.
    """
    users = F.count_distinct("user_id")
    return blocked.groupBy("block").agg(
        *(F.ceil(users / size).cast("int").alias(name) for name, size in tiles.items()))


def corated_pairs(blocked: DataFrame) -> DataFrame:
    """Blocked self join (J2): same block, same item, user < neighbor.

    Input (user_id, item_id, rating, block); output
    (block, item_id, user, neighbor, x, y).
    """
    # Both sides are the very same plan (renaming happens after the join), so
    # Spark plans one exchange and reuses it for the other side.
    side = blocked.select("block", "item_id", "user_id", "rating")
    a, b = side.alias("a"), side.alias("b")
    joined = a.join(b, (F.col("a.block") == F.col("b.block"))
                    & (F.col("a.item_id") == F.col("b.item_id"))
                    & (F.col("a.user_id") < F.col("b.user_id")))
    return joined.select(
        F.col("a.block").alias("block"), F.col("a.item_id").alias("item_id"),
        F.col("a.user_id").alias("user"), F.col("b.user_id").alias("neighbor"),
        F.col("a.rating").alias("x"), F.col("b.rating").alias("y"))


def pair_moments(pairs: DataFrame, min_support: int | None = MIN_SUPPORT,
                 strict: bool = False) -> DataFrame:
    """Co-moments per (user, neighbor) (A2) with the support filter.

    ``strict`` selects ``n > min`` (notebook) instead of ``n >= min`` (batch).
    ``min_support=None`` keeps every pair (0 is a real threshold, not "default").
    """
    kind = "bigint" if dict(pairs.dtypes)["x"] in INTEGRAL else "double"
    x, y = F.col("x").cast(kind), F.col("y").cast(kind)
    moments = pairs.groupBy("user", "neighbor").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("sum_x"), F.sum(y).alias("sum_y"),
        F.sum(x * y).alias("sum_xy"),
        F.sum(x * x).alias("sum_x2"), F.sum(y * y).alias("sum_y2"),
    )
    if min_support is None:
        return moments
    keep = F.col("n") > min_support if strict else F.col("n") >= min_support
    return moments.where(keep)


def correlations(moments: DataFrame, min_corr: float | None = MIN_CORR,
                 drop_undefined: bool = True) -> DataFrame:
    """Pearson r per pair (A3), rounded, undefined r dropped, ``r > min_corr``.

    Integer moments are exact; floating moments (z-scores) get a relative
    zero-variance guard.
    """
    eps = 0.0 if dict(moments.dtypes)["sum_x"] in INTEGRAL else FLOAT_VAR_EPS
    r = rounded_corr(pearson_from_moments("n", "sum_x", "sum_y", "sum_xy", "sum_x2", "sum_y2",
                                          eps))
    out = moments.select("user", "neighbor", r.alias("corr"), "n")
    if drop_undefined:
        out = out.where(F.col("corr").isNotNull())
    if min_corr is not None:
        out = out.where(F.col("corr") > min_corr)
    return out


def symmetric(corrs: DataFrame) -> DataFrame:
    """Both directions of every edge (U1) in one pass: inline(array(struct, struct))."""
    return corrs.select(F.inline(F.array(
        F.struct(F.col("user").alias("user"), F.col("neighbor").alias("neighbor"),
                 F.col("corr").alias("corr")),
        F.struct(F.col("neighbor").alias("user"), F.col("user").alias("neighbor"),
                 F.col("corr").alias("corr")),
    )))


def block_correlations(ratings: DataFrame, n_blocks: int = N_BLOCKS, method: str = "mix",
                       min_support: int | None = MIN_SUPPORT,
                       min_corr: float | None = MIN_CORR, k: int | None = None,
                       tile: int = TRAIN_TILE, one_rating: bool = False) -> DataFrame:
    """Half-matrix correlations inside blocks: (user < neighbor, corr, n).

    With ``k``, a pair may be left out that is not among the k best of either
    user: all that a later top-k needs is kept.  ``one_rating`` says that no
    user rated an item twice, see ``able_users``.
    """
    rows = ratings.select("user_id", "item_id", "rating")
    blocked = assign_blocks(able_users(rows, min_support) if one_rating else rows, n_blocks, method)
    return correlations(block_pair_moments(blocked, min_support, False, min_corr, k, tile, blocks=n_blocks), min_corr)


# --- subject users against everyone (J3, J5, A4) ----------------------------

def _subject_frame(ratings: DataFrame, subjects) -> DataFrame:
    """Subject users' ratings, by a list of ids or by a table of them."""
    if isinstance(subjects, DataFrame):
        ids = subjects.select(F.col(subjects.columns[0]).alias("user_id")).distinct()
        return ratings.join(ids, "user_id", "left_semi")
    return ratings.where(F.col("user_id").isin(sorted({int(u) for u in subjects})))


def subject_pairs(ratings: DataFrame, subjects: Sequence[int] | DataFrame) -> DataFrame:
    """Subject users joined to every other user on shared items.

    Output (user, neighbor, item_id, x, y), ``user != neighbor``.  The sides'
    measured sizes decide on the join; a popular item's partition is split.
    """
    sub = _subject_frame(ratings, subjects).select(
        F.col("user_id").alias("user"), "item_id", F.col("rating").alias("x"))
    others = ratings.select(F.col("user_id").alias("neighbor"), "item_id",
                            F.col("rating").alias("y"))
    return sub.join(others, "item_id").where(F.col("user") != F.col("neighbor")) \
        .select("user", "neighbor", "item_id", "x", "y")


def subject_correlations(ratings: DataFrame, subjects: Sequence[int] | DataFrame,
                         min_support: int | None = MIN_SUPPORT, strict: bool = False,
                         min_corr: float | None = MIN_CORR) -> DataFrame:
    """Correlations of subject users against all users (J3 with ``!=``, D6)."""
    moments = pair_moments(subject_pairs(ratings, subjects), min_support, strict)
    return correlations(moments, min_corr)


# --- co-moments of pairs of tiles --------------------------------------------

MOMENT_NAMES = ("n", "sum_x", "sum_y", "sum_xy", "sum_x2", "sum_y2")
ITEM_CHUNK = 2048
# Bytes of a group's ratings as matrices, kept for all its pairs of tiles; rows of a batch that leaves a group.
WHOLE_BYTES = 256 << 20
OUT_ROWS = 1 << 16
# Users of a tile whose matrices with another tile are made at once.
SLICE = 128
# Integers below these are exact in single and in double precision.
SINGLE = 1 << 24
DOUBLE = 1 << 53
# Pairs that a tile's k best wait for at least; pairs whose moments are made again at once.
FEW_PAIRS = 1 << 14
AGAIN_PAIRS = 1 << 11


def _top_pairs_fn(least: int, min_corr: float | None, k: int, whole_bytes: int):
    """Arrow-free kernel: the pairs of a group of tiles that are among the k best of either user, with their moments.

    For integer ratings whose matrices (see ``_tile_moments_fn``) fit
    ``whole_bytes`` in small integers.  r does not change when a whole number
    is taken from all ratings, so they are centred, and digits of one product
    hold several sums: with M' = M + a X + b Q
        M' M^T = n + a Sx + b Sxx,  M (X + c Q)^T = Sy + c Syy,  X X^T = Sxy,
    three products instead of six.  a, b and c are powers of two above the
    sums below them, which the rows' norms bound, so every digit is exact.  A
    pair near the k-th best of one of its users gets its exact rounded r; a
    user holds k sorted keys (r, neighbour) of 8 bytes, and the moments of the
    pairs that remain are made once more at the end.
    """
    import numpy as np

    slack = 1e-5
    part_bits, zero = 31, 1 << 30  # the part of r in a key: zero - r in units
    never = np.iinfo(np.int64).max

    class Best:
        """The k best of a tile's users so far, as sorted keys (row, falling r, neighbour)."""

        def __init__(self, rows, shift, other_bits, kind):
            self.rows, self.shift, self.other_bits = rows, shift, other_bits
            self.keys, self.waiting, self.count = np.zeros(0, np.int64), [], 0
            self.last = np.full(rows, never)  # the k-th key
            self.least_r = -np.inf if min_corr is None else min_corr - slack
            self.floor = np.full(rows, self.least_r, kind)

        def take(self, rows, key):
            key = key + (rows << self.shift)
            key = key[key < self.last[rows]]
            if len(key):
                self.waiting.append(key)
                self.count += len(key)
                if self.count > max(FEW_PAIRS, len(self.keys) // 2):
                    self.merge()

        def merge(self):
            if not self.waiting:
                return
            keys = np.concatenate([self.keys, *self.waiting])
            self.waiting, self.count = [], 0
            keys.sort()
            start = np.searchsorted(keys, np.arange(self.rows) << self.shift)
            size = np.diff(start, append=len(keys))
            full = np.flatnonzero(size >= k)
            self.last[full] = last = keys[start[full] + k - 1]
            r = (zero - ((last >> self.other_bits) & ((1 << part_bits) - 1))) / 10.0 ** CORR_DIGITS
            self.floor[full] = np.maximum(r - slack, self.least_r)
            self.keys = keys[np.arange(len(keys)) - np.repeat(start, size) < k]

    def units(cov, vx, vy):
        """The correlations as Spark rounds them (half up on the shortest decimal), in units of the last digit."""
        from decimal import ROUND_HALF_UP, Decimal

        r = cov / (np.sqrt(vx) * np.sqrt(vy))
        scaled = np.abs(r) * 10.0 ** CORR_DIGITS
        out = np.floor(scaled + 0.5)
        for at in np.flatnonzero(np.abs(scaled + 0.5 - np.round(scaled + 0.5)) < 1e-4):
            out[at] = float(Decimal(repr(abs(float(r[at])))).scaleb(CORR_DIGITS).quantize(Decimal(1), ROUND_HALF_UP))
        return (np.sign(r) * out).astype(np.int64)

    def above(x):
        """The power of two above ``x``."""
        return 2.0 ** int(x).bit_length()

    def coded(rows):
        """The users by tile, where each tile starts, and their matrices in small integers; None where they don't fit."""
        import pyarrow.compute as pc

        lists, ratings, ids, tile = (rows[c].combine_chunks() for c in ("items", "ratings", "user_id", "tile"))
        ids, tile = ids.to_numpy(), tile.to_numpy()
        flat = ratings.flatten()
        if not pa.types.is_integer(flat.type) or not len(flat) or flat.null_count or lists.flatten().null_count:
            return None
        low, high = (v.as_py() for v in pc.min_max(flat).values())
        kinds = np.uint8, np.min_scalar_type(-max(abs(low), high) - 1), np.min_scalar_type(max(low * low, high * high))
        items = np.sort(pc.unique(lists.flatten()).to_numpy())
        width = len(items)
        if max(abs(low), high) >= 1 << 15 or sum(np.dtype(d).itemsize for d in kinds) * len(ids) * width > whole_bytes:
            return None
        order = np.lexsort((ids, tile))
        ids, tile = ids[order], tile[order]
        users = np.sort(ids)
        if (users[1:] == users[:-1]).any():
            return None
        whole = [np.zeros((len(ids), width), d) for d in kinds]
        numbers, first = np.unique(tile, return_index=True)
        centre, norms = (low + high) // 2, np.zeros(6)
        for a, b in zip(first, [*first[1:], len(ids)]):
            at = pa.array(order[a:b])
            mine = lists.take(at)
            u, i = np.repeat(np.arange(b - a), mine.value_lengths().to_numpy()), np.searchsorted(items, mine.flatten().to_numpy())
            x, u = ratings.take(at).flatten().to_numpy().astype(np.float64), u * width + i
            m, x, q = (np.bincount(u, w, (b - a) * width).reshape(b - a, width) for w in (None, x, x * x))
            for w, made in zip(whole, (m, x, q)):
                limits = np.iinfo(w.dtype)
                if made.max(initial=0) > limits.max or made.min(initial=0) < limits.min:
                    return None  # very many ratings of one item by one user
                w[a:b] = made
            forms = (m, x, q, x - centre * m, q - 2 * centre * x + centre * centre * m)
            norms[:5] = np.maximum(norms[:5], [np.sqrt((f * f).sum(axis=1).max(initial=0)) for f in forms])
        return ids, numbers, first, whole, float(centre), norms, users

    def weights(norms):
        """(number type, a, b, c) for which all digits are exact, or None."""
        m, _, _, x, q, _ = norms * (1 + 1e-9)
        n, s, v = int(m * m) + 1, int(x * m) + 1, int(q * m) + 1
        a = above(n)
        b, c = above(2 * (a * s + n)), above(2 * s)
        most = max(b * v + a * s + n, c * v + s, n * v, s * s, n * (int(x * x) + 1))
        return next(((kind, a, b, c) for kind, limit in ((np.float32, SINGLE), (np.float64, DOUBLE)) if 2 * most < limit), None)

    def top_pairs(rows, low, high):
        """None where the form does not fit, else parts (users, users, moments) of what is kept."""
        made = coded(rows)
        digits = made and weights(made[5])
        if not digits:
            return None
        ids, numbers, first, whole, centre, norms, users = made
        ends = [*first[1:], len(ids)]
        height = int(max(b - a for a, b in zip(first, ends)))
        other_bits = len(ids).bit_length()
        shift = other_bits + part_bits
        if shift + height.bit_length() > 62:
            return None
        strip = dict(zip(rows["tile"].to_numpy().tolist(), rows["strip"].to_numpy().tolist()))
        strips = [strip[t] for t in numbers.tolist()]
        return kept(ids, np.searchsorted(users, ids), list(zip(first, ends)), strips, low, high, whole, centre, norms, users, digits, height,
                    shift, other_bits)

    def kept(ids, place, spans, strips, low, high, whole, centre, norms, users, digits, height, shift, other_bits):
        kind, a, b, c = digits
        best = [Best(e - f, shift, other_bits, kind) for f, e in spans]

        def matrices(t):
            m, x, q = (w[spans[t][0]:spans[t][1]].astype(kind) for w in whole)
            q -= 2 * centre * x
            q += centre * centre * m
            x -= centre * m
            return m, x, q

        spare = [np.empty(SLICE * height, kind) for _ in range(7)]
        masks = [np.empty(SLICE * height, bool) for _ in range(2)]
        with np.errstate(all="ignore"):
            for t in range(len(spans)):
                if strips[t] != low:
                    continue
                m1, x1, q1 = matrices(t)
                l1 = m1 + a * x1 + b * q1
                for o in range(t if low == high else 0, len(spans)):
                    if low != high and strips[o] == low:
                        continue
                    m2, x2, q2 = matrices(o)
                    r2 = x2 + c * q2
                    for at in range(0, len(m1), SLICE):
                        pairs_of(t, o, at, best[t], best[o], (l1[at:at + SLICE], m1[at:at + SLICE], x1[at:at + SLICE]), (m2, r2, x2),
                                 place[spans[t][0]:spans[t][1]], place[spans[o][0]:spans[o][1]], a, b, c, spare, masks)
        for side in best:
            side.merge()
        yield from with_moments(best, ids, place, spans, whole, users, norms, other_bits, shift)

    def pairs_of(t, o, at, one, two, left, right, place_one, place_two, a, b, c, spare, masks):
        """The pairs of a few users of a tile with another that are near the k best go to both tiles' lists."""
        (l1, m1, x1), (m2, r2, x2) = left, right
        shape, size = (len(l1), len(m2)), len(l1) * len(m2)
        n, sy, cov, vx, sx, vy, rest = (w[:size].reshape(shape) for w in spare)
        keep, near = (w[:size].reshape(shape) for w in masks)
        np.matmul(l1, m2.T, out=n)
        np.matmul(m1, r2.T, out=sy)
        np.matmul(x1, x2.T, out=cov)
        np.rint(np.multiply(n, 1 / b, out=vx), out=vx)  # Sxx
        n -= np.multiply(vx, b, out=rest)
        np.floor(np.multiply(n, 1 / a, out=sx), out=sx)
        n -= np.multiply(sx, a, out=rest)
        np.greater_equal(n, least, out=keep)
        np.rint(np.multiply(sy, 1 / c, out=vy), out=vy)  # Syy
        sy -= np.multiply(vy, c, out=rest)
        vx *= n
        vx -= np.multiply(sx, sx, out=rest)
        vy *= n
        vy -= np.multiply(sy, sy, out=rest)
        cov *= n
        cov -= np.multiply(sx, sy, out=rest)
        np.sqrt(np.multiply(vx, vy, out=rest), out=rest)
        rest *= np.minimum(one.floor[at:at + len(l1), None], two.floor[None, :], out=sx)
        np.greater(cov, rest, out=near)  # never where a side is constant: 0 > 0
        keep &= near
        if t == o:
            keep &= np.arange(at, at + len(l1))[:, None] < np.arange(len(m2))[None, :]
        found = np.flatnonzero(keep)
        if len(found):
            ra, rb = np.divmod(found, len(m2))
            ra += at
            part = (zero - units(*(w.ravel()[found].astype(np.float64) for w in (cov, vx, vy)))) << one.other_bits
            one.take(ra, part + place_two[rb])
            two.take(rb, part + place_one[ra])

    def with_moments(best, ids, place, spans, whole, users, norms, other_bits, shift):
        """The pairs of the lists, each once, and their moments."""
        where = np.empty(len(ids), np.int64)
        where[place] = np.arange(len(ids))
        low_part = (1 << shift) - 1
        last = np.concatenate([np.where(s.last == never, low_part, s.last & low_part) for s in best])
        m, x, q = norms[:3] * (1 + 1e-9)
        kind = np.float32 if max(m * m, m * x, m * q, x * x) < SINGLE else np.float64
        for side, (first, _) in zip(best, spans):
            keys, side.keys = side.keys, None
            mine = (keys >> shift) + first
            other = where[keys & ((1 << other_bits) - 1)]
            # the other list has the pair too where the pair is not behind its last
            both = (keys & low_part) >> other_bits << other_bits | place[mine] <= last[other]
            sel = np.flatnonzero((place[mine] < place[other]) | ~both)
            for at in range(0, len(sel), AGAIN_PAIRS):
                one, two = mine[sel[at:at + AGAIN_PAIRS]], other[sel[at:at + AGAIN_PAIRS]]
                (ma, xa, qa), (mb, xb, qb) = ([w[r].astype(kind) for w in whole] for r in (one, two))
                yield ids[one], ids[two], [np.einsum("ij,ij->i", u, v) for u, v in (
                    (ma, mb), (xa, mb), (ma, xb), (xa, xb), (qa, mb), (ma, qb))]

    return top_pairs


def _tile_moments_fn(min_support: int | None, strict: bool, min_corr: float | None, k: int | None,
                     number: str, chunk: int = ITEM_CHUNK, count_only: bool = False, whole_bytes: int = WHOLE_BYTES,
                     most_held: int = 1 << 20):
    """Arrow function: co-moments of the users of two strips of tiles of one block.

    The strips' tiles are taken pair by pair.  With M the users x items counts
    of ratings (1, or more where a user rated an item repeatedly), X their
    sums and Q the sums of their squares:
        n = M M^T,  Sxy = X X^T,  Sx = X M^T,  Sy = M X^T,
        Sxx = Q M^T,  Syy = M Q^T,
    which are the sums over the rows of the self join.  Where the strips'
    matrices over all their items are small they are made once; else only
    items that both tiles hold have a column, only users whose ratings of such
    items can reach the support have a row, and items are taken in chunks, so
    memory is O(tile^2 + tile x chunk) besides the strips' ratings.  Integer
    sums are exact: single precision is used below 2^24, else double (< 2^53).
    With ``min_corr``, pairs whose unrounded r is clearly at or below it (or
    undefined) are dropped.  The pairs of each pair of tiles leave the task
    before the next.  With ``k`` each user's k-th best r so far is kept through
    the tiles, pairs clearly below it for both their users are dropped, again
    whenever more than ``most_held`` or k pairs a user are held, and the rest
    leave at the end: they contain all that the exact steps in Spark keep.
    Integer ratings whose matrices are small take the shorter way of
    ``_top_pairs_fn`` then.  ``count_only`` gives (compared, supported) pairs instead.
    """
    import numpy as np

    least = 1 if min_support is None else min_support + 1 if strict else max(min_support, 1)
    ranks = min_corr is not None or k is not None
    top_pairs = _top_pairs_fn(least, min_corr, k, whole_bytes) if k is not None and not count_only else None

    class Side:
        """The ratings of one tile: users and items by number, sorted by user."""

        def __init__(self, ids, items, x):
            self.users, self.u = np.unique(ids, return_inverse=True)
            self.i, self.x = items, x
            self.held = np.unique(items)
            # the k best r of each user, as sorted keys 4 * user - r, and the k-th of them
            self.best, self.floor = np.zeros(0), np.full(len(self.users), -np.inf)

        def facing(self, other):
            """The part of it that can be in a pair with ``other``."""
            common = np.isin(self.i, other.held)
            if self.repeats or other.repeats:  # a repeated rating supports a pair more than once
                enough = np.zeros(len(self.users), bool)
                enough[self.u[common]] = True
            else:
                enough = np.bincount(self.u[common], minlength=len(self.users)) >= least
            sel = common & enough[self.u]
            number = np.cumsum(enough) - 1
            return np.flatnonzero(enough), number[self.u[sel]], self.i[sel], self.x[sel]

        @property
        def repeats(self):
            if not hasattr(self, "_repeats"):
                key = self.u.astype(np.int64) * (int(self.i.max()) + 1 if len(self.i) else 1) + self.i
                self._repeats = len(np.unique(key)) < len(key)
            return self._repeats

        def meet(self, rows, r):
            """Takes more values of r of its users into their best."""
            keys = np.sort(np.concatenate([self.best, rows * 4.0 - r]))
            start = np.searchsorted(keys, np.arange(len(self.users)) * 4.0 - 2)
            size = np.diff(start, append=len(keys))
            full = np.flatnonzero(size >= k)
            self.floor[full] = full * 4.0 - keys[start[full] + k - 1]
            self.best = keys[np.arange(len(keys)) - np.repeat(start, size) < k]

    def dense(u, i, x, height, width, kind=np.float64):
        at = u * width + i
        return [np.bincount(at, w, height * width).astype(kind).reshape(height, width) for w in (None, x, x * x)]

    def norms(whole):
        """The largest Euclidean norms of the rows of a side's matrices."""
        return [float(np.sqrt((w * w).sum(axis=1).max())) for w in whole]

    def products(n, sx, sy, sxy, sxx, syy, one, two, same):
        (ma, xa, qa), (mb, xb, qb) = one, two
        n += ma @ mb.T
        sxy += xa @ xb.T
        sx += xa @ mb.T
        sxx += qa @ mb.T
        if not same:
            sy += ma @ xb.T
            syy += ma @ qb.T

    def moments(one, two, same):
        """Row numbers of the users on both sides and their matrices."""
        ra, u_a, i_a, x_a = one.facing(two)
        rb, u_b, i_b, x_b = two.facing(one)
        columns = np.intersect1d(i_a, i_b)  # fewer, as users have left
        if not len(ra) or not len(rb) or not len(columns):
            return None
        sides = []
        for u, i, x in ((u_a, i_a, x_a), (u_b, i_b, x_b)):
            sel = np.isin(i, columns)
            sides.append((u[sel], np.searchsorted(columns, i[sel]), x[sel]))
        sums = [np.zeros((len(ra), len(rb))) for _ in range(6)]
        for c0 in range(0, len(columns), chunk):
            cw = min(chunk, len(columns) - c0)
            parts = []
            for (u, i, x), height in zip(sides, (len(ra), len(rb))):
                sel = (i >= c0) & (i < c0 + cw)
                parts.append(dense(u[sel], i[sel] - c0, x[sel], height, cw))
            products(*sums, parts[0], parts[0] if same else parts[1], same)
        n, sx, sy, sxy, sxx, syy = sums
        if same:
            sy, syy = sx.T, sxx.T
        return ra, rb, (n, sx, sy, sxy, sxx, syy)

    def whole_moments(one, two, c):
        """The same from the matrices over all items, for ``SLICE`` users of one side that fit a cache."""
        (ma, xa, qa), (mb, xb, qb) = [m[c:c + SLICE] for m in one.whole], two.whole
        rows = np.arange(c, c + len(ma))
        return rows, np.arange(len(mb)), (ma @ mb.T, xa @ mb.T, ma @ xb.T, xa @ xb.T, qa @ mb.T, ma @ qb.T)

    def kept(one, two, same, slack, ra, rb, sums):
        """(rows, rows, r, moments) of the pairs of a matrix that are kept."""
        n, sx, sy, sxy, sxx, syy = sums
        keep = n >= least
        if same:
            keep &= ra[:, None] < rb[None, :]
        if not ranks:
            a, b = np.nonzero(keep)
            return ra[a], rb[b], None, [s[a, b] for s in sums]
        vx, vy, r = n * sxx, n * syy, n * sxy
        vx -= sx * sx
        vy -= sy * sy
        r -= sx * sy
        keep &= vx > 0
        keep &= vy > 0
        with np.errstate(all="ignore"):
            vx *= vy
            r /= np.sqrt(vx, out=vx)
            least_r = -np.inf if min_corr is None else min_corr
            if k is None:
                keep &= r > least_r - slack
            else:
                near = r >= (np.maximum(one.floor[ra], least_r) - slack).astype(r.dtype)[:, None]
                near |= r >= (np.maximum(two.floor[rb], least_r) - slack).astype(r.dtype)[None, :]
                keep &= near
        a, b = np.divmod(np.flatnonzero(keep), len(rb))
        return ra[a], rb[b], r[a, b].astype(np.float64), [s[a, b] for s in sums]

    def pairs(one, two, same, kind):
        """The kept pairs of two tiles, a matrix at a time."""
        slack = 1e-5 if kind is np.float32 else 1e-6
        if kind is not None:
            found = [kept(one, two, same, slack, *whole_moments(one, two, c)) for c in range(0, len(one.users), SLICE)]
        else:
            got = moments(one, two, same)
            found = [] if got is None else [kept(one, two, same, slack, *got)]
        if k is None:
            yield from found
        elif found:
            a, b, r = (np.concatenate([f[j] for f in found]) for j in range(3))
            sums = [np.concatenate([f[3][j] for f in found]) for j in range(6)]
            one.meet(a, r)
            two.meet(b, r)
            near = (r >= one.floor[a] - slack) | (r >= two.floor[b] - slack)
            yield a[near], b[near], r[near], [s[near] for s in sums]

    def units(n, sx, sy, sxy, sxx, syy):
        """The correlations as Spark rounds them (half up on the shortest decimal), in units of the last digit."""
        from decimal import ROUND_HALF_UP, Decimal

        r = (n * sxy - sx * sy) / (np.sqrt(n * sxx - sx * sx) * np.sqrt(n * syy - sy * sy))
        scaled = np.abs(r) * 10.0 ** CORR_DIGITS
        out = np.floor(scaled + 0.5)
        for at in np.flatnonzero(np.abs(scaled + 0.5 - np.round(scaled + 0.5)) < 1e-4):
            out[at] = float(Decimal(repr(abs(float(r[at])))).scaleb(CORR_DIGITS).quantize(Decimal(1), ROUND_HALF_UP))
        return (np.sign(r) * out).astype(np.int64)

    def near_pairs(held, floor, slack):
        """The held pairs that may still be among the k best of either user; a part is replaced before the next."""
        for j, (a, b, r, sums) in enumerate(held):
            near = (r >= floor[a] - slack) | (r >= floor[b] - slack)
            held[j] = a[near], b[near], r[near], [s[near] for s in sums]
        return [h for h in held if len(h[0])]

    def best_pairs(held, users):
        """Those of the held pairs that are among the k best of either user, of equals those of the smallest neighbours."""
        a, b = (np.concatenate([h[j] for h in held]) for j in range(2))
        corr = np.concatenate([units(*(s.astype(np.float64) for s in h[3])) for h in held])
        me, other = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.lexsort((users[other], -np.concatenate([corr, corr]), me))
        size = np.bincount(me, minlength=len(users))
        rank = np.arange(len(me)) - np.repeat(np.cumsum(size) - size, size)
        best = np.zeros(len(me), bool)
        best[order[rank < k]] = True
        best, at = best[:len(a)] | best[len(a):], 0
        for j, (a, b, r, sums) in enumerate(held):
            sel, at = best[at:at + len(a)], at + len(a)
            held[j] = a[sel], b[sel], r[sel], [s[sel] for s in sums]
        return held

    def narrowed(held, users, sides, slack, most, integral):
        """The held pairs without those that are surely not among the k best of either user."""
        held = near_pairs(held, np.concatenate([s.floor for s in sides.values()]), slack)
        return best_pairs(held, users) if integral and sum(len(h[0]) for h in held) > most else held

    def batches_of(one, two, sums):
        for c in range(0, len(one), OUT_ROWS):
            part = slice(c, c + OUT_ROWS)
            flip = one[part] > two[part]
            n, sx, sy, sxy, sxx, syy = (s[part].astype(number) for s in sums)
            swap = lambda p, q: (np.where(flip, q, p), np.where(flip, p, q))
            (user, neighbor), (x, y), (x2, y2) = swap(one[part], two[part]), swap(sx, sy), swap(sxx, syy)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (user, neighbor, n.astype(np.int64), x, y, sxy, x2, y2)], names=["user", "neighbor", *MOMENT_NAMES])

    def make_whole(sides, width, integral):
        """The sides' matrices over all items, in single precision where all sums, and the products in r, are exact in it."""
        largest = np.zeros(3)
        for side in sides:
            whole = dense(side.u, side.i, side.x, len(side.users), width)
            largest = np.maximum(largest, norms(whole))
            side.whole = [w.astype(np.float32) for w in whole]
        m, x, q = largest
        if integral and m * m * max(q * m, x * x) < SINGLE:
            return np.float32
        for side in sides:
            side.whole = dense(side.u, side.i, side.x, len(side.users), width)
        return np.float64

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        best = top_pairs(rows, low, high) if top_pairs else None
        if best is not None:
            del rows
            for one, two, sums in best:
                yield from batches_of(one, two, sums)
            return
        lists, ids, strip, tiles = (rows[c].combine_chunks() for c in ("items", "user_id", "strip", "tile"))
        each = lists.value_lengths().to_numpy()
        items = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        width, items = len(items[0]), items[1]
        x = rows["ratings"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ids, strip, tiles = (np.repeat(c.to_numpy(), each) for c in (ids, strip, tiles))
        del rows, lists
        parts = [[t[c:c + STRIP_TILES].tolist() for c in range(0, len(t), STRIP_TILES)] for t in (np.unique(tiles[strip == n]) for n in (low, high))]
        pairs_of_parts = [(p, q) for j, p in enumerate(parts[0]) for q in (parts[1][j:] if low == high else parts[1])]
        integral = np.array_equal(x, np.floor(x))
        raw = [ids, tiles, items, x]
        del ids, strip, tiles, items, x
        while pairs_of_parts:
            p, q = pairs_of_parts.pop(0)
            yield from between(p, q, low == high and p == q, raw, width, integral, not pairs_of_parts)

    def between(low, high, same, raw, width, integral, last):
        """What ``fn`` gives for two lists of at most STRIP_TILES tiles each."""
        ids, tiles, items, x = raw
        sides, first = {}, 0
        for t in sorted({*low, *high}):
            own = tiles == t
            sides[t] = side = Side(ids[own], items[own], x[own])
            side.first, first = first, first + len(side.users)
        if last:
            raw.clear()
        del ids, tiles, items, x
        kind = None
        if not count_only and 24 * first * width <= whole_bytes:
            kind = make_whole(sides.values(), width, integral)
            for side in sides.values():  # all that is left to do is done on the matrices
                del side.u, side.i, side.x, side.held
        slack = 1e-5 if kind is np.float32 else 1e-6
        users = np.concatenate([s.users for s in sides.values()])
        held, number_held, compared, supported = [], 0, 0, 0
        most = max(most_held, k * len(users)) if k is not None else 0
        limit = most
        for a, one in ((t, sides[t]) for t in low):
            for b, two in ((t, sides[t]) for t in high):
                if same and a > b:
                    continue
                if count_only:
                    got = moments(one, two, a == b)
                    if got is not None:
                        ra, rb, (n, *_) = got
                        compared += len(ra) * (len(ra) - 1) // 2 if a == b else len(ra) * len(rb)
                        supported += int(((np.triu(n, 1) if a == b else n) >= least).sum())
                    continue
                for one_rows, two_rows, r, sums in pairs(one, two, a == b, kind):
                    if k is None:
                        yield from batches_of(one.users[one_rows], two.users[two_rows], sums)
                    elif len(r):
                        held.append(((one_rows + one.first).astype(np.int32), (two_rows + two.first).astype(np.int32), r, sums))
                        number_held += len(r)
                if number_held > limit:
                    held = narrowed(held, users, sides, slack, most, integral)
                    number_held = sum(len(h[0]) for h in held)
                    limit = max(most, 2 * number_held)
        if held:
            held = narrowed(held, users, sides, slack, most, integral)
        while held:
            one_rows, two_rows, _, sums = held.pop()
            yield from batches_of(users[one_rows], users[two_rows], sums)
        if count_only:
            yield pa.RecordBatch.from_arrays([pa.array([compared]), pa.array([supported])], names=["compared", "supported"])

    return fn


def strips_of(tiles: Column, most: int = STRIP_TILES, enough: int | None = None) -> Column:
    """Into how many strips ``tiles`` tiles fall: the square root or ``enough``, but no strip of more than ``most``."""
    root = F.ceil(F.sqrt(tiles.cast("double")))
    return F.greatest(root if enough is None else F.least(root, F.lit(enough)), F.ceil(tiles / most)).cast("int")


def strip_lists(blocked: DataFrame, tile: int = TRAIN_TILE, most: int = STRIP_TILES, enough: int | None = None) -> DataFrame:
    """(block, low, high, strip, tile, user_id, items, ratings): a user's ratings at every pair of strips it takes part in.

    With T tiles a block there are about sqrt(T) strips of sqrt(T) tiles, and a
    user's ratings, as two arrays in one row, are copied once for each strip
    instead of once for each tile.  With ``enough`` there are no more strips
    than that, unless one held more than ``most`` tiles or STRIP_RATINGS ratings.
    """
    lists = blocked.where(F.col("item_id").isNotNull()).groupBy("block", "user_id").agg(
        F.collect_list(F.struct("item_id", "rating")).alias("rated"))
    strips = strips_of(F.col("tiles"), most, enough)
    if enough is None:
        counts = block_tiles(blocked, tiles=tile)
    else:
        counts = lists.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"), F.sum(F.size("rated")).alias("rows"))
        strips = F.greatest(strips, F.ceil(F.col("rows") / STRIP_RATINGS).cast("int"))
    # one row a block: sent along, so that no list is shuffled by its block first
    tiled = lists.join(F.broadcast(counts.withColumn("strips", strips)), "block")
    own = tiled.withColumn("tile", tile_of("user_id", F.col("tiles"))).withColumn(
        "strip", F.pmod("tile", "strips")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
    return own.select("block", F.least("strip", "with").alias("low"), F.greatest("strip", "with").alias("high"),
                      "strip", "tile", "user_id", F.col("rated.item_id").alias("items"), F.col("rated.rating").alias("ratings"))


def strip_pairs(blocked: DataFrame, tile: int = TRAIN_TILE, most: int = STRIP_TILES) -> DataFrame:
    """(block, low, high, strip, tile, user_id, item_id, rating): the ratings of ``strip_lists``, a row each."""
    return strip_lists(blocked, tile, most).select(
        "block", "low", "high", "strip", "tile", "user_id", F.inline(F.arrays_zip("items", "ratings"))).withColumnsRenamed(
        {"items": "item_id", "ratings": "rating"})


def able_users(ratings: DataFrame, min_support: int | None, strict: bool = False) -> DataFrame:
    """The ratings of users with as many as a pair's support, where no user rated an item twice.

    Nobody else can have an edge then: a pair's support is the items it shares.
    """
    least = 1 if min_support is None else min_support + strict
    able = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("user_id")
    return ratings.join(able, "user_id", "left_semi")


def _by_strips(blocked: DataFrame, fn, schema: str, tile: int, most: int, enough: int | None = None) -> DataFrame:
    # An explicit partition count keeps AQE from packing many compute-heavy
    # (but byte-light) pairs of strips into a few tasks.
    parts = int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return strip_lists(blocked, tile, most, enough).repartition(parts, "block", "low", "high").groupBy(
        "block", "low", "high").applyInArrow(fn, schema)


def block_pair_moments(blocked: DataFrame, min_support: int | None = MIN_SUPPORT, strict: bool = False,
                       min_corr: float | None = None, k: int | None = None,
                       tile: int = TRAIN_TILE, strip: int | None = None, blocks: int = 1) -> DataFrame:
    """Same rows as ``pair_moments(corated_pairs(blocked), ...)``, one task per pair of strips of tiles.

    Ratings are shuffled once for each strip of their block; no pair row is.
    Users who rated an item repeatedly count as often as in the join.  With
    ``k`` each pair of strips hands out k pairs a user, so there are few large
    strips: enough for about TRAIN_TASKS tasks over ``blocks`` blocks.
    """
    enough = None if k is None or strip is not None else math.ceil(math.sqrt(2 * TRAIN_TASKS / blocks))
    strip = strip or (STRIP_TILES if k is None else TOP_STRIP_TILES)
    integral = dict(blocked.dtypes)["rating"] in INTEGRAL
    rating = F.col("rating") if integral else F.col("rating").cast("double")
    kind = "long" if integral else "double"
    schema = "user long, neighbor long, n long, " + ", ".join(f"{c} {kind}" for c in MOMENT_NAMES[1:])
    return _by_strips(blocked.withColumn("rating", rating), _tile_moments_fn(
        min_support, strict, min_corr, k, "int64" if integral else "float64"), schema, tile, strip, enough)


def pair_counts(ratings: DataFrame, n_blocks: int = 1, method: str = "mix", min_support: int | None = MIN_SUPPORT,
                tile: int = TRAIN_TILE, strip: int = STRIP_TILES) -> DataFrame:
    """(step, n): how many users, users with ratings enough, pairs compared and pairs with the support.

    For ratings with one row per user and item.  The compared pairs are those
    that the tile products compute after pruning; they depend on the tiles.
    """
    rows = ratings.select("user_id", "item_id", "rating")
    able = able_users(rows, min_support)
    pairs = _by_strips(assign_blocks(able, n_blocks, method), _tile_moments_fn(
        min_support, False, None, None, "int64", count_only=True), "compared long, supported long", tile, strip)
    users = F.count_distinct("user_id").alias("n")
    return rows.agg(users).select(F.lit("users").alias("step"), "n").unionByName(
        able.agg(users).select(F.lit("able users").alias("step"), "n")).unionByName(
        pairs.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("compared", "supported"))).select(
            F.inline(F.array(*(F.struct(F.lit(f"{c} pairs").alias("step"), F.col(c).alias("n"))
                               for c in ("compared", "supported"))))))
