"""Column expressions shared by the operators (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (BLOCK_ADD, BLOCK_MULT, BLOCK_PRIME, CORR_DIGITS, RATING_MAX,
                         RATING_MIN)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pearson_from_moments(n, sx, sy, sxy, sxx, syy, eps: float = 0.0) -> Column:
    """Pearson r from integer co-moments, null when either side is constant.

    Uses the all-integer form (n*Sxy - Sx*Sy) / sqrt((n*Sxx - Sx^2)(n*Syy - Sy^2)):
    numerator and both variance terms are exact bigints, so a constant side
    is detected exactly (no ``sqrt`` of a -1e-15 residual, no NaN), and only
    the final sqrt/division round.  The product of the variance terms is taken
    in double to avoid bigint overflow on very long co-rating lists.
    For floating inputs (e.g. z-scores) pass ``eps`` > 0: a variance term at
    or below ``eps * n * Sxx`` counts as zero, so a constant side's rounding
    residual cannot produce a spurious r.
    """
    n, sx, sy, sxy, sxx, syy = map(col, (n, sx, sy, sxy, sxx, syy))
    num = n * sxy - sx * sy
    var_x = n * sxx - sx * sx
    var_y = n * syy - sy * sy
    if eps:
        ok = (var_x > F.lit(eps) * n * sxx) & (var_y > F.lit(eps) * n * syy)
    else:
        ok = (var_x > 0) & (var_y > 0)
    return F.when(
        ok,
        num.cast("double") / (F.sqrt(var_x.cast("double")) * F.sqrt(var_y.cast("double"))),
    )


def rounded_corr(c) -> Column:
    return F.round(col(c), CORR_DIGITS)


def z_score(rating, mean, std) -> Column:
    """(rating - mean) / std, 0 when std is 0 or missing (reference rule)."""
    rating, mean, std = col(rating), col(mean), col(std)
    return F.when(std != 0, (rating.cast("double") - mean) / std).otherwise(F.lit(0.0))


def clip(c, lo: float = RATING_MIN, hi: float = RATING_MAX) -> Column:
    """Clip to [lo, hi]; null stays null (greatest/least would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c)))


def shrink_to_mean(raw, mean, support, penalty: float) -> Column:
    """mean + (raw - mean) * n / (n + penalty)."""
    raw, mean, support = col(raw), col(mean), col(support)
    return mean + (raw - mean) * (support / (support + F.lit(float(penalty))))


def shrink_to_zero(raw, support, penalty: float) -> Column:
    """raw * n / (n + C): the notebook's multiplicative shrinkage."""
    raw, support = col(raw), col(support)
    return raw * (support / (support + F.lit(float(penalty))))


def block_of(user, n_blocks: int, method: str = "mix") -> Column:
    """Similarity block of a user.

    ``mix``  : pmod(pmod(pmod(user, P) * A + B, P), n) -- default; portable
               integer hash, so patterned ids (all even, multiples of n, ...)
               cannot pile into one block; SQL oracles use the same formula
    ``mod``  : pmod(user, n)        (balanced only for dense sequential ids)
    ``hash`` : pmod(hash(user), n)  (the reference's Murmur3 blocking)
    """
    u = col(user)
    if method == "mix":
        key = F.pmod(F.pmod(u, F.lit(BLOCK_PRIME)) * F.lit(BLOCK_MULT) + F.lit(BLOCK_ADD),
                     F.lit(BLOCK_PRIME))
    elif method == "mod":
        key = u
    elif method == "hash":
        key = F.hash(u)
    else:
        raise ValueError(f"unknown block method {method!r}")
    return F.pmod(key, F.lit(int(n_blocks)))


def tile_of(user, tiles: Column) -> Column:
    """Tile of a user inside its block, independent of the block's own hash."""
    return F.pmod(F.xxhash64(col(user)), tiles).cast("int")


def page_number(rank, page_size: int) -> Column:
    """1-based page of a 1-based rank."""
    return F.ceil(col(rank) / F.lit(page_size)).cast("int")


def total_pages(total, page_size: int) -> Column:
    """ceil(total / size) in integer arithmetic (0 rows -> 0 pages)."""
    return ((col(total) + F.lit(page_size - 1)) / F.lit(page_size)).cast("bigint")
