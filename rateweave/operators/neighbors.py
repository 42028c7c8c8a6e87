"""Top-k neighbour selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import K_NEIGHBORS


def top_k_per_user(edges: DataFrame, k: int = K_NEIGHBORS, user: str = "user",
                   score: str = "corr", other: str = "neighbor") -> DataFrame:
    """Keep the k best ``other`` per ``user`` by ``score`` desc, ``other`` asc.

    ``row_number() <= k`` lets Spark insert a WindowGroupLimit before the
    shuffle, so at most k rows per user per map task are exchanged.  The
    ``other asc`` tie-break makes the k-th place deterministic (D21).
    """
    w = Window.partitionBy(user).orderBy(F.col(score).desc(), F.col(other).asc())
    return edges.withColumn("_rank", F.row_number().over(w)) \
        .where(F.col("_rank") <= k).drop("_rank")
