"""Look-ups over the ratings table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .serving import attach_titles
from .similarity import correlations, pair_moments


def filter_user(ratings: DataFrame, user_id: int) -> DataFrame:
    """One user's ratings (P7); the equality is pushed into the scan."""
    return ratings.where(F.col("user_id") == int(user_id))


def user_ratings(ratings: DataFrame, user_ids: int | Sequence[int]) -> DataFrame:
    """Ratings of one id or a list of ids in one pass (P8), not one job per id."""
    ids = [user_ids] if isinstance(user_ids, int) else list(user_ids)
    return ratings.where(F.col("user_id").isin(sorted({int(u) for u in ids})))


def both_users_items(ratings: DataFrame, user1: int, user2: int) -> DataFrame:
    """Items rated by both users, with both ratings."""
    a = ratings.where(F.col("user_id") == int(user1)).select(
        "item_id", F.col("user_id").alias("user1"), F.col("rating").alias("rating1"))
    b = ratings.where(F.col("user_id") == int(user2)).select(
        "item_id", F.col("user_id").alias("user2"), F.col("rating").alias("rating2"))
    return a.join(b, "item_id").select("item_id", "user1", "user2", "rating1", "rating2")


def pair_lookup(spark: SparkSession, ratings: DataFrame,
                pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """Co-rating support and Pearson r of listed user pairs (P18 over J4 + A2/A3).

    Computed from ratings directly (no blocking), so any pair can be looked up.
    The pair list is a parameter table of len(pairs) rows.
    """
    plist = sorted({(int(a), int(b)) for a, b in pairs})
    wanted = spark.createDataFrame(plist, "user long, neighbor long")
    ids = spark.createDataFrame([(u,) for u in sorted({u for p in plist for u in p})], "user_id long")
    mine = ratings.join(ids, "user_id", "left_semi")
    left = mine.select(F.col("user_id").alias("user"), "item_id", F.col("rating").alias("x"))
    right = mine.select(F.col("user_id").alias("neighbor"), "item_id", F.col("rating").alias("y"))
    pairs_df = left.join(wanted, "user") \
        .join(right, ["neighbor", "item_id"]).select("user", "neighbor", "x", "y")
    return correlations(pair_moments(pairs_df, None), None, drop_undefined=False) \
        .select("user", "neighbor", "n", "corr")


def best_rated_items(ratings: DataFrame, items: DataFrame,
                     user_ids: Sequence[int]) -> DataFrame:
    """Listed users' rated items with titles, best first (O3): rank by rating desc, item."""
    mine = user_ratings(ratings, list(user_ids)).select("user_id", "item_id", "rating")
    titled = attach_titles(mine, items, how="inner")
    w = Window.partitionBy("user_id").orderBy(F.col("rating").desc(), F.col("item_id").asc())
    return titled.withColumn("rank", F.row_number().over(w))
