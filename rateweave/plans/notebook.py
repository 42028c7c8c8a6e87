"""Notebook form of the recommender (C6), for a list of subject users.

Subject users are compared with every other user (no blocking); support is
strict (n > 10), there is no correlation floor, predictions are
sum(r*c)/sum(|c|) shrunk multiplicatively by n/(n+C), titles are attached
with an inner join and items are ranked by prediction.  Rated items are not
removed (the notebook does not remove them).

Undefined correlations (a constant side) are dropped instead of ranking
first as NaN would (D3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import NOTEBOOK_C, NOTEBOOK_K, NOTEBOOK_MIN_SUPPORT
from ..operators.neighbors import top_k_per_user
from ..operators.predict import predict_abs_weighted
from ..operators.serving import attach_titles
from ..operators.similarity import correlations, pair_moments, subject_pairs


def one_vs_all_corr(ratings: DataFrame, subjects: Sequence[int] | DataFrame) -> DataFrame:
    """r and co-rated count of each subject against every other user (A4)."""
    moments = pair_moments(subject_pairs(ratings, subjects), None)
    return correlations(moments, None)


def one_vs_all_knn(ratings: DataFrame, subjects: Sequence[int] | DataFrame,
                   k: int = NOTEBOOK_K, min_support: int = NOTEBOOK_MIN_SUPPORT) -> DataFrame:
    """k best neighbours per subject with n > min_support."""
    moments = pair_moments(subject_pairs(ratings, subjects), min_support, strict=True)
    return top_k_per_user(correlations(moments, None), k)


def suggest_items(ratings: DataFrame, items: DataFrame,
                  subjects: Sequence[int] | DataFrame, k: int = NOTEBOOK_K,
                  min_support: int = NOTEBOOK_MIN_SUPPORT, c: float = NOTEBOOK_C,
                  digits: int = 6) -> DataFrame:
    """Ranked suggestions per subject: (user, item_id, title, raw_prediction, support, prediction, rank)."""
    knn = one_vs_all_knn(ratings, subjects, k, min_support)
    preds = predict_abs_weighted(knn, ratings, c)
    titled = attach_titles(preds, items, how="inner")
    w = Window.partitionBy("user").orderBy(F.round("prediction", digits).desc(),
                                           F.col("item_id").asc())
    return titled.withColumn("rank", F.row_number().over(w)).select(
        "user", "item_id", "title", "raw_prediction", "support", "prediction", "rank")
