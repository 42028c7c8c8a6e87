"""Registered queries: ratings, statistics, similarity, neighbours, predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import DEFAULT_VERSION_NEW, DEFAULT_VERSION_OLD, K_NEIGHBORS, QUERY_BLOCKS
from ..operators import predict as P
from ..operators import similarity as S
from ..operators import stats as ST
from ..operators.neighbors import top_k_per_user
from ..session import fresh_path
from ..sources import versioned as V
from ..plans.train import exact_neighbors, recommend_all, train_neighbors
from .registry import Ctx, register, rounded

TOP_N = 10


@register("scan_ratings")
def q_scan_ratings(spark, sf_dir):
    return Ctx(spark, sf_dir).ratings


@register("user_stats")
def q_user_stats(spark, sf_dir):
    return rounded(ST.user_stats(Ctx(spark, sf_dir).ratings))


@register("normalize_ratings")
def q_normalize_ratings(spark, sf_dir):
    c = Ctx(spark, sf_dir, True)
    return rounded(ST.normalize_ratings(c.ratings, ST.user_stats(c.ratings)))


def _dense(spark, sf_dir):
    """Written ratings over few items, as the similarity queries need them."""
    return Ctx(spark, sf_dir, True, dense=True).ratings


def _train(ratings):
    return train_neighbors(ratings, n_blocks=QUERY_BLOCKS)


@register("user_blocks")
def q_user_blocks(spark, sf_dir):
    r = Ctx(spark, sf_dir).ratings
    return S.assign_blocks(r.select("user_id", "item_id", "rating"), QUERY_BLOCKS)


@register("corated_pairs")
def q_corated_pairs(spark, sf_dir):
    r = _dense(spark, sf_dir).select("user_id", "item_id", "rating")
    return S.corated_pairs(S.assign_blocks(r, QUERY_BLOCKS))


@register("pair_moments")
def q_pair_moments(spark, sf_dir):
    """A2 + P11, as matrix products (same rows as the join form)."""
    r = _dense(spark, sf_dir).select("user_id", "item_id", "rating")
    return S.block_pair_moments(S.assign_blocks(r, QUERY_BLOCKS))


@register("user_correlations")
def q_user_correlations(spark, sf_dir):
    return S.block_correlations(_dense(spark, sf_dir), QUERY_BLOCKS)


@register("symmetric_corr")
def q_symmetric_corr(spark, sf_dir):
    return S.symmetric(S.block_correlations(_dense(spark, sf_dir), QUERY_BLOCKS))


@register("top_k_neighbors")
def q_top_k_neighbors(spark, sf_dir):
    sym = S.symmetric(S.block_correlations(_dense(spark, sf_dir), QUERY_BLOCKS, k=K_NEIGHBORS))
    return top_k_per_user(sym, K_NEIGHBORS)


@register("train_neighbors")
def q_train_neighbors(spark, sf_dir):
    """C4: the newest version of the stored user statistics decides who takes part.

    The older version, of the ratings before its date, lacks users and has other deviations.
    """
    r = _dense(spark, sf_dir)
    path = fresh_path(spark, "gold-user-stats")
    before = ST.user_stats(r.where(F.col("rated_at") < F.lit(DEFAULT_VERSION_OLD).cast("timestamp_ntz")))
    stats = ST.user_stats(r)
    V.write_versioned(before, path, DEFAULT_VERSION_OLD)
    V.write_versioned(stats, path, DEFAULT_VERSION_NEW)
    newest = V.latest_version(V.read_versioned(spark, path, stats.schema))
    return train_neighbors(r, n_blocks=QUERY_BLOCKS, stats=newest)


@register("exact_neighbors")
def q_exact_neighbors(spark, sf_dir):
    """C4 over all pairs of users: equal to one block."""
    return exact_neighbors(_dense(spark, sf_dir))


@register("neighbor_ratings")
def q_neighbor_ratings(spark, sf_dir):
    r = _dense(spark, sf_dir)
    return P.neighbor_ratings(_train(r), r)


@register("predict_raw")
def q_predict_raw(spark, sf_dir):
    r = _dense(spark, sf_dir)
    return rounded(P.predict_raw(_train(r), r))


@register("predict_penalized")
def q_predict_penalized(spark, sf_dir):
    r = _dense(spark, sf_dir)
    out = P.penalize(P.predict_raw(_train(r), r))
    return rounded(out.select("user", "item_id", "support", "raw_rating", "user_mean", "rating"))


@register("exclude_rated")
def q_exclude_rated(spark, sf_dir):
    r = _dense(spark, sf_dir)
    preds = P.penalize(P.predict_raw(_train(r), r))
    return rounded(P.exclude_rated(preds, r).select("user", "item_id", "rating"))


@register("recommend_all")
def q_recommend_all(spark, sf_dir):
    return rounded(recommend_all(Ctx(spark, sf_dir, dense=True).ratings, n_blocks=QUERY_BLOCKS))


@register("top_n_recommendations")
def q_top_n(spark, sf_dir):
    preds = recommend_all(Ctx(spark, sf_dir, dense=True).ratings, n_blocks=QUERY_BLOCKS)
    return rounded(P.top_n(preds.select("user", "item_id", "rating"), TOP_N))


@register("distinct_users")
def q_distinct_users(spark, sf_dir):
    return ST.distinct_users(Ctx(spark, sf_dir).ratings).orderBy("user_id")


@register("distinct_items")
def q_distinct_items(spark, sf_dir):
    return ST.distinct_items(Ctx(spark, sf_dir).ratings)


@register("profile_ratings")
def q_profile_ratings(spark, sf_dir):
    r = Ctx(spark, sf_dir).ratings
    return rounded(ST.profile(r, ["user_id", "item_id", "rating"]))


@register("range_sum")
def q_range_sum(spark, sf_dir):
    """Integer range source (S7) sized by the data, summed without keys.

    The range is 1..(distinct users): it grows with the tables, and its sum
    n(n+1)/2 stays inside bigint for up to ~4e9 users (sizing it by ratings
    would overflow at 100 TB).
    """
    n = Ctx(spark, sf_dir).ratings.select("user_id").distinct().count()  # one scalar
    return spark.range(1, n + 1).agg(F.sum("id").alias("total"))


@register("peek_rows")
def q_peek_rows(spark, sf_dir):
    """First rows in a total order (S6): limit is the feature here."""
    return Ctx(spark, sf_dir).ratings.orderBy("user_id", "item_id").limit(10)
