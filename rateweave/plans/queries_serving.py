"""Registered queries: serving tables, notebook form and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import DEFAULT_SUBJECT_USERS, PAGE_SIZE, QUERY_BLOCKS
from ..operators import lookups as L
from ..operators import serving as SV
from ..operators.predict import predict_abs_weighted, recommend_blocked, recommend_for_users
from ..operators.similarity import subject_correlations, subject_pairs
from ..session import fresh_path
from ..sources import versioned as V
from ..sources.views import read_table
from . import notebook as NB
from .registry import Ctx, register, rounded
from .train import model_versions, recommend_all

SUBJECTS = list(DEFAULT_SUBJECT_USERS)
LIST_PAGE = 2


def _order_items(spark, sf_dir):
    """The items of the order with the smallest key, at most a few lines."""
    lines = read_table(spark, sf_dir, "lineitem")
    first = lines.agg(F.min("l_orderkey")).scalar()
    return [r[0] for r in lines.where(F.col("l_orderkey") == first).select("l_partkey").distinct().collect()]


def _most_rated(ratings):
    """The item with the most ratings, the smallest of equals."""
    counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return [r[0] for r in counts.orderBy(F.desc("n"), "item_id").limit(1).collect()]


@register("users_rated_all")
def q_users_rated_all(spark, sf_dir):
    return SV.users_rated_all(Ctx(spark, sf_dir).ratings, _order_items(spark, sf_dir))


@register("users_rated_lists")
def q_users_rated_lists(spark, sf_dir):
    """A7 for every order's parts as a list."""
    lists = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("list_id"), F.col("l_partkey").cast("bigint").alias("item_id"))
    return SV.users_rated_lists(Ctx(spark, sf_dir).ratings, lists)


@register("users_page")
def q_users_page(spark, sf_dir):
    r = Ctx(spark, sf_dir, True).ratings
    return SV.users_page(r, _most_rated(r), LIST_PAGE, PAGE_SIZE)


@register("items_page")
def q_items_page(spark, sf_dir):
    return SV.items_page(Ctx(spark, sf_dir).items, LIST_PAGE, PAGE_SIZE)


@register("rated_items_page")
def q_rated_items_page(spark, sf_dir):
    c = Ctx(spark, sf_dir, True)
    return SV.rated_items_pages(c.ratings, c.items, PAGE_SIZE)


@register("paged_recommendations")
def q_paged_recommendations(spark, sf_dir):
    c = Ctx(spark, sf_dir, True, dense=True)
    recs = recommend_all(c.ratings, n_blocks=QUERY_BLOCKS, checkpoint_input=False)
    return rounded(SV.recommendation_pages(recs, c.items, PAGE_SIZE))


@register("page_meta")
def q_page_meta(spark, sf_dir):
    c = Ctx(spark, sf_dir, dense=True)
    return SV.page_meta(recommend_all(c.ratings, n_blocks=QUERY_BLOCKS), PAGE_SIZE)


@register("attach_titles")
def q_attach_titles(spark, sf_dir):
    c = Ctx(spark, sf_dir, True)
    return SV.attach_titles(c.ratings.select("user_id", "item_id", "rating"), c.items)


@register("best_rated_items")
def q_best_rated_items(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return L.best_rated_items(c.ratings, c.items, SUBJECTS)


@register("one_vs_all_pairs")
def q_one_vs_all_pairs(spark, sf_dir):
    return subject_pairs(Ctx(spark, sf_dir, dense=True).ratings, SUBJECTS)


@register("one_vs_all_corr")
def q_one_vs_all_corr(spark, sf_dir):
    return NB.one_vs_all_corr(Ctx(spark, sf_dir, dense=True).ratings, SUBJECTS)


@register("one_vs_all_knn")
def q_one_vs_all_knn(spark, sf_dir):
    return NB.one_vs_all_knn(Ctx(spark, sf_dir, dense=True).ratings, SUBJECTS)


@register("predict_abs_weighted")
def q_predict_abs_weighted(spark, sf_dir):
    r = Ctx(spark, sf_dir, True, dense=True).ratings
    return rounded(predict_abs_weighted(NB.one_vs_all_knn(r, SUBJECTS), r))


@register("suggest_items")
def q_suggest_items(spark, sf_dir):
    c = Ctx(spark, sf_dir, True, dense=True)
    return rounded(NB.suggest_items(c.ratings, c.items, SUBJECTS))


@register("subset_correlations")
def q_subset_correlations(spark, sf_dir):
    return subject_correlations(Ctx(spark, sf_dir, dense=True).ratings, SUBJECTS)


@register("both_users_items")
def q_both_users_items(spark, sf_dir):
    """J4 for the first two users of the most rated item."""
    r = Ctx(spark, sf_dir, True).ratings
    pair = [u[0] for u in SV.users_rated_all(r, _most_rated(r)).orderBy("user_id").limit(2).collect()]
    return L.both_users_items(r, *pair)


@register("filter_user")
def q_filter_user(spark, sf_dir):
    return L.filter_user(Ctx(spark, sf_dir).ratings, SUBJECTS[0])


@register("user_ratings_multi")
def q_user_ratings_multi(spark, sf_dir):
    return L.user_ratings(Ctx(spark, sf_dir).ratings, SUBJECTS)


@register("pair_lookup")
def q_pair_lookup(spark, sf_dir):
    s = SUBJECTS
    return L.pair_lookup(spark, Ctx(spark, sf_dir, dense=True).ratings,
                         [(s[0], s[1]), (s[0], s[2]), (s[1], s[2])])


def _stored_model(spark, ratings):
    """K4: the neighbours as of two dates, trained and written one after the other; the newest read back."""
    return V.latest_version(model_versions(spark, ratings)).drop("version_date")


@register("recommend_stored_model")
def q_recommend_stored_model(spark, sf_dir):
    """C5 from the stored model: its newest version scores every user."""
    r = Ctx(spark, sf_dir, True, dense=True).ratings
    return rounded(recommend_blocked(_stored_model(spark, r), r, QUERY_BLOCKS))


@register("recommend_for_users")
def q_recommend_for_users(spark, sf_dir):
    """C5 per request: the stored model scores the subject users only."""
    r = Ctx(spark, sf_dir, True, dense=True).ratings
    return rounded(recommend_for_users(_stored_model(spark, r), r, SUBJECTS))


@register("users_page_seek")
def q_users_page_seek(spark, sf_dir):
    """C7's last page by key: the page index names the files that hold it."""
    path = SV.write_pages(Ctx(spark, sf_dir).ratings.select("user_id").distinct(), "user_id",
                          fresh_path(spark, "user-pages"), PAGE_SIZE)
    last = SV.page_count(spark, path)
    return SV.seek_page(spark, path, last).select("user_id", "page")


@register("users_pages_all")
def q_users_pages_all(spark, sf_dir):
    """C7 for every page at once: distributed global rank, no single-task window."""
    return SV.users_pages(Ctx(spark, sf_dir).ratings, [], PAGE_SIZE)
