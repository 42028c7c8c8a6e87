"""Strips, exact neighbours, one-scan parsing, incremental files, merged statistics and stored tables."""

import os
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL, ratings_df
from pyspark.sql import functions as F

from rateweave.operators import serving as SV
from rateweave.operators import similarity as S
from rateweave.operators.stats import merge_moments, normalize_ratings, stats_of_moments, user_moments, user_stats
from rateweave.plans.train import exact_neighbors, recommend_all, train_neighbors
from rateweave.sources import text as T
from rateweave.sources import versioned as V
from rateweave.sources.views import load_ratings


@pytest.fixture(scope="module")
def dense(spark):
    return V.materialize(load_ratings(spark, SF_SMALL, 100), "dense")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- strips and exact neighbours ------------------------------------------------

@pytest.mark.parametrize("tile,strip", [(1024, 32), (9, 3), (9, 100), (40, 1)])
def test_strips_give_the_moments_of_the_self_join(spark, dense, tile, strip):
    blocked = S.assign_blocks(dense.select("user_id", "item_id", "rating"), 2)
    names = ("user", "neighbor", *S.MOMENT_NAMES)
    want = S.pair_moments(S.corated_pairs(blocked)).select(*names)
    assert rows_of(S.block_pair_moments(blocked, tile=tile, strip=strip).select(*names)) == rows_of(want)


def test_ratings_travel_once_a_strip(spark, dense):
    blocked = S.assign_blocks(dense.select("user_id", "item_id", "rating"), 1)
    users = dense.select("user_id").distinct().count()
    for tile in (2, 8, 32):
        tiles = -(-users // tile)
        strips = int(np.ceil(np.sqrt(tiles)))
        copies = S.strip_pairs(blocked, tile).groupBy("user_id", "item_id").count()
        assert {r[0] for r in copies.select("count").distinct().collect()} == {strips}
    held = S.strip_pairs(blocked, 2, most=4).groupBy("strip").agg(F.count_distinct("tile")).collect()
    assert max(r[1] for r in held) <= 4


def test_exact_neighbors_are_those_of_one_block(spark, dense):
    one = rows_of(train_neighbors(dense, n_blocks=1))
    assert one and rows_of(exact_neighbors(dense, tile=20)) == one


def test_users_below_the_support_are_pruned_and_repeats_are_not(spark):
    few = [(1, i, 1 + i % 5) for i in range(9)]
    many = [(u, i, 1 + (i * u) % 5) for u in (2, 3, 4) for i in range(12)]
    df = ratings_df(spark, few + many)
    assert {r[0] for r in S.able_users(df, 10).select("user_id").distinct().collect()} == {2, 3, 4}
    counts = {r["step"]: r["n"] for r in S.pair_counts(df).collect()}
    assert counts == {"users": 4, "able users": 3, "compared pairs": 3, "supported pairs": 3}
    # three ratings of an item against four are a support of twelve
    twice = [(5, 1, 1), (5, 1, 2), (5, 2, 3), *[(6, 1, x) for x in (1, 2, 4, 5)], (6, 2, 5), (6, 2, 1)]
    got = S.block_correlations(ratings_df(spark, twice), 1, min_corr=None)
    assert [(r["user"], r["neighbor"], r["n"]) for r in got.collect()] == [(5, 6, 10)]


def test_pairs_that_share_too_little_are_not_compared(spark):
    # two groups of users without a common item
    apart = [(u, 100 * (u % 2) + i, 1 + (i + u) % 5) for u in range(40) for i in range(12)]
    df = ratings_df(spark, apart)
    counts = {r["step"]: r["n"] for r in S.pair_counts(df, tile=4).collect()}
    assert counts["supported pairs"] == 2 * 20 * 19 // 2
    assert counts["supported pairs"] <= counts["compared pairs"] <= 40 * 39 // 2


def test_scoring_strips(spark, dense):
    from rateweave.operators.predict import recommend, recommend_blocked
    edges = V.materialize(train_neighbors(dense, n_blocks=1), "edges")

    def close(df):  # means are summed in any order
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())

    want = close(recommend(edges, dense))
    for tile, near in ((5, 40), (64, 4096)):
        assert close(recommend_blocked(edges, dense, 1, tile=tile, near_tile=near)) == want
    assert want == close(recommend_all(dense, n_blocks=1))


# -- text -------------------------------------------------------------------------

def test_the_text_is_scanned_once(spark, tmp_dir):
    path = T.render_header_blocks(load_ratings(spark, SF_SMALL), f"{tmp_dir}/bronze", n_files=3)
    raw = T.scan_ratings_text(spark, path)
    plan = plan_of(T.filled_lines(raw))
    assert len(re.findall(r"FileScan csv|Scan csv", plan)) == 1 and "Broadcast" not in plan
    plan = plan_of(T.parse_header_blocks(raw))
    assert "csv" not in plan and "parquet" in plan
    assert "ResolvedHint" not in T.parse_header_blocks(raw)._jdf.queryExecution().logical().toString()


def test_markers_hand_headers_over_splits(spark):
    lines = [(1, 0, "5", 1), (1, 0, "a:", None), (1, 0, "6", 2), (1, 10, "7", 3), (1, 20, "b:", None), (1, 30, "8", 4), (1, 30, "c:", None),
             (2, 0, "9", 5)]
    raw = spark.createDataFrame([(f, s, u, r, None) for f, s, u, r in lines],
                                "file long, split long, user_raw string, rating int, rated_on date").coalesce(1)
    for size in ("1", "3", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = {r["user_raw"]: r["item_raw"] for r in T.parse_header_blocks(raw).collect()}
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == {"5": None, "6": "a", "7": "a", "8": "b", "9": None}


def test_faulty_lines_do_not_break_their_block(spark, tmp_dir):
    ratings = load_ratings(spark, SF_SMALL)
    path = T.render_header_blocks(ratings, f"{tmp_dir}/bronze", faulty=True)
    counts = T.write_silver(T.parse_header_blocks(T.scan_ratings_text(spark, path)), f"{tmp_dir}/good", f"{tmp_dir}/bad")
    good, bad = spark.read.parquet(f"{tmp_dir}/good"), spark.read.parquet(f"{tmp_dir}/bad")
    assert counts == {"lines": ratings.count(), "valid": good.count(), "rejected": bad.count()}
    assert rows_of(good) == rows_of(ratings.where("rating > 3").withColumn("rated_at", F.to_date("rated_at")))
    assert bad.where("item_id IS NULL").count() == 0 and bad.count() == ratings.where("rating <= 3").count()


def _file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_ingestion_reads_new_files_only(spark, tmp_dir):
    source, table, state = f"{tmp_dir}/in", f"{tmp_dir}/table", f"{tmp_dir}/state"
    _file(source, "part-1", ["1:", "10,3,2005-09-06", "bad,3,2005-09-06", "2:", "11,4,2005-09-07"])
    _file(source, "other", ["9:", "99,1,2005-09-06"])
    assert T.ingest_new_files(spark, source, table, state, "a") == 5
    assert T.ingest_new_files(spark, source, table, state, "b") == 0
    _file(source, "part-2", ["12,1,2005-09-08", "1:", "12,5,2005-09-08"])
    assert T.ingest_new_files(spark, source, table, state, "c") == 3
    typed = T.ingested_ratings(spark, table)
    good = sorted((r["user_id"], r["item_id"], r["rating"], r["run"]) for r in typed.where("ok").collect())
    assert good == [(10, 1, 3, "a"), (11, 2, 4, "a"), (12, 1, 5, "c")]
    assert {(r["user_id"], r["item_id"], r["run"]) for r in typed.where("NOT ok").collect()} == {(None, 1, "a"), (12, None, "c")}


# -- statistics kept up by merging ------------------------------------------------------

def test_merged_moments_equal_a_recompute(spark):
    rng = np.random.default_rng(5)
    rows = [(int(u), i, float(rng.integers(1, 11)) / 2) for i in range(300) for u in (rng.integers(0, 12),)]
    df = spark.createDataFrame(rows, "user_id long, item_id int, rating double")
    parts = [df.where((F.col("item_id") % 3 == k) & ((F.col("user_id") != 4) | (F.lit(k) == 1))) for k in range(3)]
    kept = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = user_moments(parts[0])
    for more in parts[1:]:
        merged = merge_moments(merged, user_moments(more))
    got = {r["user_id"]: r for r in stats_of_moments(merged).collect()}
    want = {r["user_id"]: r for r in user_stats(kept).collect()}
    assert got.keys() == want.keys()
    for user, w in want.items():
        g = got[user]
        assert g["rated_items"] == w["rated_items"] and g["max_rating"] == w["max_rating"] and g["min_rating"] == w["min_rating"]
        assert g["mean_rating"] == pytest.approx(w["mean_rating"], abs=1e-12)
        assert g["std_rating"] == pytest.approx(w["std_rating"], abs=1e-9)


def test_merging_with_nothing(spark):
    df = ratings_df(spark, [(1, 1, 3), (1, 2, 5), (2, 1, 4)])
    none = user_moments(df.limit(0))
    want = rows_of(user_stats(df))
    for a, b in ((user_moments(df), none), (none, user_moments(df))):
        assert rows_of(stats_of_moments(merge_moments(a, b))) == want
    assert stats_of_moments(merge_moments(none, none)).count() == 0


# -- stored tables -------------------------------------------------------------------------

def test_stored_tables_join_where_they_lie(spark):
    ratings = load_ratings(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = normalize_ratings(V.write_bucketed(ratings, ["user_id"]), V.write_bucketed(user_stats(ratings), ["user_id"]))
        assert "Exchange" not in plan_of(joined)
        assert rows_of(joined) == rows_of(normalize_ratings(ratings, user_stats(ratings)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("chunk_rows", [1, 60, 1000])
def test_pages_by_number(spark, tmp_dir, chunk_rows):
    users = spark.range(7, 7 + 3 * 205, 3).withColumnRenamed("id", "user_id").repartition(5)
    path = SV.write_pages(users, "user_id", tmp_dir, 20, chunk_rows)
    ids = [7 + 3 * i for i in range(205)]
    assert SV.page_count(spark, path) == 11
    for page in (1, 2, 7, 11):
        got = SV.seek_page(spark, path, page)
        assert [r["user_id"] for r in got.orderBy("user_id").collect()] == ids[20 * (page - 1):20 * page]
        assert {r["page"] for r in got.collect()} == {page}
        # the folder of the page's chunk is all that is listed
        assert re.search(r"PartitionFilters: \[[^\]]*chunk", plan_of(got))
        files = got.select(F.input_file_name()).distinct().count()
        assert files <= 2
    assert SV.seek_page(spark, path, 12).count() == 0


def test_pages_of_an_empty_list(spark, tmp_dir):
    path = SV.write_pages(spark.range(0).withColumnRenamed("id", "user_id"), "user_id", tmp_dir)
    assert SV.page_count(spark, path) == 0
    with pytest.raises(ValueError):
        SV.seek_page(spark, path, 1)


# -- division for many lists -------------------------------------------------------------------

def test_division_by_many_lists(spark):
    rng = np.random.default_rng(3)
    rated = {(int(u), int(i)) for u, i in zip(rng.integers(0, 25, 220), rng.zipf(1.6, 220) % 12)}
    lists = [(k, int(i)) for k in range(40) for i in rng.integers(0, 13, 1 + k % 4)] + [(3, 1), (3, 1), (50, 99), (None, 1), (51, None)]
    ratings = spark.createDataFrame([(u, i, 3) for u, i in sorted(rated)], "user_id long, item_id long, rating int")
    got = rows_of(SV.users_rated_lists(ratings, spark.createDataFrame(lists, "list_id long, item_id long")))
    items = defaultdict(set)
    for k, i in lists:
        if k is not None and i is not None:
            items[k].add(i)
    want = sorted((k, u) for k, held in items.items() for u in range(25) if all((u, i) in rated for i in held))
    assert want and got == want


def test_division_by_no_lists(spark):
    ratings = ratings_df(spark, [(1, 1, 3)])
    none = spark.createDataFrame([], "list_id long, item_id int")
    assert SV.users_rated_lists(ratings, none).count() == 0
    some = spark.createDataFrame([(1, 1)], "list_id long, item_id int")
    assert SV.users_rated_lists(ratings.limit(0), some).count() == 0
