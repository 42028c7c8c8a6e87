"""Work that must not grow with pairs of tiles, rows of lists or candidates: bounded tasks with the same rows."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import ratings_df
from pyspark.sql import functions as F

from rateweave.operators import predict as P
from rateweave.operators import similarity as S
from rateweave.operators.neighbors import top_k_per_user
from rateweave.plans.train import train_neighbors


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def ratings(spark):
    drawn = np.random.default_rng(7).integers(0, 6, (300, 40))
    rows = [(u, i, int(drawn[u, i])) for u in range(300) for i in range(40) if drawn[u, i]]
    return ratings_df(spark, rows).cache()


def test_a_task_keeps_the_k_best_over_all_its_tiles(spark, ratings):
    blocked = S.assign_blocks(ratings.select("user_id", "item_id", "rating"), 1)
    few = S.block_pair_moments(blocked, 10, False, 0.0, 3, tile=10)
    # six strips: a user's lists of a strip pair hold three each, however many pairs of tiles there are
    assert few.count() <= 6 * 3 * 300 * 1.2
    want = top_k_per_user(S.symmetric(S.correlations(S.pair_moments(S.corated_pairs(blocked)), 0.0)), 3)
    assert rows_of(top_k_per_user(S.symmetric(S.correlations(few, 0.0)), 3)) == rows_of(want)


def batch_of(rows, tiles):
    users = sorted({u for u, _, _ in rows})
    lists = [[(i, x) for v, i, x in rows if v == u] for u in users]
    whole = lambda x: pa.array(np.full(len(users), x, np.int32))
    return pa.RecordBatch.from_arrays(
        [whole(0), whole(0), whole(0), pa.array([u % tiles for u in users], pa.int32()), pa.array(users, pa.int64()),
         pa.array([[i for i, _ in x] for x in lists], pa.list_(pa.int64())),
         pa.array([[x for _, x in y] for y in lists], pa.list_(pa.int32()))],
        names=["low", "high", "strip", "tile", "user_id", "items", "ratings"])


@pytest.mark.parametrize("whole_bytes", [0, 1 << 28])
def test_ties_are_no_reason_to_hold_every_pair(whole_bytes):
    rows = [(u, i, 1 + (i * (1 + u % 2)) % 5) for u in range(120) for i in range(12)]  # two kinds of users
    fn = S._tile_moments_fn(10, False, 0.3, 4, "int64", whole_bytes=whole_bytes, most_held=1)
    got = [r for b in fn(iter([batch_of(rows, 6)])) for r in b.to_pylist()]
    assert 0 < len(got) <= 2 * 4 * 120
    best = {}
    for r in got:
        for one, two in ((r["user"], r["neighbor"]), (r["neighbor"], r["user"])):
            best.setdefault(one, []).append(two)
    for u in range(120):
        assert sorted(best[u])[:4] == [v for v in range(120) if v % 2 == u % 2 and v != u][:4]


@pytest.mark.parametrize("whole_bytes", [0, 1 << 28])
def test_held_pairs_take_few_bytes(whole_bytes):
    drawn = np.random.default_rng(5).integers(0, 6, (1500, 16))
    batch = batch_of([(u, i, int(drawn[u, i])) for u in range(1500) for i in range(16) if drawn[u, i]], 15)
    fn = S._tile_moments_fn(4, False, 0.0, 100, "int64", whole_bytes=whole_bytes, most_held=1)
    next(fn(iter([batch])), None)  # what is loaded once
    tracemalloc.start()
    rows = sum(b.num_rows for b in fn(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < rows <= 1500 * 100 * 1.2 and peak < 25_000_000


@pytest.mark.parametrize("make,exact", [
    (lambda d, u, i: int(d[u, i]), True),  # many ties
    (lambda d, u, i: int(d[u, i]) - 3, True),
    (lambda d, u, i: 40 * int(d[u, i]) + (u * i) % 7, True),  # digits need double precision
    (lambda d, u, i: 100_003 * int(d[u, i]), False),  # squares too large for the short form
])
def test_digits_of_three_products_give_the_k_best(make, exact):
    drawn = np.random.default_rng(11).integers(0, 5, (90, 14))
    rows = [(u, i, make(drawn, u, i)) for u in range(90) for i in range(14) if drawn[u, i]]
    rows += [r for r in rows if r[0] % 9 == 0 and r[1] % 2]  # rated twice
    batch = batch_of(rows, 4)
    batch = batch.set_column(2, "strip", pa.array([t % 2 for t in batch["tile"].to_pylist()], pa.int32()))
    batch = batch.set_column(1, "high", pa.array(np.ones(90, np.int32)))
    assert (S._top_pairs_fn(5, 0.1, 3, 1 << 28)(pa.Table.from_batches([batch]).combine_chunks(), 0, 1) is not None) == exact
    sums = {}
    for u, i, x in rows:
        for v, j, y in rows:
            if i == j and u % 2 == 0 and v % 2:
                key = (u, v) if u < v else (v, u)
                p, q = (x, y) if u < v else (y, x)
                sums[key] = [a + b for a, b in zip(sums.get(key, [0] * 6), (1, p, q, p * q, p * p, q * q))]
    want = {}
    for (u, v), (n, sx, sy, sxy, sxx, syy) in sums.items():
        spread = (n * sxx - sx * sx, n * syy - sy * sy)
        if n >= 5 and min(spread) > 0:
            r = round((n * sxy - sx * sy) / (np.sqrt(spread[0]) * np.sqrt(spread[1])), 9)
            if r > 0.1:
                want.setdefault(u, []).append((-r, v))
                want.setdefault(v, []).append((-r, u))
    got, held = {}, {}
    for b in S._tile_moments_fn(5, False, 0.1, 3, "int64")(iter([batch])):
        for r in b.to_pylist():
            key = (r["user"], r["neighbor"])
            assert key not in got
            got[key] = [r[c] for c in S.MOMENT_NAMES]
    assert all(sums[key] == m for key, m in got.items())
    for u, near in want.items():
        for _, v in sorted(near)[:3]:
            held[min(u, v), max(u, v)] = None
    assert held and set(held) <= set(got) and (not exact or len(got) <= len(held) * 1.2)


def test_a_training_task_takes_few_bytes_a_user():
    rng = np.random.default_rng(2)
    users, items = 6144, 100
    drawn = rng.integers(0, 6, (users, items)) * (rng.random((users, items)) < 0.35)
    each = (drawn > 0).sum(axis=1)
    at, i = np.nonzero(drawn)
    whole = lambda x: pa.array(np.full(users, x, np.int32))
    offsets = pa.array(np.concatenate([[0], np.cumsum(each)]).astype(np.int32))
    lists = (pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (i.astype(np.int64), drawn[at, i].astype(np.int32)))
    batch = pa.RecordBatch.from_arrays(
        [whole(0), whole(0), whole(0), pa.array(np.arange(users, dtype=np.int32) % 24), pa.array(np.arange(users, dtype=np.int64)), *lists],
        names=["low", "high", "strip", "tile", "user_id", "items", "ratings"])
    fn = S._tile_moments_fn(10, False, 0.3, 50, "int64")
    tracemalloc.start()
    rows = sum(b.num_rows for b in fn(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows <= 50 * users and peak < 4000 * users


def test_training_has_as_few_strips_as_give_enough_tasks(spark, ratings):
    blocked = S.assign_blocks(ratings.select("user_id", "item_id", "rating"), 1)
    for enough, most, strips in ((3, 100, 3), (3, 20, 8), (None, 100, 13), (200, 100, 13)):
        copies = S.strip_lists(blocked, 2, most, enough).groupBy("user_id").count().select("count").distinct().collect()
        assert [r[0] for r in copies] == [strips]


def test_pairs_leave_a_task_tile_by_tile():
    rows = [(u, i, 1 + (i * u) % 5) for u in range(60) for i in range(12)]
    fn = S._tile_moments_fn(10, False, None, None, "int64")
    out = [b.num_rows for b in fn(iter([batch_of(rows, 6)]))]
    assert sum(out) == 60 * 59 // 2 and max(out) <= 100


def test_half_steps_and_large_ratings_are_summed_in_double(spark):
    for factor, kind in ((0.5, "double"), (100_003, "int")):
        rows = [(u, i, factor * (1 + (u * i * i + 3 * u) % 9)) for u in range(30) for i in range(14)]
        df = ratings_df(spark, [(u, i, 0) for u, i, _ in rows[:1]]).limit(0).select("user_id", "item_id").unionByName(
            spark.createDataFrame([(u, i) for u, i, _ in rows], "user_id long, item_id int"))
        df = df.withColumn("rating", (F.lit(factor) * (1 + (F.col("user_id") * F.col("item_id") * F.col("item_id")
                                                           + 3 * F.col("user_id")) % 9)).cast(kind))
        blocked = S.assign_blocks(df, 1)
        names = ("user", "neighbor", *S.MOMENT_NAMES)
        want = S.pair_moments(S.corated_pairs(blocked)).select(*names)
        assert rows_of(S.block_pair_moments(blocked, tile=7).select(*names)) == rows_of(want)


def test_an_edge_is_one_row_of_the_shuffle_by_user(spark, ratings):
    edges = train_neighbors(ratings, n_blocks=1, min_corr=0.0).cache()
    plan = P.predict_raw(edges, ratings)._jdf.queryExecution().executedPlan().toString()
    by_user = plan.index("hashpartitioning(user#")
    assert 0 <= plan.index("Generate inline") < by_user


def test_scoring_in_small_chunks_is_the_join(spark, ratings):
    repeated = ratings.unionByName(ratings.where("user_id % 7 = 0"))
    edges = train_neighbors(repeated, n_blocks=1, min_corr=0.0)
    joined = P.neighbor_ratings(edges, repeated).withColumn("u", P.corr_units())
    want = joined.groupBy("user", "item_id").agg(
        F.sum(F.col("rating") * F.col("u")), F.sum("u"), F.count(F.lit(1)))
    left = pa.Table.from_pandas(edges.toPandas())
    lists = P.rated_lists(repeated, "user_id").toArrow()
    for chunk in (1, 500, 1 << 21):
        got = P._tile_scores_fn("int64", chunk)(left, lists)
        assert sorted(tuple(r.values()) for r in got.to_pylist()) == rows_of(want)


def test_edges_pass_a_scoring_task_in_batches():
    kinds = {"block": pa.int32(), "mine": pa.int32(), "theirs": pa.int32(), "user": pa.int64(), "neighbor": pa.int64(),
             "corr": pa.float64(), "items": pa.list_(pa.int64()), "ratings": pa.list_(pa.int32())}

    def batch(**columns):
        size = len(columns["neighbor"])
        filler = {"block": [0] * size, "mine": [0] * size, "theirs": [0] * size, "items": [[]] * size, "ratings": [[]] * size}
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, filler.get(c, [None] * size)), t) for c, t in kinds.items()],
                                          names=list(kinds))

    def edges():
        for user in range(400):
            yield batch(user=[user] * 50, neighbor=list(range(50)), corr=[0.5] * 50)

    lists = batch(neighbor=list(range(50)), items=[list(range(n % 7, 200)) for n in range(50)], ratings=[[1 + n % 5] * (200 - n % 7) for n in range(50)])
    other = batch(theirs=[1], user=[3], neighbor=[4], corr=[0.5])  # a group without lists
    fn = P._strip_scores_fn("int64", ["block", "mine", "theirs"])
    want = {i: (sum((1 + n % 5) * 500_000_000 for n in range(50) if i >= n % 7), sum(i >= n % 7 for n in range(50))) for i in range(200)}
    tracemalloc.start()
    rows = 0
    for out in fn(b for part in ([lists], edges(), [other]) for b in part):
        assert all((score, support) == want[item] for item, score, support in zip(*(out[c].to_pylist() for c in ("item_id", "score_u", "support"))))
        rows += out.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 400 * 200 and peak < 4 << 20  # 4 million candidate rows


def test_scoring_sends_block_counts_along(spark, ratings):
    edges = train_neighbors(ratings, n_blocks=1, min_corr=0.0).cache()
    plan = P.recommend_blocked(edges, ratings, 1)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" not in plan and "SortMergeJoin" not in plan


def test_only_users_with_the_two_rarest_items_look_up_the_rest(spark):
    from rateweave.operators import serving as SV

    drawn = np.random.default_rng(3).integers(0, 2, (60, 12))
    rated = {(u, i) for u in range(60) for i in range(12) if drawn[u, i]}
    lists = [(n, (n * k + k * k) % 13) for n in range(40) for k in range(1 + n % 5)]
    got = SV.users_rated_lists(ratings_df(spark, [(u, i, 3) for u, i in rated]),
                               spark.createDataFrame(lists, "list_id long, item_id long"))
    wanted = {}
    for n, i in lists:
        wanted.setdefault(n, set()).add(i)
    want = sorted((n, u) for n, items in wanted.items() for u in range(60) if all((u, i) in rated for i in items))
    assert rows_of(got) == want and len({len(x) for x in wanted.values()}) > 3
    scans = got.inputFiles()
    both = [f for f in scans if "/both-" in f]
    assert both and spark.read.parquet(*both).count() < 1000


def test_counting_headers_scans_the_text_once(spark, tmp_dir):
    from rateweave.sources import text as T

    df = ratings_df(spark, [(u, i, 1 + (u + i) % 5) for u in range(50) for i in range(30)])
    raw = T.scan_ratings_text(spark, T.render_header_blocks(df, f"{tmp_dir}/bronze", n_files=3))
    got = T.parse_header_cumsum(raw)
    assert "csv" not in got._jdf.queryExecution().executedPlan().toString().lower()
    want = sorted((str(u), 1 + (u + i) % 5, str(i)) for u in range(50) for i in range(30))
    assert sorted((r.user_raw, r.rating, r.item_raw) for r in got.collect()) == want
