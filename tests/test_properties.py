
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import bruteforce as BF
from conftest import SF_SMALL, ratings_df
from rateweave.constants import DENSE_ITEMS
from rateweave.operators.predict import recommend
from rateweave.operators.similarity import block_correlations, symmetric
from rateweave.plans.train import train_neighbors
from rateweave.sources.views import load_ratings


@pytest.fixture(scope="module")
def small(spark):
    r = load_ratings(spark, SF_SMALL, DENSE_ITEMS).cache()
    rows = [(x.user_id, x.item_id, x.rating) for x in r.select("user_id", "item_id", "rating").collect()]
    return r, rows


@pytest.mark.parametrize("tile", [1024, 20])
def test_neighbors_equal_bruteforce(spark, small, tile):
    r, rows = small
    want = BF.neighbors(rows, n_blocks=2)
    got = {}
    for x in train_neighbors(r, n_blocks=2, method="mod", tile=tile).collect():
        got.setdefault(x.user, []).append((x.neighbor, x.corr))
    for u in got:
        got[u].sort(key=lambda t: (-t[1], t[0]))
    assert got == want


def test_predictions_equal_bruteforce(spark, small):
    r, rows = small
    edges = BF.neighbors(rows, n_blocks=2)
    want = BF.recommend(rows, edges)
    recs = recommend(train_neighbors(r, n_blocks=2, method="mod"), r).collect()
    got = {}
    for x in recs:
        got.setdefault(x.user, {})[x.item_id] = x.rating
    assert set(got) == {u for u, p in want.items() if p}
    for u, preds in got.items():
        assert set(preds) == set(want[u])
        for i, v in preds.items():
            assert v == pytest.approx(want[u][i], abs=1e-9)


def test_edge_properties(spark, small):
    r, _ = small
    half = block_correlations(r, n_blocks=1, min_corr=None)
    rows = half.collect()
    assert all(-1.0 <= x.corr <= 1.0 for x in rows)
    assert all(x.user < x.neighbor for x in rows)
    sym = symmetric(half)
    a = sym.select("user", "neighbor", "corr")
    b = sym.select(F.col("neighbor").alias("user"), F.col("user").alias("neighbor"), "corr")
    assert a.exceptAll(b).count() == 0
    k = 5
    top = train_neighbors(r, k=k, n_blocks=1)
    assert top.groupBy("user").count().agg(F.max("count")).first()[0] <= k


def test_blocking_only_removes_edges(spark, small):
    r, _ = small
    full = block_correlations(r, n_blocks=1).select("user", "neighbor", "corr")
    split = block_correlations(r, n_blocks=4).select("user", "neighbor", "corr")
    assert split.exceptAll(full).count() == 0
    assert split.count() < full.count()


def test_predictions_in_range(spark, small):
    r, _ = small
    recs = recommend(train_neighbors(r, n_blocks=1), r)
    lo, hi = recs.agg(F.min("rating"), F.max("rating")).first()
    assert 1.0 <= lo <= hi <= 5.0
    rated = r.select(F.col("user_id").alias("user"), "item_id")
    assert recs.join(rated, ["user", "item_id"]).count() == 0


ratings_strategy = st.dictionaries(
    keys=st.tuples(st.integers(1, 9), st.integers(0, 11)),
    values=st.integers(1, 5), min_size=4, max_size=80)


@settings(max_examples=12, deadline=None)
@given(ratings_strategy)
def test_random_fixtures_match_bruteforce(spark, data):
    rows = [(u, i, v) for (u, i), v in sorted(data.items())]
    want = BF.neighbors(rows, k=3, min_support=3, min_corr=0.0)
    r = ratings_df(spark, rows)
    for tile in (1024, 2):
        got = {}
        for x in train_neighbors(r, k=3, n_blocks=1, min_support=3, min_corr=0.0,
                                 tile=tile).collect():
            got.setdefault(x.user, []).append((x.neighbor, x.corr))
        for u in got:
            got[u].sort(key=lambda t: (-t[1], t[0]))
        assert got == want


def test_fixture_counts_with_modulo_blocks(spark):
    """FIXTURES.md section 3: sf0.01, blocks user_id % 4 -> 46,311 edges, 95,961 predictions."""
    from conftest import SF_MID
    from rateweave.plans.train import recommend_all

    r = load_ratings(spark, SF_MID, DENSE_ITEMS)
    for tile in (1024, 100):
        assert train_neighbors(r, n_blocks=4, method="mod", tile=tile).count() == 46311
    recs = recommend_all(r, n_blocks=4, method="mod")
    n, mean = recs.agg(F.count("*"), F.avg("rating")).first()
    assert n == 95961
    assert round(mean, 6) == 2.992615


def test_mix_blocks_are_balanced_for_patterned_ids(spark):
    from rateweave.functions.columns import block_of

    users = spark.range(1, 15001).selectExpr("id * 30 AS user_id")  # all multiples of n
    sizes = users.groupBy(block_of("user_id", 30, "mix").alias("b")).count()
    lo, hi, nb = sizes.agg(F.min("count"), F.max("count"), F.count("*")).first()
    assert nb == 30 and hi < 2 * lo


def test_zscore_correlation_equals_integer_correlation(spark, small):
    """Pearson r is invariant to the per-user z-score map (D19): same r to 1e-9."""
    from rateweave.operators.similarity import correlations, pair_moments, subject_pairs
    from rateweave.operators.stats import normalize_ratings, user_stats

    r, _ = small
    subjects = [1, 2, 3, 4, 5]
    ints = correlations(pair_moments(subject_pairs(r, subjects), 5), None)
    z = normalize_ratings(r, user_stats(r)).select("user_id", "item_id", F.col("z").alias("rating"))
    floats = correlations(pair_moments(subject_pairs(z, subjects), 5), None)
    a = {(x.user, x.neighbor): x.corr for x in ints.collect()}
    b = {(x.user, x.neighbor): x.corr for x in floats.collect()}
    assert a.keys() == b.keys() and len(a) > 100
    assert max(abs(a[k] - b[k]) for k in a) < 1e-8


@pytest.mark.parametrize("tile", [1024, 20])
def test_skewed_fixture_matches_bruteforce(spark, tile):
    """A hot item rated by every user and a power user who rated every item."""
    import random

    rnd = random.Random(5)
    rows = {}
    for u in range(1, 301):
        rows[(u, 0)] = rnd.randint(1, 5)                      # hot item
        for i in rnd.sample(range(1, 40), rnd.randint(8, 25)):
            rows[(u, i)] = rnd.randint(1, 5)
    for i in range(40):
        rows[(7, i)] = 1 + i % 5                              # power user
    data = [(u, i, v) for (u, i), v in sorted(rows.items())]
    want = BF.neighbors(data, k=10, min_support=5, min_corr=0.2, n_blocks=3)
    got = {}
    for x in train_neighbors(ratings_df(spark, data), k=10, n_blocks=3, method="mod",
                             min_support=5, min_corr=0.2, tile=tile).collect():
        got.setdefault(x.user, []).append((x.neighbor, x.corr))
    for u in got:
        got[u].sort(key=lambda t: (-t[1], t[0]))
    assert got == want


AWKWARD = [(u, i, 0.5 * (1 + (u * 7 + i * 3) % 9)) for u in range(1, 40) for i in range(u % 4, 15)] \
    + [(u, i, 0.5 * (1 + (u + i) % 9)) for u in range(1, 40, 3) for i in range(0, 15, 2)]


def awkward(spark, kind):
    """Ratings in half steps or whole ones, many of them repeated with another value."""
    rows = [(u, i, v if kind == "double" else int(2 * v)) for u, i, v in AWKWARD]
    return spark.createDataFrame(rows, f"user_id long, item_id int, rating {kind}"), rows


def brute_edges(rows, min_support=5, min_corr=0.0):
    """Correlations over the rows of the self join on items, repeats included."""
    by = {}
    for u, i, v in rows:
        by.setdefault(u, []).append((i, v))
    out = {}
    for a in by:
        for b in by:
            if a != b:
                pairs = [(x, y) for i, x in by[a] for j, y in by[b] if i == j]
                if len(pairs) >= min_support:
                    r = BF.pearson(*zip(*pairs))
                    if r is not None and round(r, 9) > min_corr:
                        out[a, b] = round(r, 9)
    return out


@pytest.mark.parametrize("kind", ["double", "int"])
@pytest.mark.parametrize("tile", [1024, 7])
def test_half_steps_and_repeats_in_training(spark, kind, tile):
    r, rows = awkward(spark, kind)
    want = brute_edges(rows)
    got = train_neighbors(r, k=100, n_blocks=1, min_support=5, min_corr=0.0, tile=tile).collect()
    assert {(x.user, x.neighbor): x.corr for x in got} == pytest.approx(want, abs=2e-9)
    assert len(got) == len(want) > 100


@pytest.mark.parametrize("kind", ["double", "int"])
def test_half_steps_and_repeats_in_prediction(spark, kind):
    from rateweave.operators.predict import (predict_abs_weighted, predict_raw, recommend_blocked,
                                             recommend_for_users)

    r, rows = awkward(spark, kind)
    edges = train_neighbors(r, k=6, n_blocks=1, min_support=5, min_corr=0.0)
    near = [(x.user, x.neighbor, x.corr) for x in edges.collect()]
    want = {}
    for u, n, c in near:
        for v, i, x in rows:
            if v == n:
                s = want.setdefault((u, i), [0.0, 0.0, 0])
                s[0], s[1], s[2] = s[0] + x * c, s[1] + c, s[2] + 1
    for f in (predict_raw, predict_abs_weighted):
        name = "raw_rating" if f is predict_raw else "raw_prediction"
        got = {(x["user"], x["item_id"]): (x[name], x["support"]) for x in f(edges, r).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == (pytest.approx(s[0] / s[1]), s[2]) for k, s in want.items())
    means = {}
    for (u, _), s in want.items():
        means.setdefault(u, []).append(s[0] / s[1])
    rated = {(u, i) for u, i, _ in rows}
    final = {}
    for (u, i), s in want.items():
        mean = sum(means[u]) / len(means[u])
        final[u, i] = min(5.0, max(1.0, mean + (s[0] / s[1] - mean) * s[2] / (s[2] + 5)))
    for drop in (True, False):
        keep = {k: v for k, v in final.items() if not drop or k not in rated}
        forms = [recommend(edges, r, drop_rated=drop), recommend_blocked(edges, r, 1, drop_rated=drop),
                 recommend_blocked(edges, r, 1, drop_rated=drop, tile=5, near_tile=7),
                 recommend_for_users(edges, r, list(range(1, 40)), drop_rated=drop)]
        for df in forms:
            assert {(x.user, x.item_id): x.rating for x in df.collect()} == pytest.approx(keep, abs=1e-9)


def test_join_moments_equal_tile_moments(spark, small):
    from rateweave.operators.similarity import (assign_blocks, block_pair_moments,
                                                corated_pairs, pair_moments)

    r, _ = small
    for df, n in ((r.select("user_id", "item_id", "rating"), 2), (awkward(spark, "int")[0], 1),
                  (awkward(spark, "double")[0], 1)):
        blocked = assign_blocks(df, n)
        for support, strict, tile in ((10, False, 1024), (10, True, 16), (None, False, 9)):
            a = pair_moments(corated_pairs(blocked), support, strict)
            b = block_pair_moments(blocked, support, strict, tile=tile)
            assert a.count() > 0
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scoring_in_blocks_equals_join_scoring(spark, small):
    from rateweave.operators.predict import recommend_blocked

    r, _ = small
    edges = train_neighbors(r, n_blocks=2).cache()
    cols = ["user", "item_id", "score", "corr_sum", "support",
            "round(raw_rating, 9) AS raw", "round(user_mean, 9) AS m", "round(rating, 9) AS rt"]
    for drop, tile in ((True, 512), (False, 10)):
        a = recommend(edges, r, drop_rated=drop).selectExpr(*cols)
        b = recommend_blocked(edges, r, 2, drop_rated=drop, tile=tile, near_tile=3 * tile).selectExpr(*cols)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_more_user_changes_no_other_correlation(spark):
    """500 and 501 users: blocks do not follow from the size of the table."""
    def ratings(n):
        u, i = F.col("id") % n + 1, F.floor(F.col("id") / n)
        return spark.range(0, n * 30).select(u.alias("user_id"), i.alias("item_id"),
                                              (F.pmod(F.xxhash64(u, i), F.lit(5)) + 1).cast("int").alias("rating"))

    a = block_correlations(ratings(500), 3).select("user", "neighbor", "corr")
    b = block_correlations(ratings(501), 3).where("neighbor <= 500").select("user", "neighbor", "corr")
    assert a.count() > 500 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_catalogue_above_twenty_thousand_items(spark):
    from rateweave.operators.predict import recommend_blocked

    u, i = F.col("id") % 12, F.floor(F.col("id") / 12)
    r = spark.range(0, 12 * 25_000).where(F.pmod(F.xxhash64(u, i), F.lit(3)) > 0).select(
        u.alias("user_id"), i.alias("item_id"), (F.pmod(F.xxhash64(i, u, u), F.lit(5)) + 1).cast("int").alias("rating"))
    edges = train_neighbors(r, n_blocks=1, min_corr=0.0).cache()
    cols = ["user", "item_id", "score", "corr_sum", "support", "round(rating, 9) AS rt"]
    a, b = recommend(edges, r).selectExpr(*cols), recommend_blocked(edges, r, 1, tile=4, near_tile=5).selectExpr(*cols)
    assert a.count() > 20_000 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("method", ["hash", "mix"])
def test_other_block_methods_match_bruteforce(spark, small, method):
    from rateweave.functions.columns import block_of

    r, rows = small
    users = r.select("user_id").distinct()
    blocks = {x.user_id: x.b for x in users.select("user_id", block_of("user_id", 3, method).alias("b")).collect()}
    want = BF.neighbors(rows, n_blocks=3, block_of=blocks)
    got = {}
    for x in train_neighbors(r, n_blocks=3, method=method).collect():
        got.setdefault(x.user, []).append((x.neighbor, x.corr))
    for u in got:
        got[u].sort(key=lambda t: (-t[1], t[0]))
    assert got == want


def test_recommend_for_users_equals_batch_rows(spark, small):
    from rateweave.operators.predict import recommend_for_users

    r, _ = small
    edges = train_neighbors(r, n_blocks=2)
    cols = ["user", "item_id", "support", "round(rating, 9) AS rt"]
    a = recommend_for_users(edges, r, [3, 5, 8]).selectExpr(*cols)
    b = recommend(edges, r).where("user IN (3, 5, 8)").selectExpr(*cols)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_train_for_users_equals_full_training_rows(spark, small):
    from rateweave.plans.train import train_neighbors_for

    r, _ = small
    ids = [3, 5, 8, 100]
    a = train_neighbors_for(r, ids, n_blocks=4)
    b = train_neighbors(r, n_blocks=4).where(F.col("user").isin(ids))
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
