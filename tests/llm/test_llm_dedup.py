import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import collected, docs, empty, rows
from xxhash import xxh64_intdigest

from rateweave.llm.components import components
from rateweave.llm.embeddings import embedding_groups, even, quantised
from rateweave.llm.exact import drop_exact_duplicates, exact_groups, golomb_decode, golomb_encode, runs_of, suspects_of
from rateweave.llm.simhash import drop_near_duplicates, near_groups, near_pairs, simhash

UP = {i: i + 32 for i in range(65, 91)}


def reach(nodes, linked):
    """Groups of nodes by plain search."""
    left, groups = set(nodes), []
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            near = {y for y in left if linked(todo[-1], y)}
            todo.pop()
            todo += near
            left -= near
            group |= near
        groups.append(group)
    return groups


@given(st.sets(st.integers(0, (1 << 48) - 1), min_size=1, max_size=300))
def test_golomb_round_trip(values):
    v = np.array(sorted(values), np.uint64)
    low, code = golomb_encode(v)
    assert golomb_decode(len(v), low, code).tolist() == v.tolist()


def test_golomb_is_short():
    v = np.unique(np.random.default_rng(0).integers(0, 1 << 48, 100_000, dtype=np.uint64))
    assert len(golomb_encode(v)[1]) * 8 / len(v) < 34


def test_suspects_are_the_repeated_fingerprints(spark, monkeypatch):
    monkeypatch.setattr("rateweave.llm.exact.RUN_ROWS", 7)
    values = [(i * 97 % 50) << 40 if i % 2 else i << 30 for i in range(200)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "fingerprint long, row long").repartition(4)
    count = Counter(v >> 16 for v in values)
    for owners in (1, 5):
        from rateweave.llm.common import written
        got = collected(suspects_of(written(runs_of(df, "fingerprint"), "runs"), owners))
        assert len(got) == 200
        assert all(r["suspect"] == (count[r["fingerprint"] >> 16] > 1) for r in got)


def test_exact_groups(spark):
    got = collected(exact_groups(docs(spark)))
    assert len(got) == len(rows())
    groups = defaultdict(list)
    for r in rows():
        groups[hashlib.sha256((r[1] or "").translate(UP).encode()).hexdigest()].append(r[0])
    kept = Counter()
    for r in got:
        ids = groups[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(known) if known else None)
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept) == set(groups) and set(kept.values()) == {1}
    assert exact_groups(empty(spark)).count() == 0


def test_drop_exact_duplicates_keeps_whole_rows(spark):
    df = docs(spark)
    got = drop_exact_duplicates(df)
    assert got.columns == df.columns
    texts = Counter((r["text"] or "").translate(UP) for r in collected(got))
    assert set(texts) == {(r[1] or "").translate(UP) for r in rows()} and set(texts.values()) == {1}
    assert drop_exact_duplicates(empty(spark)).count() == 0


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_in_chunks(monkeypatch):
    for r in rows()[:80]:
        assert simhash(r[1]) == plain_simhash(r[1])
    monkeypatch.setattr("rateweave.llm.simhash.CHUNK_BYTES", 5)
    for r in rows()[:60]:
        assert simhash(r[1]) == plain_simhash(r[1])


@pytest.mark.parametrize("cell_rows", [256, 2])
def test_near_pairs_find_all(spark, cell_rows):
    rng = np.random.default_rng(1)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 30)} | {0, (1 << 64) - 1}
    for base in list(prints)[:6]:
        for _ in range(40):
            x = base
            for j in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(j)
            prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    got = near_pairs(spark.createDataFrame([(x,) for x in signed], "print long"), 3, cell_rows)
    assert {(r.a, r.b) for r in got.collect()} == want and got.count() == len(want)


def test_near_groups(spark):
    got = collected(near_groups(docs(spark)))
    assert len(got) == len(rows())
    prints = defaultdict(list)
    for r in got:
        prints[int(r["fingerprint"], 16)].append(r)
    want = Counter(plain_simhash(r[1]) for r in rows())
    assert Counter({p: len(x) for p, x in prints.items()}) == want
    for group in reach(prints, lambda a, b: (a ^ b).bit_count() <= 3):
        members = [r for p in group for r in prints[p]]
        known = [r["doc_id"] for r in members if r["doc_id"] is not None]
        assert {r["component_id"] for r in members} == {min(known) if known else None}
        assert sum(r["kept"] for r in members) == 1
    kept = drop_near_duplicates(docs(spark))
    assert kept.columns == docs(spark).columns and kept.count() == sum(r["kept"] for r in got)
    assert near_groups(empty(spark)).count() == 0 and drop_near_duplicates(empty(spark)).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_quantisation_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(40, 16)) * 10.0 ** rng.integers(-8, 8, (40, 1))
    q, s, e, n = quantised(v)
    unit = v / n[:, None]
    dots = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    assert (np.abs(unit @ unit.T - dots) <= e[None, :] + e[:, None] * (1 + e[None, :]) + 1e-9).all()


def test_embedding_groups(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 8)).astype(np.float32)
    vectors = [(i, [float(x) for x in base[i % 6] + rng.normal(size=8).astype(np.float32) * 0.12], i % 2) for i in range(120)]
    vectors += [(200 + i, vectors[3][1], 1) for i in range(5)] + [(205, vectors[3][1], 0), (206, [2 * x for x in vectors[3][1]], 1)]
    vectors += [(300, None, 1), (301, [0.0] * 8, 1), (302, [float("nan")] * 8, 1), (303, [None] * 8, 1), (304, vectors[3][1], None),
                (305, [], 1), (306, vectors[3][1][:4], 1), (307, [float("inf")] * 8, 0), (308, vectors[3][1][:4], 1)]
    df = spark.createDataFrame([(*v, 1, 2) for v in vectors], "vec_id long, embedding array<float>, label int, row int, one int")
    sound = {i: (np.array(v, float), k) for i, v, k in vectors
             if v and k is not None and None not in v and np.isfinite(v).all() and any(v)}

    def linked(a, b):
        if a not in sound or b not in sound or sound[a][1] != sound[b][1] or len(sound[a][0]) != len(sound[b][0]):
            return False
        x, y = (np.float32(sound[i][0]).astype(float) for i in (a, b))
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93

    ids = [v[0] for v in vectors]
    root = {i: min(g) for g in reach(ids, linked) for i in g}
    for tile in (1024, 16, 2):  # one strip, and up to 8 of 8 tiles
        got = collected(embedding_groups(df, tile=tile))
        assert len(got) == len(vectors)
        for r in got:
            i = r["vec_id"]
            assert r["n_links"] == sum(linked(i, j) for j in ids if j != i)
            assert r["component_id"] == root[i] and r["kept"] == (root[i] == i)
    assert embedding_groups(df.limit(0)).count() == 0
    repeated = collected(embedding_groups(spark.createDataFrame(
        [(1, [1.0, 0.0], 3), (1, [1.0, 0.0], 3), (None, [1.0, 0.0], 3)], "vec_id long, embedding array<float>, label int")))
    assert [r["n_links"] for r in repeated] == [2, 2, 2] and {r["component_id"] for r in repeated} == {1}


def test_vectors_of_any_size_link(spark):
    base = [[3.0, 4.0, 1.0], [3.1, 4.0, 1.0], [-4.0, 3.0, 0.5]]
    vectors, want = [], {}
    for k, size in enumerate((1.0, 1e-170, 1e160, 1e-300, 5e307)):
        for j, v in enumerate(base):
            vectors.append((10 * k + j, [x / 4.1 * size for x in v], 1))
            want[10 * k + j] = (9 if j < 2 else 4, 0 if j < 2 else 2)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    for tile in (1024, 4):
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in collected(embedding_groups(df, tile=tile))} == want


def test_even_vectors_are_not_rounded():
    v = np.array([[1e-170, 3e-170], [0.3, -7.7], [5e307, 1e300]])
    e = even(v)
    assert (np.abs(e).max(axis=1) < 1).all() and (np.abs(e).max(axis=1) >= 0.5).all()
    assert (v[:, 0] * e[:, 1] == v[:, 1] * e[:, 0]).all() or np.allclose(e[:, 0] / e[:, 1], v[:, 0] / v[:, 1], rtol=0)
