"""Ranked search, filter audit and decontamination against brute force."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import DOC_SCHEMA, collected, docs, empty, rows, text_of
from pyspark.sql import functions as F

from rateweave.llm.audit import audit, audit_filters, shapley, survivors
from rateweave.llm.common import written
from rateweave.llm.decontamination import ANY_CASE_WORD, contaminated_documents, contamination, decontaminate, words_of
from rateweave.llm.lexical import best, rank_documents

UP = {i: i + 32 for i in range(65, 91)}
TERM = re.compile("[0-9a-z\x80-\U0010ffff]+")


def terms(text):
    return TERM.findall((text or "").translate(UP))


ITEMS = [(1, text_of(3, 25)), (2, "the lazy dog"), (3, "zebra"), (4, None), (5, ""), (6, "the"), (7, text_of(9, 14)),
         (None, text_of(5, 12)), (2, "THE quick; the QUICK!"), (8, "漢字🙂 naïve"), (10, text_of(1, 30)), (9, "--- ??")]


def items(spark, given=None):
    return spark.createDataFrame(ITEMS if given is None else given, "item_id long, text string").withColumns(
        {"doc_id": F.lit(7), "rank": F.lit(1)})


# -- ranked search ----------------------------------------------------------

def ranking(documents, queries, top=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in documents]
    n_docs, n_terms = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in queries:
        scored = []
        for i, c, n in held:
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // n_terms)))
                        for t, times in Counter(terms(text)).items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def asked(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in collected(df)), key=str)


@pytest.mark.parametrize("block_pairs", [500_000, 20])
def test_ranking_is_the_full_ranking(spark, monkeypatch, block_pairs):
    monkeypatch.setattr("rateweave.llm.lexical.FIRST_READ", 2)
    monkeypatch.setattr("rateweave.llm.lexical.SHARD_DOCS", 17)
    got = rank_documents(docs(spark), items(spark), block_pairs=block_pairs)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert asked(got) == ranking([r[:2] for r in rows()], ITEMS)


def test_ties_go_to_the_smaller_id_and_null_comes_last(spark):
    many = [(900 - i if i else None, "same words here") for i in range(40)] + [(5000 + i, "other") for i in range(50)]
    df = spark.createDataFrame(many, "doc_id long, text string").repartition(5)
    got = asked(rank_documents(df, items(spark, [(1, "same here")])))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(861, 871))
    few = spark.createDataFrame([(None, "w x"), (3, "w x"), (None, "y z")], "doc_id long, text string")
    assert [r[2] for r in sorted(asked(rank_documents(few, items(spark, [(1, "w")]))), key=lambda r: r[1])] == [3, None]


def test_search_of_nothing(spark):
    assert collected(rank_documents(empty(spark), items(spark))) == []
    assert collected(rank_documents(docs(spark), items(spark, []))) == []


def test_text_ids(spark):
    df = docs(spark).selectExpr("concat('d', cast(doc_id as string)) as doc_id", "text")
    plain = [(None if i is None else f"d{i}", t) for i, t, *_ in rows()]
    assert asked(rank_documents(df, items(spark))) == ranking(plain, ITEMS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 30), st.integers(0, 5), max_size=31), min_size=1, max_size=6), st.integers(1, 4))
def test_nra_finds_the_best_whatever_the_lists(lists, top):
    import rateweave.llm.lexical as lexical

    before, lexical.FIRST_READ = lexical.FIRST_READ, 1
    try:
        sorted_lists = []
        for x in lists:
            pairs = sorted(x.items(), key=lambda p: -p[1])
            sorted_lists.append((np.array([d for d, _ in pairs], np.int64), np.array([s for _, s in pairs], np.int64)))
        order = np.random.default_rng(len(lists)).permutation(31)
        found, scores = best([x for x in sorted_lists if len(x[0])], order, top)
    finally:
        lexical.FIRST_READ = before
    total = Counter()
    for x in lists:
        total.update(x)
    want = sorted((d for d in total if total[d] > 0), key=lambda d: (-total[d], order[d]))[:top]
    assert found.tolist() == want and scores.tolist() == [total[d] for d in want]


# -- filter audit -----------------------------------------------------------

def failed_filters(documents):
    first = {}
    for i, t, *_ in documents:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, part, *_ in documents:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": i is not None and i > first[t]}
        out.append((i, part or "", {k for k, v in fails.items() if v}))
    return out


def applied(documents, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts, out = defaultdict(list), {}
    for i, part, fails in failed_filters(documents):
        parts[part].append((i, fails))
    for part, held in parts.items():
        share = Counter()
        for order in itertools.permutations("ABCDE"):
            left = held
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                share[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] for x in held) - len(gone), sum(x[1] == {f} for x in held),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
        for (p, order, step), numbers in out.items():
            if p == part:
                numbers.append(share[order[step - 1]])
    return out


LABELS = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 60, 3)] + [(3, 1, 1), (3, None, None), (None, 1, 1), (5, 1, 0), (104, 1, 1), (999, 1, 1)]


def test_audit_equals_filters_applied_in_every_order(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = collected(audit_filters(docs(spark), labels))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r["part"], r["filter_order"], r["step"]): [r[x] for x in names] for r in got}
    assert len(found) == len(got) == 600 * 2
    assert found == applied(rows(), LABELS)


def test_each_filter_at_its_bound(spark):
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words * 2), " ".join(words * 2)[:-3], " ".join(words[:99] + ["w0"] * 101), "A" * 3 + "b" * 97, "A" * 4 + "b" * 96,
             "a|b", "a~b", "A" * 4 + "b" * 96, "", None]
    documents = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(documents, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r["part"], r["filter_order"], r["step"]): [r[x] for x in names] for r in collected(audit_filters(df, labels))}
    assert found == applied(documents, [])


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert collected(audit_filters(empty(spark), labels)) == []


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 6), st.data())
def test_walk_states_and_shares(filters, data):
    masks = np.array(sorted(data.draw(st.sets(st.integers(0, (1 << filters) - 1), min_size=1))))
    counts = np.array([[data.draw(st.integers(0, 50)), 0] for _ in masks])
    states = survivors(masks, counts, filters)
    for subset in range(1 << filters):
        assert states[subset, 0] == counts[masks & subset == 0, 0].sum()
    removed = Counter()
    for order in itertools.permutations(range(filters)):
        on = 0
        for k in order:
            removed[k] += int(states[on, 0] - states[on | 1 << k, 0])
            on |= 1 << k
    assert shapley(states, filters) == [removed[k] for k in range(filters)]


def test_audit_takes_other_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 1, 1)], "part string, mask int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"]) for r in collected(audit(cells, "XY"))}
    assert got == {("XY", 1): (5, 2, 0), ("XY", 2): (5, 0, 2), ("YX", 1): (5, 2, 0), ("YX", 2): (5, 0, 2)}
    with pytest.raises(ValueError):
        audit(cells, "XX")


# -- decontamination --------------------------------------------------------

LEAKS = [(1, text_of(3, 25)), (2, "quick brown FOX"), (3, "zebra!"), (4, None), (5, ""), (6, "?!"), (7, " ".join(f"u{i}" for i in range(12))),
         (None, "potions lazy"), (10, text_of(1, 30)), (10, "naïve"), (11, "quick; brown, fox")]
HELD = rows() + [
    (700, "Say U0 u1, u2 u3 u4 u5 u6 u7 u8 u9 end; u1 u2 u3 u4 u5 u6 u7 u8 u9 u10", "en"),
    (701, "u0 u1 u2 u3 u4 u5 u6 u7 u8 x u9 u10 u11", "en"),
    (702, "((zebra)) and zebra, ZEBRA2 zebra", "en"), (702, "((zebra)) and zebra, ZEBRA2 zebra", "en")]


def windows(text, size=10):
    words = terms(text)
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def leaks(text, given=LEAKS):
    words, hit, ids = terms(text), set(), set()
    for item, t in given:
        for w in windows(t):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i:i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    if item is not None:
                        ids.add(str(item))
    return len(words), hit, sorted(ids)


def held_docs(spark):
    return spark.createDataFrame([(*r, *([None] * (12 - len(r)))) for r in HELD], DOC_SCHEMA).repartition(3)


@pytest.mark.parametrize("most_broadcast", [200_000, 0])
def test_contaminated_documents(spark, most_broadcast):
    got = collected(contaminated_documents(held_docs(spark), items(spark, LEAKS), most_broadcast=most_broadcast))
    want = []
    for i, t, *_ in HELD:
        n, hit, ids = leaks(t)
        want.append((i, n, len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((tuple(r[x] for x in names) for r in got), key=str) == sorted(want, key=str)
    assert any(x[2] for x in want) and not all(x[2] for x in want)


def test_places_are_word_numbers(spark):
    got = {r["doc_id"]: r for r in collected(contamination(held_docs(spark), items(spark, LEAKS)))}
    assert got[700]["places"] == [*range(1, 11), *range(12, 22)] and got[700]["items"] == ["7"]
    assert 701 not in got


def test_spans_are_removed(spark):
    df = written(held_docs(spark), "held")
    got = collected(decontaminate(df, items(spark, LEAKS)))
    assert len(got) == len(HELD) and list(got[0]) == df.columns
    want = []
    for i, t, *_ in HELD:
        _, hit, _ = leaks(t)
        if hit:
            head, pieces = re.match("[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", t)[0], re.findall(
                "[0-9A-Za-z\x80-\U0010ffff]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", t)
            assert head + "".join(pieces) == t
            t = head + "".join(p for k, p in enumerate(pieces) if k not in hit)
        want.append((i, t))
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    again = collected(contaminated_documents(df.filter("doc_id = 700"), items(spark, LEAKS)))
    assert again[0]["n_hit"] == 20


def test_documents_are_removed(spark):
    got = collected(decontaminate(held_docs(spark), items(spark, LEAKS), remove="documents"))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, t, *_ in HELD if not leaks(t)[1])
    with pytest.raises(ValueError):
        decontaminate(held_docs(spark), items(spark, LEAKS), remove="words")


def test_decontamination_of_nothing(spark):
    assert collected(contaminated_documents(empty(spark), items(spark, LEAKS))) == []
    for none in ([], [(1, None), (2, "..")]):
        got = collected(contaminated_documents(held_docs(spark), items(spark, none)))
        assert len(got) == len(HELD) and not any(r["contaminated"] or r["n_items"] for r in got)


def test_words_are_told_by_single_characters(spark):
    # Java tries a class's ranges one after the other, which took most of the operator's time
    assert "-" not in ANY_CASE_WORD and "\\" not in re.sub(r"\\x[0-7][0-9A-F]", "", ANY_CASE_WORD)
    every = [chr(i) for i in (*range(1, 0x250), 0x3000, 0x212A, 0xFFFD, 0x1F642)]
    texts = [(i, f"aB{c}Z9") for i, c in enumerate(every)] + [(-1, None), (-2, ""), (-3, "A\x00b" + "".join(every))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = contaminated_documents(df, items(spark, LEAKS))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert r"\x00-" not in plan and "translate" not in plan
    assert {r["doc_id"]: r["n_words"] for r in collected(found)} == {i: len(terms(t)) for i, t in texts}
    assert {r["doc_id"]: r["w"] for r in collected(df.select("doc_id", words_of(F.col("text")).alias("w")))} == {
        i: terms(t) for i, t in texts}


def test_main_path_has_no_python_worker(spark):
    plan = contaminated_documents(held_docs(spark), items(spark, LEAKS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
