"""The pipeline, each stage against a brute-force version of it on its own input."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import collected, docs, empty
from test_llm_dedup import plain_simhash, reach
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from rateweave.llm.common import written
from rateweave.llm.quality import learn_quality, score_quality

UP = {i: i + 32 for i in range(65, 91)}
PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) rows of each stage over the smallest documents with awkward rows added."""
    table = spark.read.parquet(f"{PATH}/documents.parquet")
    more = docs(spark).select(*table.columns)
    extra = table.limit(40).selectExpr("doc_id + 100000 as doc_id", "upper(text) as text", "lang", "source", "n_chars")
    now, out = table.unionByName(more).unionByName(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, now, PATH), name)
        out[name] = (collected(now), collected(after), now, after)
        now = after
    return out


def as_counter(rows):
    return Counter(tuple(sorted(r.items(), key=lambda x: x[0])) for r in rows)


def test_every_query_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_stages_but_the_last_return_documents(stages):
    for name in [n for n, _ in corpus_pipeline.STAGES][:-1]:
        before, after, frame, result = stages[name]
        assert result.columns == frame.columns
        assert not set(as_counter(after)) - set(as_counter(before))


def test_classifier_stage(spark, stages):
    before, after, frame, _ = stages["quality_classifier"]
    labels = spark.read.parquet(f"{PATH}/labels.parquet")
    scored = collected(score_quality(frame, learn_quality(frame, labels), name="p"))
    keep = [{k: v for k, v in r.items() if k != "p"} for r in scored if r["p"] >= 0.5]
    assert as_counter(keep) == as_counter(after)


def test_exact_stage(stages):
    before, after, *_ = stages["exact_dedup"]
    best = {}
    for r in before:
        key = (r["text"] or "").translate(UP)
        best[key] = max(best.get(key, float("-inf")), float("-inf") if r["doc_id"] is None else r["doc_id"])
    got = Counter(((r["text"] or "").translate(UP), float("-inf") if r["doc_id"] is None else r["doc_id"]) for r in after)
    assert got == Counter(best.items())


def test_near_stage(stages):
    before, after, *_ = stages["simhash_near_dedup"]
    prints = {}
    for r in before:
        prints.setdefault(plain_simhash(r["text"]), []).append(r["doc_id"])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    groups = reach(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    assert Counter(r["doc_id"] for r in after) == Counter(least([i for p in g for i in prints[p]]) for g in groups)


def test_mixing_stage(stages):
    before, after, *_ = stages["source_mixing"]
    times = Counter(r["doc_id"] for r in after)
    assert max(times.values()) <= 3 * max(Counter(r["doc_id"] for r in before).values())
    size = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    largest = max(len((r["text"] or "").split()) for r in before)
    assert abs(size(after) - size(before)) <= 3 * largest * len({r["source"] for r in before})


def test_packing_stage(stages):
    before, after, *_ = stages["best_fit_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in before:
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        at, k, size = 0, 0, len(ids) % 1024 or min(len(ids), 1024)
        while at < len(ids):
            want[r["doc_id"], k, at, size, zlib.crc32(ids[at:at + size].tobytes())] += 1
            at, k, size = at + size, k + 1, 1024
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in after) == want


def test_an_empty_table_stays_empty(spark):
    now = empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, PATH), name)
        assert now.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, PATH).count() > 0


def test_stages_leave_former_results_alone(spark):
    table = spark.read.parquet(f"{PATH}/documents.parquet").limit(150)
    by_name = dict(corpus_pipeline.STAGES)
    exact = by_name["exact_dedup"](spark, table, PATH)
    near = by_name["simhash_near_dedup"](spark, exact, PATH)  # neither is written yet
    again = by_name["exact_dedup"](spark, table, PATH)
    mixed = by_name["source_mixing"](spark, near, PATH)
    assert as_counter(collected(exact)) == as_counter(collected(again))
    assert near.count() <= exact.count() and mixed.count() > 0 and near.count() <= exact.count()
