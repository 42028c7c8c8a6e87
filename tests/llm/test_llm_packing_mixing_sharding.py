import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import collected, docs, empty, rows
from tokenizers import Tokenizer

from rateweave.llm.mixing import MOST_COPIES, mix_sources, resample
from rateweave.llm.packing import OpenBins, WordIds, pack, pack_documents
from rateweave.llm.sharding import assign_shards, jump_hash


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_pieces_are_the_tokenizers_ids_and_fill_sequences(spark, tokenizer):
    got = collected(pack_documents(docs(spark)))
    whole = Counter()
    for r in rows():
        ids, at, k = ids_of(tokenizer, r[1]), 0, 0
        size = len(ids) % 1024 or min(len(ids), 1024)
        while at < len(ids):
            whole[r[0], k, at, size, zlib.crc32(ids[at:at + size].tobytes())] += 1
            at, k, size = at + size, k + 1, 1024
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == whole
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= math.ceil(sum(r["length"] for r in got) / 1024) + 2
    assert pack_documents(empty(spark)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r'aBz1,.!  \x1c\x85é²½漢🙂"), st.characters()), max_size=60))
def test_word_table_gives_the_tokenizers_ids(text):
    encoder = test_word_table_gives_the_tokenizers_ids.__dict__.setdefault("encoder", WordIds(None, None))
    text = text.encode("utf-8", "ignore").decode()
    assert encoder.encode([text])[0] == encoder.whole(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "<|", " ", "a", "end", "\n", "</s>", "[INST]", "é"]), max_size=8), max_size=4))
def test_control_strings_are_the_tokenizers_ids(parts):
    encoder = test_word_table_gives_the_tokenizers_ids.__dict__.setdefault("encoder", WordIds(None, None))
    texts = ["".join(x) for x in parts]
    assert encoder.added  # the file has such tokens
    assert encoder.encode(texts) == [encoder.whole(x) for x in texts]


def test_word_table_is_bounded(monkeypatch):
    monkeypatch.setattr("rateweave.llm.packing.KNOWN_WORDS", 3)
    encoder = WordIds(None, None)
    text = "one two three four five six two"
    for _ in range(2):
        assert encoder.encode([text, "seven eight two"])[0] == encoder.whole(text)
    assert len(encoder.known) <= 3


@given(st.lists(st.integers(1, 32), max_size=200), st.integers(1, 8))
def test_best_fit_with_bounded_bins(lengths, most):
    bins, used, open_, closed = OpenBins(32, most), {}, {}, set()
    for n in lengths:
        fits = [b for b, free in open_.items() if free >= n]
        number, offset = bins.place(n)
        if fits:
            assert open_[number] == min(open_[b] for b in fits)
        else:
            assert number not in used
            if len(open_) == most:
                gone = min(open_, key=lambda b: (open_[b], 0))
                least = open_[gone]
                gone = next(b for b in open_ if open_[b] == least and b not in {x for s in bins.bins for x in s})
                open_.pop(gone)
                closed.add(gone)
        assert number not in closed and offset == used.get(number, 0)
        used[number] = offset + n
        open_[number] = 32 - used[number]
        if not open_[number]:
            open_.pop(number)
        assert len(open_) <= most and bins.count == len(open_)


def test_small_tasks_lose_little(spark):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(1, 1025, 20000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    got = pack(df, pieces_a_task=2500)
    assert got.select("sequence_id").distinct().count() <= 1.03 * sum(lengths) / 1024


def test_mix_takes_near_targets(spark):
    got = collected(mix_sources(docs(spark)))
    assert len(got) == len(rows())
    words = Counter()
    for r in rows():
        words[r[3]] += len((r[1] or "").split()) if r[0] != 402 else 0
    by = defaultdict(lambda: [0, 0, 0.0, 0])
    for r in got:
        assert 0 <= r["taken"] <= MOST_COPIES * r["size"]
        x = by[r["target"], r["source_size"]]
        x[0] += r["size"]
        x[1] += r["taken"]
        x[3] = max(x[3], r["size"])
    for (target, size), (sizes, taken, _, largest) in by.items():
        assert sizes % size == 0 if size else True
        assert abs(taken - target * (sizes // size if size else 1)) <= 3 * largest
    total = sum(r["size"] for r in got)
    distinct = {(r["target"], r["source_size"]) for r in got}
    assert abs(sum(t for t, _ in distinct) - total) < 1e-6 * total
    assert sorted(map(str, got)) == sorted(map(str, collected(mix_sources(docs(spark).repartition(5)))))
    assert mix_sources(empty(spark)).count() == 0


def test_resample_repeats_whole_rows(spark):
    df = docs(spark)
    got = resample(df)
    assert got.columns == df.columns
    taken = sum(r["copies"] for r in collected(mix_sources(df)))
    assert got.count() == taken
    assert resample(empty(spark)).count() == 0


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=50), st.integers(1, 40))
def test_jump_hash(keys, shards):
    got = jump_hash(np.array(keys, np.uint64), shards)
    assert got.tolist() == [jump(k, shards) for k in keys]
    more = jump_hash(np.array(keys, np.uint64), shards + 1)
    assert ((more == got) | (more == shards)).all()


def test_shards(spark):
    got = collected(assign_shards(docs(spark), 5))
    assert len(got) == len(rows())
    slots, home = defaultdict(list), {}
    for r in got:
        assert home.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["grown_shard"] in (r["shard"], 5)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert assign_shards(empty(spark), 5).count() == 0
