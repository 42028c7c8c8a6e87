"""Language-model scores from a probabilistic suffix tree over words.

A context is the words before a word.  It is kept when its next-word counts
differ from its shorter contexts' distribution by more than chance (a
likelihood-ratio test).  Its distribution lists the outcomes with at least
LEAST_COUNT tokens, smoothed with the shorter context's; all others share the
rest in the shorter context's proportions.  A word is scored from the longest
kept context.  A context with a word that occurs once in the training texts
has no such outcome, so it ends there.

The texts are cut into runs of about RUN_TOKENS tokens.  The tree grows by one
word a round until no context grows.  In a round each run sends its distinct
contexts and (context, word) pairs with their counts, sorted and packed, to the
contexts' owners.  An owner adds up, tests the contexts and answers each run in
the order of its message; the run scores the tokens that end there and keeps
the others for the next round.  A context with many tokens is dealt over
several owners by its words, and its runs add up their answers.  Nothing of the
model is gathered or broadcast; all counts are exact and cover all training
documents.  A token's probability from the shorter contexts travels in single
precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.versioned import release
from .common import SHUFFLES_GO, by_bytes, crc_mod, give_back, in_buckets, setting, written
from .simhash import SPACE

# The least count of an outcome that a context lists, whatever the corpus.
LEAST_COUNT = 2
# A branch of the tree ends after so many words in a row that told nothing (None: never).
IDLE = 2
# Tokens of a run (a text is never cut), and tokens for which one owner answers.
RUN_TOKENS = 1 << 20
OWNER_TOKENS = 1 << 22
LEAST_OWNERS = 8
# Pairs that an owner handles at a time.
PART_PAIRS = 1 << 19
# Buckets of the stored runs: one to two times their number, but no more than these.
MOST_BUCKETS = 1 << 16
# Tokens that a run scores at a time.
SLICE = 1 << 16
CHUNK_BYTES = 1 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CODEC = "spark.sql.parquet.compression.codec"
# The digest that stands for the end of a text.
END = np.uint64(1)

# A word's digest: a polynomial over one random number a byte, A-Z as a-z.
BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
BYTES[65:91] = BYTES[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ value >> np.uint64(33)
    value *= np.uint64(0xFF51AFD7ED558CCD)
    return value ^ value >> np.uint64(33)


class Digests:
    """64-bit digests of the words of byte strings."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def of_chunk(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(digest, start) of each word."""
        code = np.frombuffer(raw, np.uint8)
        if len(self.up) < len(code) + 1:
            self.up, self.down = powers(BASE, len(code) + 1), powers(BASE_INVERSE, len(code) + 1)
        edge = np.diff(IS_SPACE[code].view(np.int8), prepend=1, append=1)
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(BYTES[code] * self.up[:len(code)], out=total[1:])
        return mixed((total[end] - total[start]) * self.down[start]), start

    def of(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The same for any length, a bounded part at a time."""
        found, at = [], 0
        while at < len(raw) or not found:
            m = SPACE.search(raw, at + CHUNK_BYTES)
            end = m.start() if m else len(raw)
            value, start = self.of_chunk(raw[at:end])
            found.append((value, start + at))
            at = max(end, at + 1)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def of_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(digest, text number) of every token; each text closes with END."""
        raws = [(x or "").encode() for x in texts]
        starts = np.cumsum([0, *(len(r) + 1 for r in raws)])
        value, start = self.of(b" ".join(raws))
        owner = np.searchsorted(starts, start, "right") - 1
        count = np.bincount(owner, minlength=len(raws)) + 1
        out = np.full(len(value) + len(raws), END)
        out[np.arange(len(value)) + owner] = value
        return out, np.repeat(np.arange(len(raws)), count)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of fixed-width numbers as bytes: equal places of the numbers together, compressed."""
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        code = pa.compress(planes, codec="zstd", asbytes=True) if planes else b""
        parts += [np.array([len(a), len(code)], "<i8").tobytes(), code]
    return b"".join(parts)


def unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays of ``pack``, given their types."""
    out, at = [], 0
    for kind in map(np.dtype, kinds):
        n, size = np.frombuffer(raw, "<i8", 2, at).tolist()
        planes = pa.decompress(raw[at + 16:at + 16 + size], n * kind.itemsize, codec="zstd", asbytes=True) if n else b""
        out.append(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T.copy().view(kind).reshape(n))
        at += 16 + size
    return out


def grouped(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, places, codes): the distinct numbers in order, a place of each, and which of them each entry is.

    For numbers from 0 on, less than 2**31 of them.  What np.unique gives, in less
    time: what is sorted are the numbers with their places in the low bits.
    """
    bits = len(a).bit_length()
    key, low = a.astype(np.uint64), np.uint64((1 << bits) - 1)
    whole = not len(a) or int(key.max()).bit_length() + bits <= 64
    if whole:
        key <<= np.uint64(bits)
    else:
        key &= ~low
    key |= np.arange(len(a), dtype=np.uint64)
    key.sort()
    new = np.ones(len(a), bool)
    np.greater(key[1:] ^ key[:-1], low, out=new[1:])
    if whole:
        values = (key[new] >> np.uint64(bits)).astype(a.dtype)
        key &= low
        order = key.view(np.int64)
    else:
        alike = ~new[1:]
        key &= low
        order = key.view(np.int64)
        values = a[order]
        np.not_equal(values[1:], values[:-1], out=new[1:])
        if (new[1:] & alike).any():  # the bits left out would have told them apart
            order = np.argsort(a, kind="stable")
            values = a[order]
            np.not_equal(values[1:], values[:-1], out=new[1:])
        values = values[new]
    first = order[new]
    place = np.cumsum(new, dtype=np.int32)
    place -= 1
    codes = np.empty(len(a), np.int32)
    codes[order] = place
    return values, first, codes


def told_apart(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, codes) of single floats; the values are ``a`` itself, without codes, where few repeat."""
    values, _, codes = grouped(a.view("<u4"))
    return (values.view("<f4"), codes.astype("<i4")) if len(values) <= len(a) // 3 else (a, np.zeros(0, "<i4"))


def bits_of(a: np.ndarray) -> int:
    return int(a.max(initial=0)).bit_length()


def together(values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """What ``told_apart`` was given."""
    return values[codes] if len(codes) else values


def summed(place: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(place, weights=weights, minlength=size)


# ---------------------------------------------------------------- the model

def outcome_sums(ctx: np.ndarray, n: np.ndarray, back: np.ndarray, size: int) -> np.ndarray:
    """(listed, outcomes, back_sum, own, known) of contexts 0..size-1 from their distinct (ctx, n, back).

    n: the training count of a word after the context, back its log10
    probability from the shorter contexts; only counts from LEAST_COUNT on enter.
    """
    often = n >= LEAST_COUNT
    ctx, n, back = ctx[often], n[often].astype(float), back[often].astype(float)
    return np.array([summed(ctx, x, size) for x in (n, np.ones(len(n)), 10.0 ** back, n * np.log(n), n * back * math.log(10))])


def judged(total: np.ndarray, sums: np.ndarray, idle: np.ndarray, most_idle: int | None):
    """(kept, grows, idle, rest) of contexts with ``total`` training tokens and an outcome listed.

    ``idle``: how many shorter contexts in a row, the longest first, were not
    kept.  A context is kept if its counts diverge from the shorter contexts'
    distribution.  It does not grow if no longer one can be kept: what any
    part of its counts could tell against its distribution is at most
    ``most``, and shrinks as contexts get longer; nor after ``most_idle`` in a
    row that were not kept, if that is given.  rest: log10 of the factor by
    which a kept context changes the probability of an unlisted word.
    """
    listed, outcomes, back_sum, own, known = sums
    back_sum = np.minimum(back_sum, 1 - 1e-12)
    other, mix = total - listed, outcomes / (total + outcomes)
    with np.errstate(divide="ignore", invalid="ignore"):
        unlisted = np.where(other > 0, other * np.log(other / total / (1 - back_sum)), 0.0)
    left = np.maximum(1 - (1 - mix) * listed / total - mix * back_sum, 1e-12)
    surprise = own - listed * np.log(total) - known + unlisted
    kept = 2 * surprise > outcomes + 3.1 * np.sqrt(2 * outcomes) + 3
    most = np.where(kept, listed * (np.log(total) - np.log1p(-mix)) - own - other * np.log(left),
                    -known - other * np.log1p(-back_sum))
    idle = np.where(kept, 0, idle + 1)
    grows = 2 * most > 4 + 3.1 * math.sqrt(2)
    if most_idle is not None:
        grows &= idle < most_idle
    return kept, grows, idle, np.log10(left / (1 - back_sum))


def log_after(n: np.ndarray, back: np.ndarray, total: np.ndarray, outcomes: np.ndarray, kept: np.ndarray,
              rest: np.ndarray) -> np.ndarray:
    """log10 probabilities of words with count ``n`` after contexts as ``judged``."""
    log = np.where(kept, rest + back, back).astype(float)
    own = np.flatnonzero(kept & (n >= LEAST_COUNT))
    mix = outcomes[own] / (total[own] + outcomes[own])
    log[own] = np.log10((1 - mix) * n[own] / total[own] + mix * 10.0 ** back[own].astype(float))
    return log


def parts_of(total: np.ndarray, owner_tokens: int, owners: int) -> np.ndarray:
    """log2 of the owners over which a context with at most ``total`` tokens is dealt."""
    parts = np.ceil(np.log2(np.maximum(total / (owner_tokens / 4), 1)))
    return np.minimum(parts, math.log2(owners)).astype("u1")


# ---------------------------------------------------------------- runs

# A run's tokens: text lengths, texts learned from, a code a token; its words: number, count, log10 probability
# (after contexts of one word only the numbers, and of a text what lies before its last active token).
TOKENS = ("<i4", "u1", "<i4", "<i8", "<i8", "<f8")
# Its active tokens: bits, then back (values, codes), idle, parts and bits of those that may be listed
# (empty for contexts of one word).
STATE = ("u1", "<f4", "<i4", "<u2", "u1", "u1")
# A message: contexts (gaps, tokens, idle, parts, pairs of each), pairs (word, count, back as values and codes).
MESSAGE = ("<u8", "<i8", "<u2", "u1", "<i4", "<i8", "<i4", "<f4", "<i4")
# An answer: contexts (1 kept, 2 grows, 4 dealt), then the kept or growing ones' tokens, outcomes, idle, rest;
# of dealt ones the tokens and five sums; pairs' counts, 0 below LEAST_COUNT.
ANSWER = ("u1", "<i8", "<i8", "<u2", "<f8", "<i8", "<f8", "<i8")


def cut_runs(docs: DataFrame, run_tokens: int) -> DataFrame:
    """(run, docs, words, tokens): whole texts in runs, words told by digests."""
    doc = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    schema = T.StructType([T.StructField("run", T.LongType()), T.StructField("docs", T.ArrayType(doc)),
                           T.StructField("words", T.BinaryType()), T.StructField("tokens", T.BinaryType())])

    def cut(batches):
        from pyspark import TaskContext

        digests, run, held, count = Digests(), TaskContext.get().partitionId() << 32, [], 0

        def flush():
            table = pa.Table.from_batches([b for b, _, _ in held]).combine_chunks()
            rows = pa.StructArray.from_arrays([c.combine_chunks() for c in table.columns], table.column_names)
            words, _, codes = grouped(np.concatenate([v for _, v, _ in held]))
            learn = ~table.column("held_out").to_numpy()
            tokens = pack(np.concatenate([n for _, _, n in held]).astype("<i4"), learn.astype("u1"), codes.astype("<i4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([run], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                 pa.array([pack(np.diff(words, prepend=np.uint64(0)))], pa.binary()), pa.array([tokens], pa.binary())],
                names=schema.names)

        for batch in by_bytes(batches, "text", CHUNK_BYTES, 1 << 14):
            value, owner = digests.of_texts(batch.column("text").to_pylist())
            held.append((batch.select(doc.names), value, np.bincount(owner, minlength=batch.num_rows)))
            count += len(value)
            if count >= run_tokens:
                yield flush()
                run, held, count = run + 1, [], 0
        if held:
            yield flush()

    return docs.mapInArrow(cut, schema)


def messages(runs: DataFrame, columns: list[str], codes_of) -> DataFrame:
    """(owner, run, code): what ``codes_of(*columns)`` of each run says, as (owner, bytes)."""
    def send(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                run, *values = (batch.column(c)[k].as_py() for c in ["run", *columns])
                said = list(codes_of(*values))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o for o, _ in said], pa.int32()), pa.array([run] * len(said), pa.int64()),
                     pa.array([c for _, c in said], pa.binary())], names=["owner", "run", "code"])
                give_back()

    return runs.select("run", *columns).mapInArrow(send, "owner int, run long, code binary")


def told(answers: DataFrame, buckets: int) -> DataFrame:
    """The answers to each run in the order of their owners, dealt as the runs' buckets are."""
    return answers.repartition(buckets, "run").groupBy("run").agg(F.sort_array(F.collect_list(F.struct("owner", "code"))).alias("told"))


def joined(answers: list[dict] | None, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The arrays of a run's answers, end to end."""
    found = [unpack(a["code"], *kinds) for a in answers or []]
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, k) for k in kinds]


def word_answers(runs: DataFrame, owners: int) -> DataFrame:
    """(run, owner, code, tokens, types): training count and number of the runs' words.

    Words from LEAST_COUNT on are numbered, frequent ones first with each
    owner; the others get -1.  tokens and types: the owner's, in its first row.
    """
    starts = np.array([(k << 64) // owners for k in range(owners)], np.uint64)

    def ask(words, tokens):
        lens, learn, codes = unpack(tokens, *TOKENS[:3])
        words = np.cumsum(unpack(words, "<u8")[0], dtype=np.uint64)
        n = np.bincount(codes[np.repeat(learn > 0, lens)], minlength=len(words))
        cut = [*np.searchsorted(words, starts), len(words)]
        return [(k, pack(np.diff(words[a:b], prepend=np.uint64(0)), n[a:b])) for k, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]

    def answer(table: pa.Table) -> pa.Table:
        owner = table.column("owner")[0].as_py()
        sent = [unpack(code, "<u8", "<i8") for code in table.column("code").to_pylist()]
        sizes = np.cumsum([len(n) for _, n in sent])[:-1]
        values, _, place = grouped(np.concatenate([np.cumsum(g, dtype=np.uint64) for g, _ in sent]))
        n = summed(place, np.concatenate([n for _, n in sent]), len(values)).astype(np.int64)
        number = np.empty(len(n), np.int64)
        number[np.argsort(-n, kind="stable")] = np.arange(len(n)) * owners + owner
        number[n < LEAST_COUNT] = -1
        codes = [pack(a, b) for a, b in zip(np.split(n[place], sizes), np.split(number[place], sizes), strict=True)]
        first = lambda x: pa.array([int(x)] + [0] * (len(codes) - 1), pa.int64())
        return pa.table({"run": table.column("run"), "owner": table.column("owner"), "code": pa.array(codes, pa.binary()),
                         "tokens": first(n.sum()), "types": first((n > 0).sum())})

    return messages(runs, ["words", "tokens"], ask).groupBy("owner").applyInArrow(
        answer, "run long, owner int, code binary, tokens long, types long")


def with_words(runs: DataFrame, answers: DataFrame, log_total: float, buckets: int) -> DataFrame:
    """(run, docs, tokens, active, score, state): the runs with their words' counts, before contexts of one word."""
    doc = T.StructType([*runs.schema["docs"].dataType.elementType.fields, T.StructField("n_tokens", T.LongType()),
                        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType())])
    schema = T.StructType([
        T.StructField("run", T.LongType()), T.StructField("docs", T.ArrayType(doc)), T.StructField("tokens", T.BinaryType()),
        T.StructField("active", T.LongType()), T.StructField("score", T.ArrayType(T.DoubleType())),
        T.StructField("state", T.BinaryType())])

    def add(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                run, tokens, said = (batch.column(c)[k].as_py() for c in ("run", "tokens", "told"))
                lens, learn, codes = unpack(tokens, *TOKENS[:3])
                n, number = joined(said, ("<i8", "<i8"))
                # codes by number, behind those of words that do not occur and occur once
                order = np.flatnonzero(number >= 0)
                order = order[np.argsort(number[order])]
                code = np.minimum(n, 1)
                code[order] = 2 + np.arange(len(order))
                codes = code[codes]
                number, n = np.append([-1, -1], number[order]), np.append([0, 1], n[order])
                root = np.log10(n + 0.5) - log_total
                doc_of = np.repeat(np.arange(len(lens)), lens)
                active = np.zeros(len(codes), bool)
                active[1:] = (doc_of[1:] == doc_of[:-1]) & (codes[:-1] > 1)
                per_doc = lambda x: summed(doc_of, x, len(lens))
                rows = batch.column("docs").slice(k, 1).flatten()
                rows = pa.StructArray.from_arrays(
                    [*rows.flatten(), pa.array(lens.astype(np.int64)), pa.array(per_doc(codes > 0).astype(np.int64)),
                     pa.array(per_doc(root[codes]))], doc.names)
                score = pa.array(per_doc(np.where(active, 0.0, root[codes])))
                none = [np.zeros(0, kind) for kind in STATE[1:]]
                one = pa.array([0, len(lens)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([run], pa.int64()), pa.ListArray.from_arrays(one, rows),
                     pa.array([pack(lens, learn, codes.astype("<i4"), number, n, root)], pa.binary()),
                     pa.array([int(active.sum())], pa.int64()), pa.ListArray.from_arrays(one, score),
                     pa.array([pack(np.packbits(active), *none)], pa.binary())], names=schema.names)

    return runs.select("run", "docs", "tokens").join(told(answers, buckets), "run").mapInArrow(add, schema)


class Run:
    """A run's active tokens, their contexts of ``length`` words, and what it asks which owner."""

    def __init__(self, tokens: bytes, state: bytes, length: int, owners: int, owner_tokens: int):
        self.lens, learn, codes, number, n, root = unpack(tokens, *TOKENS)
        self.learn, self.coded, self.number = learn, codes, number
        bits, values, places, idle, parts, listable = unpack(state, *STATE)
        back = together(values, places)
        self.doc = np.repeat(np.arange(len(self.lens), dtype="<i4"), self.lens)
        self.at = at = np.flatnonzero(np.unpackbits(bits, count=len(codes)))
        if length == 1:
            back, idle = root[codes[at]].astype("<f4"), np.zeros(len(at), "<u2")
            parts = parts_of(n[codes[at - 1]], owner_tokens, owners)
        self.back = back
        self.ctx, first, self.ctx_of = grouped(self.digests(length))
        self.idle, self.parts = idle[first], parts[first].astype(np.int64)
        learned = learn[self.doc[at]] > 0
        self.total = np.bincount(self.ctx_of[learned], minlength=len(self.ctx))
        # pairs of a context and a word that is not rare, nor was so after the shorter context
        self.listable = (number >= 0)[codes[at]]
        if length > 1:
            self.listable &= np.unpackbits(listable, count=len(at)) > 0
        word = number[codes[at[self.listable]]]
        shift = bits_of(word)
        word |= self.ctx_of[self.listable].astype(np.int64) << shift
        pairs, first, self.pair_of = grouped(word)
        del word
        self.pair_n = np.bincount(self.pair_of[learned[self.listable]], minlength=len(pairs))
        self.pair_back = back[self.listable][first]
        self.pair_ctx, self.pair_word = (pairs >> shift).astype(np.int32), pairs & (1 << shift) - 1
        del pairs, first
        # a context is asked of each owner over which it is dealt, a pair of one
        home = (self.ctx >> np.uint64(64 - int(math.log2(owners)))).astype(np.int64)
        each = 1 << self.parts
        self.asked = np.repeat(np.arange(len(each), dtype=np.int32), each)
        owner = (home[self.asked] + np.arange(len(self.asked)) - np.repeat(np.cumsum(each) - each, each)) & owners - 1
        pair_owner = mixed(self.pair_word.astype(np.uint64) * BASE).astype(np.int64) & (1 << self.parts[self.pair_ctx]) - 1
        pair_owner = (home[self.pair_ctx] + pair_owner) & owners - 1
        kind = np.uint16 if owners <= 1 << 16 else np.int64
        owner, pair_owner = owner.astype(kind), pair_owner.astype(kind)
        order = np.argsort(owner, kind="stable")
        self.asked, self.owner = self.asked[order], owner[order]
        self.pair_order = np.argsort(pair_owner, kind="stable").astype(np.int32)
        self.pair_owner = pair_owner[self.pair_order]

    def digests(self, length: int) -> np.ndarray:
        """The digest of the ``length`` words before each active token."""
        value = mixed((self.number + 2).astype(np.uint64) * BASE)[self.coded]
        value *= powers(BASE, len(value))
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(value, out=total[1:])
        del value
        before = self.at - length
        out = total[self.at]
        out -= total[before]
        del total
        out *= powers(BASE_INVERSE, len(self.coded))[before]
        return out

    def codes(self):
        """(owner, message) of each owner asked."""
        size = len(self.ctx)
        key = self.owner.astype(np.int64) * size + self.asked
        pair_key = self.pair_owner.astype(np.int64) * size + self.pair_ctx[self.pair_order]
        pairs = np.searchsorted(pair_key, key, "right") - np.searchsorted(pair_key, key)
        owners, starts = np.unique(self.owner, return_index=True)
        for k, a, b in zip(owners.tolist(), starts, [*starts[1:], len(key)], strict=True):
            c = self.asked[a:b]
            p = self.pair_order[np.searchsorted(self.pair_owner, k):np.searchsorted(self.pair_owner, k, "right")]
            yield k, pack(np.diff(self.ctx[c], prepend=np.uint64(0)), self.total[c], self.idle[c], self.parts[c].astype("u1"),
                          pairs[a:b].astype("<i4"), self.pair_word[p], self.pair_n[p].astype("<i4"), *told_apart(self.pair_back[p]))

    def answered(self, answers: list[dict] | None, length: int, most_idle: int | None, owners: int, owner_tokens: int):
        """(text, log10 probability) of the tokens that end at this length; number, tokens and state of the others."""
        size = len(self.ctx)
        del self.ctx, self.total, self.owner, self.pair_owner, self.pair_ctx, self.pair_word, self.pair_n, self.pair_back
        flags, total_, outcomes_, idle_, rest_, dealt_total, dealt_sums, pair_counts = joined(answers, ANSWER)
        total, outcomes, idle, rest = np.ones(size), np.zeros(size), np.zeros(size, np.int64), np.zeros(size)
        kept, grows = np.zeros(size, bool), np.zeros(size, bool)
        kept[self.asked[flags & 1 > 0]] = True
        grows[self.asked[flags & 2 > 0]] = True
        alive = self.asked[flags & 3 > 0]
        total[alive], outcomes[alive], idle[alive], rest[alive] = total_, outcomes_, idle_, rest_
        dealt, place = np.unique(self.asked[flags & 4 > 0], return_inverse=True)
        if len(dealt):
            sums = np.array([summed(place, x, len(dealt)) for x in dealt_sums.reshape(-1, 5).T])
            all_of = np.zeros(len(dealt))
            all_of[place] = dealt_total
            some = sums[1] > 0
            dealt, sums, all_of = dealt[some], sums[:, some], all_of[some]
            total[dealt], outcomes[dealt] = all_of, sums[1]
            kept[dealt], grows[dealt], idle[dealt], rest[dealt] = judged(all_of, sums, self.idle[dealt].astype(np.int64), most_idle)
        counts = np.empty(len(pair_counts), np.int64)
        counts[self.pair_order] = pair_counts
        n = np.zeros(len(self.at), np.int64)
        n[self.listable] = counts[self.pair_of]
        del counts, pair_counts, self.pair_of, self.pair_order, self.asked, flags, alive, total_, outcomes_, idle_, rest_
        c, at = self.ctx_of.astype(np.int64), self.at  # as an index 64 bits take less time
        del self.ctx_of
        log = np.empty(len(at))
        for a in range(0, len(at), SLICE):
            b = slice(a, a + SLICE)
            log[b] = log_after(n[b], self.back[b], total[c[b]], outcomes[c[b]], kept[c[b]], rest[c[b]])
        # a longer context needs a word before, not a rare one, and is what the word before makes of its own context
        often = n >= LEAST_COUNT
        del n
        starts = np.cumsum(self.lens, dtype=np.int64) - self.lens
        goes = grows[c]
        goes[goes] = at[goes] - length > starts[self.doc[at[goes]]]
        goes[goes] = self.number[self.coded[at[goes] - length - 1]] >= 0
        seen = np.ones(len(self.coded), bool)
        seen[at] = often
        goes[goes] = seen[at[goes] - 1]
        bits = np.zeros(len(self.coded), bool)
        bits[at[goes]] = True
        # what lies behind a text's last active token is in no longer context
        lens = np.zeros(len(self.lens), "<i4")
        lens[self.doc[at[goes]]] = at[goes] - starts[self.doc[at[goes]]] + 1
        need = np.arange(len(bits)) < (starts + lens)[self.doc]
        codes, bits = self.coded[need], bits[need]
        del need
        used = np.bincount(codes, minlength=len(self.number)) > 0
        tokens = pack(lens, self.learn, (np.cumsum(used) - 1).astype("<i4")[codes], self.number[used],
                      *(np.zeros(0, kind) for kind in TOKENS[4:]))
        state = pack(np.packbits(bits), *told_apart(log[goes].astype("<f4")), idle[c[goes]].astype("<u2"),
                     parts_of(total[c[goes]], owner_tokens, owners), np.packbits(often[goes]))
        return self.doc[at[~goes]], log[~goes], int(goes.sum()), tokens, state


def context_answers(table: pa.Table, most_idle: int | None) -> pa.Table:
    """An owner's answers to the messages of all runs, a range of about PART_PAIRS pairs after the other."""
    sent = []
    for code in table.column("code").to_pylist():
        gaps, total, idle, parts, pairs, word, n, values, places = unpack(code, *MESSAGE)
        sent.append((np.cumsum(gaps, dtype=np.uint64), total, idle, parts, pairs, word, n, together(values, places)))
    some = np.sort(np.concatenate([m[0][::64] for m in sent]))
    ranges = 1 + sum(len(m[5]) for m in sent) // PART_PAIRS
    cuts = some[np.arange(1, ranges) * len(some) // ranges]
    at = [[0, *np.searchsorted(m[0], cuts), len(m[0])] for m in sent]
    pair_at = [np.append(0, np.cumsum(m[4]))[x] for m, x in zip(sent, at, strict=True)]
    found = [[] for _ in sent]
    for r in range(ranges):
        asked = [(*(x[a[r]:a[r + 1]] for x in m[:5]), *(x[p[r]:p[r + 1]] for x in m[5:]))
                 for m, a, p in zip(sent, at, pair_at, strict=True)]
        for out, answer in zip(found, range_answers(asked, most_idle), strict=True):
            out.append(answer)
    codes = [pack(*(np.concatenate(x) for x in zip(*out, strict=True))) for out in found]
    give_back()
    return pa.table({"run": table.column("run"), "owner": table.column("owner"), "code": pa.array(codes, pa.binary())})


def range_answers(sent: list[tuple[np.ndarray, ...]], most_idle: int | None):
    """The arrays of the answer to each of ``sent``: contexts (digests, tokens, idle, parts, pairs), pairs (word, count, back)."""
    sizes, pair_sizes = np.cumsum([len(m[0]) for m in sent])[:-1], np.cumsum([len(m[5]) for m in sent])[:-1]
    digests, total, idle, parts, pairs, word, n, back = (np.concatenate(x) for x in zip(*sent, strict=True))
    ctx, first, place = grouped(digests)
    size = len(ctx)
    total, idle, dealt = summed(place, total, size), idle[first].astype(np.int64), parts[first] > 0
    shift = bits_of(word)
    keys, first, pair_of = grouped(np.repeat(place.astype(np.int64), pairs) << shift | word)
    n = summed(pair_of, n, len(keys)).astype(np.int64)
    n[n < LEAST_COUNT] = 0
    sums = outcome_sums(keys >> shift, n, back[first], size)
    kept, grows, rest = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size)
    some = np.flatnonzero((sums[1] > 0) & ~dealt)
    kept[some], grows[some], idle[some], rest[some] = judged(total[some], sums[:, some], idle[some], most_idle)
    rest[~kept] = 0
    flags = (kept + 2 * grows + 4 * dealt).astype("u1")
    for c, counts in zip(np.split(place, sizes), np.split(n[pair_of], pair_sizes), strict=True):
        alive, cut = c[flags[c] & 3 > 0], c[dealt[c]]
        yield (flags[c], total[alive].astype("<i8"), sums[1][alive].astype("<i8"), idle[alive].astype("<u2"), rest[alive],
               total[cut].astype("<i8"), np.ascontiguousarray(sums[:, cut].T).reshape(-1), counts)


def grown(runs: DataFrame, length: int, most_idle: int | None, owners: int, owner_tokens: int, buckets: int) -> DataFrame:
    """``runs``, in buckets, after contexts of ``length`` words; they stay where they lie, only answers are shuffled."""
    schema = runs.schema

    def ask(tokens, state, active):
        return Run(tokens, state, length, owners, owner_tokens).codes() if active else ()

    def score(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                active, tokens, state, said = (batch.column(c)[k].as_py() for c in ("active", "tokens", "state", "told"))
                score = batch.column("score").slice(k, 1).flatten().to_numpy()
                if active:
                    doc, log, active, tokens, state = Run(tokens, state, length, owners, owner_tokens).answered(
                        said, length, most_idle, owners, owner_tokens)
                    score = score + summed(doc, log, len(score))
                    tokens = tokens if active else b""
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(k, 1) for c in ("run", "docs")), pa.array([tokens], pa.binary()),
                     pa.array([active], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(score)], pa.int32()), pa.array(score)),
                     pa.array([state], pa.binary())], names=schema.names)
                give_back()

    answers = written(messages(runs, ["tokens", "state", "active"], ask).groupBy("owner").applyInArrow(
        lambda table: context_answers(table, most_idle), "run long, owner int, code binary"), "answers")
    after = in_buckets(runs.join(told(answers, buckets), "run", "left").mapInArrow(score, schema), "run", buckets)
    release(answers)
    return after


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 1,
              folds: int = 5, idle: int | None = IDLE, run_tokens: int = RUN_TOKENS,
              owner_tokens: int = OWNER_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learned from the rows whose crc32(id as text) mod ``folds`` is not
    ``held_out``; null ids are learned from.  Null texts are empty: their
    only token is the end.  base_score: the unigram log10 probability with
    half a count added to every word and one unknown; score: the suffix
    tree's, whose outcomes are the same words, so the two compare.  Repeated
    rows are learned and scored as often as they occur; other columns are not
    read; an empty table gives no rows.  ``idle`` ends a branch after so many
    lengths in a row that were not kept, which is cheaper and can miss longer
    contexts behind them; None follows every branch that its bound allows.
    ``run_tokens`` and ``owner_tokens`` bound a task's memory and change no
    score: a run holds whole texts, so at least the longest, and an owner the
    pairs of about ``owner_tokens`` tokens, whatever one context's share.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(crc_mod(F.col(id_col), folds) == held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # a round writes its result, so its shuffle files are no more needed; a batch is to hold few runs; what is packed
    # is not compressed again
    with setting(docs.sparkSession, {SHUFFLES_GO: "true", BATCH_BYTES: str(4 * run_tokens), CODEC: "uncompressed"}):
        runs = written(cut_runs(texts, run_tokens), "runs")
        count = runs.count()
        least = max(1, count * run_tokens // owner_tokens)
        owners = max(LEAST_OWNERS, 1 << (least - 1).bit_length())
        buckets = min(MOST_BUCKETS, max(LEAST_OWNERS, 1 << count.bit_length()))
        answers = written(word_answers(runs, owners), "words")
        tokens, types = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types"))).first()
        state = in_buckets(with_words(runs, answers, math.log10(tokens + 0.5 * (types + 1)), buckets), "run", buckets)
        release(runs)
        release(answers)
        length = 1
        while state.agg(F.coalesce(F.sum("active"), F.lit(0))).first()[0]:
            before, state = state, grown(state, length, idle, owners, owner_tokens, buckets)
            release(before)
            length += 1
    rows = state.select(F.explode(F.arrays_zip("docs", "score")).alias("row"))
    return rows.select(
        *(F.col(f"row.docs.{c}").alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")),
        F.lit(tokens).cast("long").alias("train_tokens"), "row.docs.base_score", "row.score")
