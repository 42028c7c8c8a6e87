"""Packing token sequences by bounded-space online best fit.

Each task keeps a fixed number of open bins.  A bitset has a bit for every
free space that some open bin has, so the tightest bin that still holds a
piece is the lowest set bit at or above its length.  When no bin fits and all
places are taken, the fullest open bin closes first.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, written

ROOM = 1024
END_ID = 2
# Bins a task keeps open; about as many pieces as one task packs, so that
# large pieces, which come first, still meet the small ones.
OPEN_BINS = 1 << 16
PIECES_A_TASK = 100_000
# Words whose ids a Python worker remembers.
KNOWN_WORDS = 300_000
# Bytes of text that are encoded together.
TEXT_BYTES = 1 << 22
# Characters on which every Unicode version of the split pattern agrees.
PLAIN = re.compile("[!-~¡-ɏ][\t\n\r!-~¡-ɏ]*")
SPACES = re.compile("[\\s\x85᠎​﻿] [\\s\x85᠎​﻿]")


class WordIds:
    """Token ids of whole texts through a bounded table of the ids of their words.

    The vocabulary's split pattern always breaks before a space that follows
    or precedes a character other than white space, so a text's ids are those
    of its first word and of " word" for each further one.  Texts with a space
    between white space and texts that hold one of the tokenizer's added tokens
    (which it cuts out before it splits) go to it whole.  Words outside PLAIN are
    also encoded by the tokenizer; plain new words are encoded many at a time
    from the same vocabulary's rank file, where the tokens that begin with a
    space mark the words' beginnings.
    """

    def __init__(self, tokenizer_path: str | None, ranks_path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranked = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN,
                                        mergeable_ranks=ranks, special_tokens={})
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[n for word, n in ranks.items() if word[:1] == b" "]] = True
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """The ids of a text or word as little-endian unsigned 32-bit numbers."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of " word" for words without a space."""
        found, plain = {}, []
        for w in words:
            if PLAIN.fullmatch(w):
                plain.append(w)
            else:
                found[w] = self.whole(" " + w)
        for i in range(0, len(plain), 20_000):
            part = plain[i:i + 20_000]
            ids = np.array(self.ranked.encode_ordinary(" " + " ".join(part)), "<u4")
            at = [*np.flatnonzero(self.opens[ids]).tolist(), len(ids)]
            raw = ids.tobytes()
            found.update(zip(part, (raw[4 * a:4 * z] for a, z in zip(at, at[1:])), strict=False))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [self.whole(x) if SPACES.search(x) or any(a in x for a in self.added) else None for x in texts]
        rest = [k for k, x in enumerate(out) if x is None]
        if not rest:
            return out
        words = pc.split_pattern(pa.array([texts[k] for k in rest], pa.large_string()), " ")
        ends = np.cumsum(words.value_lengths().to_numpy())
        coded = words.flatten().dictionary_encode()
        number, first = coded.indices.to_numpy(), np.append(0, ends[:-1])
        later = np.ones(len(number), bool)
        later[first] = False  # a text's first word has no space before it
        used = np.zeros(len(coded.dictionary), bool)
        used[number[later]] = True
        vocabulary = coded.dictionary.to_pylist()
        fresh = self.words([w for w, k in zip(vocabulary, used.tolist(), strict=True) if k and w not in self.known])
        ids = [(self.known.get(w) or fresh[w]) if k else b"" for w, k in zip(vocabulary, used.tolist(), strict=True)]
        room = KNOWN_WORDS - len(self.known)
        self.known.update(itertools.islice(fresh.items(), max(room, 0)))
        # the ids of all words behind one another, from the table of the distinct ones
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        table, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        count = np.where(later, sizes[number], 0)
        stop = np.cumsum(count)
        flat = table[np.repeat(starts[number] - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)]
        for k, a, z in zip(rest, first.tolist(), ends.tolist(), strict=True):
            head = vocabulary[number[a]]
            out[k] = (self.whole(head) if head else b"") + flat[stop[a]:stop[z - 1]].tobytes()
        return out


# The encoders of this Python worker; they outlive a task with their tables of words.
_encoders: dict[tuple, WordIds] = {}


def word_ids(tokenizer_path: str | None, ranks_path: str | None) -> WordIds:
    key = (tokenizer_path, ranks_path)
    if key not in _encoders:
        _encoders[key] = WordIds(*key)
    return _encoders[key]


def pieces_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM,
              tokenizer_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): texts as token ids, cut to ``room``.

    A null or empty text is one piece, the end id alone.  Only a document
    longer than ``room`` is cut; its first piece takes the remainder, all
    others are full.
    """
    # a document of L ids has ceil(L / room) pieces
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])

    def cut(batches):
        encoder, end = word_ids(tokenizer_path, ranks_path), np.array([END_ID], "<u4").tobytes()
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            rows, piece, start, length, crc = [], [], [], [], []
            for row, raw in enumerate(encoder.encode(batch.column("text").to_pylist())):
                raw += end
                n, at, k = len(raw) // 4, 0, 0
                size = n % room or room
                while at < n:
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(raw[4 * at:4 * (at + size)]))
                    at, k, size = at + size, k + 1, room
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return narrow.mapInArrow(cut, schema)


class OpenBins:
    """A fixed number of open bins, found by their free space."""

    def __init__(self, room: int, most: int):
        self.room, self.most, self.count, self.made, self.bits = room, most, 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(room + 1)]

    def take(self, free: int) -> int:
        """Remove and return a bin that has so much free space."""
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece; its bin is the fullest that can hold it."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self.take(free)
        else:
            if self.count >= self.most:
                self.take((self.bits & -self.bits).bit_length() - 1)
            number, free = self.made, self.room
            self.made += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.room - free


def pack(pieces: DataFrame, length_col: str = "length", room: int = ROOM,
         open_bins: int = OPEN_BINS, pieces_a_task: int = PIECES_A_TASK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``room`` ids.

    The pieces are dealt out evenly, about ``pieces_a_task`` to a task, and
    arrive there longest first.  A task holds ``open_bins`` bins at most and
    leaves a few half-filled, so the loss is a few bins in each
    ``pieces_a_task`` pieces.  The order within a task is total, so a rerun
    packs alike.  An empty table gives no rows.
    """
    pieces = written(pieces, "pieces")
    tasks = max(1, round(pieces.count() / pieces_a_task))
    # a total order, but for rows that are equal throughout
    order = [F.desc(length_col), *(c for c in pieces.columns if c != length_col)]
    dealt = pieces.repartition(tasks, *pieces.columns).sortWithinPartitions(*order)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def fill(batches):
        from pyspark import TaskContext

        first, bins = TaskContext.get().partitionId() << 40, OpenBins(room, open_bins)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(length_col).to_pylist()]
            number, offset = zip(*placed, strict=True) if placed else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + n for n in number], pa.int64()), pa.array(offset, pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"])

    return dealt.mapInArrow(fill, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   room: int = ROOM, **paths: str | None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Null and empty texts are a piece of one id; repeated rows and ids are
    packed apart; other columns are not read.
    """
    return pack(pieces_of(docs, id_col, text_col, room, **paths), room=room)
