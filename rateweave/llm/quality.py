"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters run over the bytes of the whole text.  Their responses are
max-pooled over overlapping chunks that together cover the text; the largest,
smallest and mean pooled response of each filter over the chunks are combined
into one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, crc_mod, free_name, with_fields

FILTERS = 16
WIDTH = 6
# Bytes from one chunk's start to the next; a chunk is two steps long.
STEP = 256
# The sample that the filters are learned from: at most so many labelled rows,
# each of at most so many bytes, chosen by a hash of the id.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 1 << 16
EPOCHS = 12
# Bytes of one text that are convolved at a time.
SPAN = 1 << 20


class Network:
    """filters (WIDTH, 256, FILTERS), bias, and the weights of the three poolings."""

    def __init__(self, filters, bias, weights, offset):
        self.filters, self.bias, self.weights, self.offset = filters, bias, weights, offset

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                   rng.normal(0, 0.1, (3, FILTERS)).astype(np.float32), np.zeros(1, np.float32))

    def tables(self) -> list[np.ndarray]:
        """The filters' responses to each pair of bytes, for each pair of positions."""
        return [(self.filters[k][:, None] + self.filters[k + 1][None]).reshape(65536, FILTERS)
                for k in range(0, WIDTH, 2)]

    def parameters(self):
        return [self.filters, self.bias, self.weights, self.offset]


def block_peaks(raw: bytes, tables: list[np.ndarray]) -> np.ndarray:
    """Each filter's largest response in each block of STEP positions, (blocks, FILTERS)."""
    found = []
    for start in range(0, max(len(raw), 1), SPAN):
        part = raw[start:start + SPAN + WIDTH - 1]
        codes = np.frombuffer(part.ljust(WIDTH, b"\0"), np.uint8)
        pairs = codes[:-1].astype(np.int32) * 256 + codes[1:]
        n = len(codes) - WIDTH + 1
        for k in range(0, n, 1 << 14):
            m = min(1 << 14, n - k)
            act = tables[0][pairs[k:k + m]]
            for t in range(1, len(tables)):
                act += tables[t][pairs[k + 2 * t:k + 2 * t + m]]
            found.append(np.maximum.reduceat(act, np.arange(0, m, STEP), axis=0))
    return np.concatenate(found)


def pooled(peaks: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Responses of overlapping chunks of two blocks, rectified."""
    chunks = np.maximum(peaks[:-1], peaks[1:]) if len(peaks) > 1 else peaks
    return np.maximum(chunks + bias, 0)


def probability(chunks: np.ndarray, net: Network) -> float:
    z = net.offset[0] + (np.stack([chunks.max(0), chunks.min(0), chunks.mean(0)]) * net.weights).sum()
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 16,
          rate: float = 0.01, seed: int = 7) -> Network:
    """Learn all parameters by Adam on the log loss."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    codes = [np.frombuffer(x.ljust(WIDTH, b"\0"), np.uint8) for x in texts]
    moves, total = 0, epochs * -(-len(codes) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for b in range(0, len(order), batch):
            grads = [np.zeros_like(p) for p in net.parameters()]
            for d in order[b:b + batch]:
                x, n = codes[d], len(codes[d]) - WIDTH + 1
                act = net.filters[0][x[:n]]
                for k in range(1, WIDTH):
                    act += net.filters[k][x[k:n + k]]
                starts = range(0, max(n - STEP, 1), STEP)
                at = np.array([s + act[s:s + 2 * STEP].argmax(0) for s in starts])
                peak = act[at, np.arange(FILTERS)] + net.bias
                chunks = np.maximum(peak, 0)
                top, low = chunks.argmax(0), chunks.argmin(0)
                error = probability(chunks, net) - labels[d]
                grads[2] += error * np.stack([chunks.max(0), chunks.min(0), chunks.mean(0)])
                grads[3] += error
                back = np.repeat((error * net.weights[2] / len(chunks))[None], len(chunks), 0)
                np.add.at(back, (top, np.arange(FILTERS)), error * net.weights[0])
                np.add.at(back, (low, np.arange(FILTERS)), error * net.weights[1])
                back *= peak > 0
                grads[1] += back.sum(0)
                c, f = np.nonzero(back)
                where = at[c, f]
                for k in range(WIDTH):
                    np.add.at(grads[0][k], (x[where + k], f), back[c, f])
            moves += 1
            speed = rate * (1 - 0.9 * moves / total) * np.sqrt(1 - 0.999**moves) / (1 - 0.9**moves)
            for p, g, u, v in zip(net.parameters(), grads, first, second, strict=True):
                g /= batch
                u *= 0.9
                u += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= speed * u / (np.sqrt(v) + 1e-8)
    return net


def learn_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample_rows: int = SAMPLE_ROWS,
                  sample_bytes: int = SAMPLE_BYTES) -> Network | None:
    """The network learned from labelled documents that are not held out; None without any.

    Held out are rows whose crc32(id as text) mod 3 is 1.  The sample has
    ``sample_rows`` rows at most and is learned in one task; ids are picked
    from the labels first, so the documents' texts are read once and not
    shuffled.
    """
    order = F.xxhash64("id")
    ids = labels.filter(F.col(label_col).isin(0, 1) & (crc_mod(F.col(id_col), 3) != 1)).groupBy(
        F.col(id_col).alias("id")).agg(F.max(label_col).alias("label")).orderBy(order, "id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter(
        F.octet_length("text") <= sample_bytes)
    sample = texts.join(F.broadcast(ids), "id").orderBy(order, "id", "text").limit(sample_rows)

    def fit(batches):
        raw, told = [], []
        for batch in batches:
            raw += [x.encode() for x in batch.column("text").to_pylist()]
            told += batch.column("label").to_pylist()
        if raw:
            net = train(raw, np.array(told, np.float32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.astype("<f4").tobytes()], pa.binary()) for p in net.parameters()],
                names=["filters", "bias", "weights", "offset"])

    # one row of four fixed-size arrays
    row = sample.select("text", "label").mapInArrow(
        fit, "filters binary, bias binary, weights binary, offset binary").first()
    if row is None:
        return None
    shapes = [p.shape for p in Network.fresh().parameters()]
    return Network(*(np.frombuffer(x, "<f4").reshape(s) for x, s in zip(row, shapes, strict=True)))


def score_quality(docs: DataFrame, net: Network | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """Add ``name``: the probability that a document's quality label is 1.

    Null texts count as empty; the empty text is scored like any other.  Rows
    are scored one by one, so repeats and further columns do not matter; a
    column ``name`` is replaced.  Without a network every score is 0.5.
    """
    rest = docs.drop(name)
    if net is None:
        return rest.withColumn(name, F.lit(0.5))
    parameters = net.parameters()

    def score(batches):
        model = Network(*parameters)
        tables = model.tables()
        for batch in by_bytes(batches, text_col):
            scores = [probability(pooled(block_peaks((x or "").encode(), tables), model.bias), model)
                      for x in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return rest.mapInArrow(score, with_fields(rest, **{name: T.DoubleType()}))


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Whole texts are scored, however long; null and empty ones alike, as an
    empty text.  Rows with equal texts score the same, repeated rows each have
    one.  A null id is not held out.  Without labels all scores are 0.5.  Other
    columns are not read; an empty table gives no rows.
    """
    net = learn_quality(docs, labels, id_col, text_col)
    scored = score_quality(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), net)
    return scored.select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, with all their columns, whatever these are called.

    Nulls, empty and repeated texts: see ``classify_quality``.
    """
    name = free_name(docs, "score")
    net = learn_quality(docs, labels, id_col, text_col)
    return score_quality(docs, net, text_col, name).filter(F.col(name) >= 0.5).select(docs.columns)
