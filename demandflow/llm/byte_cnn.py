"""Operator 6: a quality score from a convolutional network over bytes.

A text is cut into overlapping chunks that cover all of it. In each chunk learned filters over
a few consecutive bytes are max-pooled, a small layer turns the pooled values into
the chunk's evidence against quality, and the strongest evidence of all chunks gives the
document's probability. The network is trained on a bounded sample of labelled documents and scores
every text where it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import text_of
from demandflow.llm.labelled import fold, sample
from demandflow.session import ship_package

FOLDS, HELD_OUT = 5, 0
PER_CLASS = 1500  # labelled documents of each class at most
TRAIN_BYTES = 16_000_000  # of the texts of a class in training, whole texts only
SLICE = 1024  # chunks that training pools at a time
WIDTH = 4  # bytes of a filter
FILTERS = 16
HIDDEN = 16
CHUNK = 512
STEP = 256  # between the starts of chunks
EPOCHS = 10
BATCH = 32
RATE = 4e-3
SEED = 5


def cut(data: bytes) -> np.ndarray:
    """The chunks of a text as rows of CHUNK bytes, zeros behind its end."""
    n = max(1, -(-max(0, len(data) - CHUNK) // STEP) + 1)
    padded = np.zeros((n - 1) * STEP + CHUNK, dtype=np.uint8)
    padded[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


@dataclass
class Net:
    """Weights: of the filters by place and byte, and of the two layers behind the pooling."""

    filters: np.ndarray  # WIDTH, 256, FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS, HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray  # HIDDEN
    out_bias: np.ndarray  # 1

    @classmethod
    def fresh(cls, seed: int = SEED) -> Net:
        random = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return random.normal(0, scale, shape).astype(np.float32)

        return cls(
            normal(WIDTH, 256, FILTERS, scale=0.5),
            np.zeros(FILTERS, np.float32),
            normal(FILTERS, HIDDEN, scale=0.35),
            np.zeros(HIDDEN, np.float32),
            normal(HIDDEN, scale=0.35),
            np.zeros(1, np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Evidence of each chunk, and the values of the two layers below."""
        features = np.maximum(pooled + self.bias, 0)
        inner = np.maximum(features @ self.hidden + self.hidden_bias, 0)
        return inner @ self.out + self.out_bias[0], inner, features


class Scorer:
    """A trained network applied to whole texts.

    Two tables hold the filters' sums for all pairs of bytes, so a window of four bytes takes two lookups. The maximum
    is taken per half chunk, of which neighbours share one.
    """

    def __init__(self, net: Net) -> None:
        f = net.filters
        self.net = net
        self.first = (f[0][:, None, :] + f[1][None, :, :]).reshape(-1, FILTERS)
        self.second = (f[2][:, None, :] + f[3][None, :, :]).reshape(-1, FILTERS)

    def pooled(self, data: bytes) -> np.ndarray:
        """Maxima of the filters in each chunk: windows that begin in it, those at its end reach beyond."""
        raw = np.frombuffer(data.ljust(WIDTH, b"\0"), dtype=np.uint8).astype(np.int32)
        pairs = raw[:-1] * 256 + raw[1:]
        windows = len(pairs) - 2
        halves = np.empty((-(-windows // STEP), FILTERS), dtype=np.float32)
        for i in range(len(halves)):
            a, b = i * STEP, min(windows, (i + 1) * STEP)
            halves[i] = (self.first[pairs[a:b]] + self.second[pairs[a + 2 : b + 2]]).max(axis=0)
        return np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves

    def score(self, data: bytes) -> float:
        evidence = self.net.head(self.pooled(data))[0].max()
        return float(1 / (1 + np.exp(np.clip(evidence, -30, 30))))


def pool(net: Net, chunks: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maxima of the filters over the windows of each chunk that lie in its text, and where they are."""
    windows = CHUNK - WIDTH + 1
    sums = net.filters[0][chunks[:, :windows]]
    for k in range(1, WIDTH):
        sums = sums + net.filters[k][chunks[:, k : k + windows]]
    beyond = np.arange(windows)[None, :] > np.maximum(lengths - WIDTH, 0)[:, None]
    sums[beyond] = -np.inf
    at = sums.argmax(axis=1)
    return np.take_along_axis(sums, at[:, None, :], axis=1)[:, 0, :], at


def pool_all(net: Net, chunks: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pool`` of any number of chunks, SLICE at a time."""
    parts = [pool(net, chunks[i : i + SLICE], lengths[i : i + SLICE]) for i in range(0, len(chunks), SLICE)]
    return np.concatenate([p for p, _ in parts]), np.concatenate([a for _, a in parts])


def train(chunks: list[np.ndarray], lengths: list[np.ndarray], bad: np.ndarray, epochs: int = EPOCHS) -> Net:
    """Logistic loss of the documents' strongest evidence, by Adam; classes weigh the same.

    The gradient of a maximum reaches one chunk of a document and one window of a filter.
    """
    net, random = Net.fresh(), np.random.default_rng(SEED)
    weights = net.weights()
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    share = np.array([np.mean(bad == 0), np.mean(bad == 1)])
    weight = 0.5 / np.maximum(share, 1e-9)
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(len(chunks)), max(1, len(chunks) // BATCH)):
            counts = np.array([len(chunks[i]) for i in batch])
            starts = np.cumsum(counts) - counts
            x, n = np.concatenate([chunks[i] for i in batch]), np.concatenate([lengths[i] for i in batch])
            pooled, at = pool_all(net, x, n)
            evidence, inner, features = net.head(pooled)
            strongest = np.array([s + evidence[s : s + c].argmax() for s, c in zip(starts, counts, strict=True)])
            y = bad[batch]
            p = 1 / (1 + np.exp(-np.clip(evidence[strongest], -30, 30)))
            slope = ((p - y) * weight[y.astype(int)] / len(batch)).astype(np.float32)
            d_inner = slope[:, None] * net.out * (inner[strongest] > 0)
            d_features = (d_inner @ net.hidden.T) * (features[strongest] > 0)
            d_filters = np.zeros_like(net.filters)
            columns = np.broadcast_to(np.arange(FILTERS), d_features.shape)
            for k in range(WIDTH):
                touched = np.take_along_axis(x[strongest], at[strongest] + k, axis=1)
                np.add.at(d_filters[k], (touched, columns), d_features)
            gradients = [
                d_filters,
                d_features.sum(axis=0),
                features[strongest].T @ d_inner,
                d_inner.sum(axis=0),
                inner[strongest].T @ slope,
                slope.sum(keepdims=True),
            ]
            step += 1
            for w, g, m, v in zip(weights, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def whole_texts(sizes: list[tuple[int, int, int]], most: int = TRAIN_BYTES) -> set[int]:
    """Of (doc_id, label, bytes) the ids, in order, whose texts together have at most ``most`` bytes a label.

    A text that does not fit any more is passed over whole; where none fits, the shortest is taken.
    """
    chosen: set[int] = set()
    for label in {label for _, label, _ in sizes}:
        of_label = [(doc_id, n) for doc_id, k, n in sizes if k == label]
        room, taken = most, []
        for doc_id, n in of_label:
            if n <= room:
                taken.append(doc_id)
                room -= n
        chosen.update(taken or [min(of_label, key=lambda x: x[1])[0]])
    return chosen


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Net | None:
    """A network trained on all chunks of the sample, none if it holds fewer than two classes.

    The driver gets at most 2 * PER_CLASS whole texts of TRAIN_BYTES a class, or one that is longer.
    """
    texts = sample(docs, labels, label, FOLDS, HELD_OUT, PER_CLASS)
    typed = texts.select(F.col("doc_id").cast("bigint"), "text", "label")
    order = F.xxhash64("doc_id"), "doc_id"
    sizes = typed.orderBy(*order).select("doc_id", "label", F.octet_length("text").alias("n")).collect()
    chosen = whole_texts([tuple(r) for r in sizes])
    if len(chosen) < len(sizes):
        typed = typed.where(F.col("doc_id").isin(list(chosen)))
    rows = sorted(typed.collect(), key=lambda r: r["doc_id"])
    bad = np.array([1 - r["label"] for r in rows], dtype=np.float32)
    if len(set(bad.tolist())) < 2:
        return None
    data = [r["text"].encode("utf-8", "replace") for r in rows]
    chunks = [cut(d) for d in data]
    lengths = [np.clip(len(d) - STEP * np.arange(len(c)), 0, CHUNK) for d, c in zip(data, chunks, strict=True)]
    return train(chunks, lengths, bad)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    The score is the probability of the label 1, from the bytes of the whole text alone; a null or empty text is scored
    as four zero bytes. Equal texts get equal scores. Without labels of both kinds every score is
    0.5. A null doc_id is not held out. An empty table gives no rows; other columns are not looked at.
    """
    ship_package(docs.sparkSession)
    net = fitted(docs, labels)
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if net is None else Scorer(net)
        for batch in batches:
            values = [0.5 if scorer is None else scorer.score(t.as_buffer().to_pybytes()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    scored = texts.mapInArrow(score, "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
