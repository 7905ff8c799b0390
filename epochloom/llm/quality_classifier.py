"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Tokens are runs of letters, of digits or of other marks, so signs around a word are tokens too.
A token type is one of ``TYPES`` by hash and has a fixed sparse random index vector; its context
vector is the sum of the index vectors of the neighbours within ``WINDOW``, over all documents, by
a distributed sum. The table has a fixed size, whatever the corpus, and is broadcast.

A document is the mean and the standard deviation of its tokens' unit vectors. A two-layer numpy
network is trained on up to ``SAMPLE`` labelled rows per class; a fifth of them is kept apart and
sets the temperature by which the probabilities are calibrated.

Null and empty texts pool to zero vectors and get the score of that. Without labelled rows of both
classes every score is 0.5. Rows are scored one by one, so repeated rows agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epochloom.llm.batches import (
    IS_SPACE,
    Texts,
    Words,
    map_slices,
    mix,
    run_index,
    slices,
    texts_of,
    word_hashes,
)
from epochloom.llm.shared import arrived, shipped
from epochloom.llm.training import bounded_sample, held_out, known_labels, sampled_texts, sigmoid

TYPES = 1 << 14
DIMENSIONS = 32
WINDOW = 2
SAMPLE = 3000
APART = 5
HIDDEN = 24
#: Classes of bytes: 0 space, 1 letter (all bytes beyond ASCII too), 2 digit, 3 other.
CLASS = np.full(256, 3, np.uint8)
CLASS[IS_SPACE] = 0
CLASS[48:58] = 2
CLASS[65:91] = CLASS[97:123] = CLASS[128:] = 1


def token_types(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The type of each token, and tokens per text."""
    texts: Texts = texts_of(column)
    kind = CLASS[texts.data]
    change = np.ones(len(kind) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[texts.offsets] = True
    edges = np.flatnonzero(change)
    starts, lengths = edges[:-1], np.diff(edges)
    full = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, lengths = starts[full], lengths[full]
    counts = np.diff(np.searchsorted(starts, texts.offsets))
    hashes = word_hashes(texts.data, Words(starts, lengths, counts))
    return (hashes % np.uint64(TYPES)).astype(np.int64), counts


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Two places and their signs for each type."""
    draw = mix(np.arange(TYPES, dtype=np.uint64) + np.uint64(0x51ED2701))
    first = draw % np.uint64(DIMENSIONS)
    second = (first + 1 + (draw >> np.uint64(16)) % np.uint64(DIMENSIONS - 1)) % np.uint64(DIMENSIONS)
    place = np.stack([first, second], axis=1).astype(np.int64)
    sign = np.stack([(draw >> np.uint64(40)) & 1, (draw >> np.uint64(41)) & 1], axis=1)
    return place, sign.astype(np.float64) * 2 - 1


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all types, over all documents."""
    columns = [f"v{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros(TYPES * DIMENSIONS)
        for batch in batches:
            for piece in slices(batch):
                types, counts = token_types(piece.column("text"))
                at, n = run_index(counts), np.repeat(counts, counts)
                for distance in range(1, WINDOW + 1):
                    left = np.flatnonzero(at < n - distance)
                    right = left + distance
                    for a, b in ((left, right), (right, left)):
                        for k in (0, 1):
                            cell = types[a] * DIMENSIONS + place[types[b], k]
                            total += np.bincount(cell, sign[types[b], k], len(total))
        table = total.reshape(TYPES, DIMENSIONS)
        used = np.flatnonzero(np.abs(table).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), *[pa.array(table[used, i]) for i in range(DIMENSIONS)]],
            names=["type", *columns],
        )

    schema = "type int, " + ", ".join(f"{c} double" for c in columns)
    summed = (
        docs.select("text")
        .mapInArrow(run, schema)
        .groupBy("type")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .toArrow()
    )
    out = np.zeros((TYPES, DIMENSIONS))
    if summed.num_rows:
        out[summed.column("type").to_numpy()] = np.stack(
            [summed.column(c).to_numpy() for c in columns], axis=1
        )
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the token vectors of each text."""
    types, counts = token_types(column)
    out = np.zeros((len(counts), 2 * DIMENSIONS))
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        each = vectors[types]
        n = counts[full][:, None]
        mean = np.add.reduceat(each, starts, axis=0) / n
        square = np.add.reduceat(each * each, starts, axis=0) / n
        out[full, :DIMENSIONS] = mean
        out[full, DIMENSIONS:] = np.sqrt(np.maximum(square - mean**2, 0))
    return out


class Network:
    """tanh layer and logistic output on standardised inputs, with a temperature."""

    def __init__(self, center, scale, layers, temperature=1.0):
        self.center, self.scale, self.layers, self.temperature = center, scale, layers, temperature

    def margins(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.center) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margins(x) / self.temperature)


def fit_network(x: np.ndarray, y: np.ndarray, steps: int = 400) -> Network:
    rng = np.random.default_rng(11)
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - center) / scale
    layers = [
        rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    m, v = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for t in range(1, steps + 1):
        hidden = np.tanh(z @ layers[0] + layers[1])
        error = weight * (sigmoid(hidden @ layers[2] + layers[3]) - y)
        back = np.outer(error, layers[2]) * (1 - hidden**2)
        slopes = [z.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]
        for i, slope in enumerate(slopes):
            slope = slope + 1e-5 * layers[i]
            m[i] = 0.9 * m[i] + 0.1 * slope
            v[i] = 0.99 * v[i] + 0.01 * slope**2
            layers[i] = layers[i] - 0.02 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
    return Network(center, scale, layers)


def fit_temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, on a grid."""
    grid = np.geomspace(0.2, 8, 60)
    loss = [np.logaddexp(0, np.where(y == 1, -margins, margins) / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


class QualityScorer:
    def __init__(self, vectors=None, network: Network | None = None):
        self.vectors, self.network = vectors, network

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(column), 0.5)
        return self.network.scores(pooled(column, self.vectors))


def train(docs: DataFrame, labels: DataFrame, modulus: int = 0, rest: int = 0) -> QualityScorer:
    known = known_labels(labels, "quality", modulus, rest)
    sample = sampled_texts(docs, bounded_sample(known, SAMPLE))
    vectors = context_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    apart = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(APART)) == 0

    def make():
        def step(batch):
            x = pooled(batch.column("text"), shared.value)
            return {
                "doc_id": batch.column("doc_id"),
                "label": batch.column("label"),
                "apart": batch.column("apart"),
                "x": [row.tobytes() for row in x],
            }

        return step

    schema = "doc_id long, label int, apart boolean, x binary"
    rows = map_slices(sample.withColumn("apart", apart), make, schema).orderBy("doc_id", "x").toArrow()
    y = rows.column("label").to_numpy().astype(np.float64)
    own = ~rows.column("apart").to_numpy().astype(bool)
    if not (0 < y[own].sum() < own.sum()):
        return QualityScorer()
    x = np.stack([np.frombuffer(b, np.float64) for b in rows.column("x").to_pylist()])
    network = fit_network(x[own], y[own])
    if (~own).any():
        network.temperature = fit_temperature(network.margins(x[~own]), y[~own])
    return QualityScorer(vectors, network)


def score(
    docs: DataFrame, model: QualityScorer, threshold: float, modulus: int = 5, rest: int = 0
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = shipped(docs.sparkSession, model)

    def make():
        model = arrived(shared)

        def step(batch):
            scores = model.scores(batch.column("text"))
            return {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "score": scores,
                "predicted": (scores >= threshold).astype(np.int32),
            }

        return step

    rows = docs.select("doc_id", "text", held_out(modulus, rest))
    return map_slices(rows, make, "doc_id long, held_out boolean, score double, predicted int")
