"""Quality rules: counts over the whole text, and a hashed n-gram logistic regression.

Counts per text, with words as runs of characters other than space and 09-0D:
``n_words``; ``word_chars``, code points in words; ``n_symbols``, characters of ``#*$%&|<>``;
``n_dup_lines``, lines (cut at line feeds) that hold a word and equal an earlier line;
``n_repeat_words``, words inside a window of three that occurs twice or more in the text, first
occurrence included. ``base_failed``: fewer than 50 words, or more than half of them repeated.

The regression sees each text as shares of hashed features: words, pairs of neighbouring words
(pairs of one word twice are one feature), and 2- and 4-byte character n-grams. It is trained on
up to ``SAMPLE`` labelled rows per class, a bounded sample; one in ``APART`` of these fits the
two numbers of a Platt calibration instead. ``kept`` is false where the base rules fail, else
whether the calibrated probability reaches a fixed threshold.

Null and empty texts have no words and fail. Without labelled rows of both classes the probability
is 1. Rows are judged one by one, so repeated rows agree; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from epochloom.llm.batches import (
    Texts,
    Words,
    IS_SPACE,
    map_slices,
    mix,
    run_index,
    run_sums,
    texts_of,
    word_hashes,
    words_of,
)
from epochloom.llm.shared import arrived, shipped
from epochloom.llm.training import bounded_sample, fit_logistic, known_labels, sampled_texts, sigmoid

MIN_WORDS = 50
#: Features that the fit handles at a time.
BLOCK = 1 << 19
MAX_REPEATED_PERCENT = 50
KEEP_AT = 0.5
SAMPLE = 2000
APART = 5
#: Features per kind: words, word pairs, 2-byte and 4-byte n-grams.
TABLE = 1 << 16
KINDS = 4
#: Fixed values.
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _bytes_per_text(flags: np.ndarray, texts: Texts) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags)]
    return total[texts.offsets[1:]] - total[texts.offsets[:-1]]


def _repeats(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows (text, value): whether an equal row exists, and whether one exists before."""
    order = np.lexsort((value, doc))
    same = np.zeros(len(doc), bool)
    same[1:] = (doc[order][1:] == doc[order][:-1]) & (value[order][1:] == value[order][:-1])
    some, later = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
    some[order] = same | np.r_[same[1:], False][: len(same)]
    later[order] = same
    return some, later


def lines_of(texts: Texts) -> Words:
    """Lines as runs of bytes; the feed belongs to none."""
    feed = np.flatnonzero(texts.data == 10)
    starts = np.sort(np.r_[texts.offsets[:-1], feed + 1])
    ends = np.sort(np.r_[texts.offsets[1:], feed])
    counts = np.searchsorted(feed, texts.offsets[1:]) - np.searchsorted(feed, texts.offsets[:-1])
    return Words(starts, ends - starts, counts + 1)


def base_counts(texts: Texts, words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    word_byte = ~IS_SPACE[texts.data]
    first_byte = (texts.data & 0xC0) != 0x80
    lines = lines_of(texts)
    before = np.r_[0, np.cumsum(word_byte)]
    full = before[lines.starts + lines.lengths] > before[lines.starts]
    line_doc = lines.doc[full]
    kept = Words(lines.starts[full], lines.lengths[full], lines.counts)
    _, again = _repeats(line_doc, word_hashes(texts.data, kept))
    doc = words.doc
    at = run_index(words.counts)
    window = np.flatnonzero(at < np.repeat(words.counts, words.counts) - 2)
    value = mix(mix(mix(hashes[window]) + hashes[window + 1]) + hashes[window + 2])
    some, _ = _repeats(doc[window], value)
    inside = np.zeros(len(doc), bool)
    for k in range(3):
        inside[window[some] + k] = True
    n = len(texts)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": _bytes_per_text(word_byte & first_byte, texts),
        "n_symbols": _bytes_per_text(IS_SYMBOL[texts.data], texts),
        "n_dup_lines": np.bincount(line_doc[again], minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(doc[inside], minlength=n).astype(np.int64),
    }


def hashed_features(
    texts: Texts, words: Words, hashes: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind: the feature of each occurrence, in text order, and occurrences per text."""
    shift = np.uint64(64 - (TABLE.bit_length() - 1))
    last = run_index(words.counts) == np.repeat(words.counts, words.counts) - 1
    at = np.flatnonzero(~last)
    pair = mix(hashes[at] * np.uint64(5) + hashes[at + 1])
    pair[hashes[at] == hashes[at + 1]] = 0
    data = texts.data.astype(np.uint32)
    sizes = np.diff(texts.offsets)
    left = np.repeat(texts.offsets[1:], sizes) - np.arange(len(data))
    two = np.flatnonzero(left >= 2)
    four = np.flatnonzero(left >= 4)
    gram = data[four] | data[four + 1] << 8 | data[four + 2] << 16 | data[four + 3] << 24
    return [
        ((hashes >> shift).astype(np.int64), words.counts),
        ((pair >> shift).astype(np.int64), np.maximum(words.counts - 1, 0)),
        ((data[two] | data[two + 1] << 8).astype(np.int64), np.maximum(sizes - 1, 0)),
        ((gram * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64), np.maximum(sizes - 3, 0)),
    ]


class QualityModel:
    """Weights by kind and feature, an intercept, and the calibration (slope, offset)."""

    def __init__(self, weights: np.ndarray | None = None, intercept=0.0, calibration=(1.0, 0.0)):
        self.weights, self.intercept, self.calibration = weights, intercept, calibration

    def margins(self, kinds) -> np.ndarray:
        total = self.intercept
        for weight, (feature, counts) in zip(self.weights, kinds, strict=True):
            each = run_sums(weight[feature].astype(np.float64), counts)
            total = total + each / np.maximum(counts, 1)
        return total

    def probabilities(self, kinds, n: int) -> np.ndarray:
        if self.weights is None:
            return np.ones(n)
        slope, offset = self.calibration
        return sigmoid(slope * self.margins(kinds) + offset)


def _flat(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The binary values of a column end to end."""
    parts = [np.zeros(0, kind)]
    for chunk in column.chunks:
        chunk = chunk.cast(pa.large_binary())
        _, ends, data = chunk.buffers()
        if len(chunk) and data is not None:
            at = np.frombuffer(ends, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind))
    return np.concatenate(parts)


@dataclass
class Shares:
    """Features of many texts end to end, with their shares, and where each text's begin."""

    feature: np.ndarray
    share: np.ndarray
    ends: np.ndarray

    @staticmethod
    def of(features: pa.ChunkedArray, shares: pa.ChunkedArray) -> Shares:
        """From columns of binary values, with one copy."""
        sizes = pc.binary_length(features).to_numpy().astype(np.int64) // 4
        return Shares(_flat(features, np.int32), _flat(shares, np.float32), np.cumsum(sizes))

    def blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Texts with about ``BLOCK`` features in all: which, and for each feature the text's place
        among these, the feature and the share."""
        first = 0
        while first < len(self.ends):
            start = int(self.ends[first - 1]) if first else 0
            last = max(int(np.searchsorted(self.ends, start + BLOCK, "right")), first + 1)
            ends = self.ends[first:last]
            of = np.repeat(np.arange(last - first), np.diff(ends, prepend=start))
            here = slice(start, int(ends[-1]))
            yield slice(first, last), of, self.feature[here], self.share[here]
            first = last

    def margins(self, w: np.ndarray) -> np.ndarray:
        out = [np.bincount(of, w[f] * v, x.stop - x.start) for x, of, f, v in self.blocks()]
        return np.concatenate([np.zeros(0), *out])


def _fit(shares: Shares, y: np.ndarray, own: np.ndarray, steps: int = 80):
    """Weights of a sparse logistic regression by Adam over the rows in ``own``, in blocks."""
    n = TABLE * KINDS
    w, b = np.zeros(n), 0.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    good, bad = own & (y == 1), own & (y == 0)
    weight = np.where(good, 0.5 / good.sum(), np.where(bad, 0.5 / bad.sum(), 0.0))
    for t in range(1, steps + 1):
        slope = np.r_[1e-7 * w, 0.0]
        for rows, of, feature, share in shares.blocks():
            margin = np.bincount(of, w[feature] * share, rows.stop - rows.start) + b
            error = weight[rows] * (sigmoid(margin) - y[rows])
            slope[:-1] += np.bincount(feature, error[of] * share, n)
            slope[-1] += error.sum()
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope**2
        step = 0.5 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        w, b = w - step[:-1], b - step[-1]
    return w.reshape(KINDS, TABLE), b


def train(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """A model from a bounded sample of the labelled rows."""
    sample = sampled_texts(docs, bounded_sample(known_labels(labels, "quality"), SAMPLE))
    apart = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(APART)) == 0

    def make():
        def step(batch):
            texts = texts_of(batch.column("text"))
            words = words_of(texts)
            kinds = hashed_features(texts, words, word_hashes(texts.data, words))
            n = len(texts)
            out: list[list] = [[] for _ in range(n)]
            for k, (feature, counts) in enumerate(kinds):
                ends = np.cumsum(counts)
                for i in range(n):
                    found, times = np.unique(
                        feature[ends[i] - counts[i] : ends[i]], return_counts=True
                    )
                    out[i].append((found + k * TABLE, times / max(counts[i], 1)))
            packed = [tuple(np.concatenate(x) for x in zip(*o, strict=True)) for o in out]
            return {
                "label": batch.column("label"),
                "apart": batch.column("apart"),
                "doc_id": batch.column("doc_id"),
                "feature": [f.astype(np.int32).tobytes() for f, _ in packed],
                "share": [v.astype(np.float32).tobytes() for _, v in packed],
            }

        return step

    schema = "label int, apart boolean, doc_id long, feature binary, share binary"
    rows = map_slices(sample.withColumn("apart", apart), make, schema)
    rows = rows.orderBy("doc_id").toArrow()
    shares = Shares.of(rows.column("feature"), rows.column("share"))
    rows = rows.select(["label", "apart"]).to_pydict()
    y, own = np.array(rows["label"], np.float64), ~np.array(rows["apart"], bool)
    if not (0 < y[own].sum() < own.sum()):
        return QualityModel()
    w, b = _fit(shares, y, own)
    margin = shares.margins(w.reshape(-1)) + b
    fit = ~own if 0 < y[~own].sum() < (~own).sum() else own
    slope, offset = fit_logistic(margin[fit][:, None], y[fit])
    return QualityModel(w.astype(np.float32), float(b), (float(max(slope, 1e-3)), float(offset)))


def apply_rules(docs: DataFrame, model: QualityModel, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the counts, base_failed, probability and kept for every row, and the named columns
    of ``docs``."""
    shared = shipped(docs.sparkSession, model)
    fields = [docs.schema[c] for c in carried]

    def make():
        model = arrived(shared)

        def step(batch):
            texts = texts_of(batch.column("text"))
            words = words_of(texts)
            hashes = word_hashes(texts.data, words)
            out = base_counts(texts, words, hashes)
            n, repeated = out["n_words"], out["n_repeat_words"]
            failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)
            p = model.probabilities(hashed_features(texts, words, hashes), len(n))
            out |= {"base_failed": failed, "probability": p, "kept": ~failed & (p >= KEEP_AT)}
            return out | {x: batch.column(x) for x in ("doc_id", *carried)}

        return step

    schema = (
        ["doc_id long", *[f"{c} long" for c in COUNTS]]
        + ["base_failed boolean", "probability double", "kept boolean"]
        + [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    )
    rows = docs.select(*dict.fromkeys(("doc_id", "text", *carried)))
    return map_slices(rows, make, ", ".join(schema))
