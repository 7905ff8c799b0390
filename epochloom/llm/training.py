"""Labelled rows for the classifiers, and logistic regression on small feature tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; null ids have none."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def held_out(modulus: int, rest: int) -> Column:
    return F.coalesce(remainder(modulus) == rest, F.lit(False)).alias("held_out")


def known_labels(labels: DataFrame, column: str, modulus: int = 0, rest: int = 0) -> DataFrame:
    """(doc_id, label) once per id, without held-out ids; of differing labels the larger counts."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    if modulus:
        rows = rows.where(remainder(modulus) != rest)
    return rows.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))


FILTER_BITS = 1 << 24


def only_likely(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose id is in ``known``, and few others: by a bit set of fixed size with a bit on for
    each known id. A join has to follow; this spares it most texts that have no partner."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    place = F.call_function("shiftleft", F.lit(1).cast("long"), bit % 32)
    blocks = known.groupBy((bit / 32).cast("int").alias("block")).agg(
        F.bit_or(place).alias("bits")
    )
    on = np.zeros(FILTER_BITS // 32, np.uint32)
    found = blocks.toArrow()  # in one job; FILTER_BITS / 32 rows at most
    on[found.column("block").to_numpy()] = found.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(on)

    @F.pandas_udf("boolean")
    def is_on(bits: pd.Series) -> pd.Series:
        at = bits.to_numpy()
        return pd.Series((shared.value[at // 32] >> (at % 32).astype(np.uint32)) & 1 == 1)

    return docs.where(is_on(bit))


def bounded_sample(known: DataFrame, rows_per_label: int) -> DataFrame:
    """Up to so many rows of label 0 and of 1, those with the smallest hash of the id."""
    order = F.xxhash64("doc_id")
    parts = [
        known.where(F.col("label") == k).orderBy(order, "doc_id").limit(rows_per_label)
        for k in (0, 1)
    ]
    return parts[0].union(parts[1])


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, label, text) of a bounded sample, which is broadcast for that reason."""
    return one_per_id(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "label")


def one_per_id(rows: DataFrame, label: str) -> DataFrame:
    """(doc_id, label, text) once per id and label, however often rows repeat an id: the text of the
    smallest hash."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return rows.groupBy("doc_id", label).agg(least).select("doc_id", label, "least.text")


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, np.float64)))


def logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights and, last, the intercept, by Newton steps; each label weighs one half."""
    x = np.c_[x, np.ones(len(x))]
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge / 100)
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return w
