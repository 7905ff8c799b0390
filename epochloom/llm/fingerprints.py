"""Document fingerprints from prefix polynomial hashes.

For a text of code points c the prefix array holds ``sum (c_j + 1) * base**j`` for j < i, modulo a
prime, at each i; two primes below 2**31 are used. The difference of two entries, moved to exponent
0 by a power of the inverse base, is the hash of the span between them, wherever it stands. So any
two spans of equal length are compared in constant time, and the longest common extension of two
positions is found by binary search over its length.

A fingerprint is a string: the length, the hash of the whole text under both primes, and the
``LANES`` smallest of the mixed hashes of all spans of ``SPAN`` code points (shorter texts are one
span). Equal texts have equal fingerprints. The likeness of two fingerprints estimates the share
of spans in common, ``2 * common / (spans of both)``, from the smallest hashes of the union; it
is 1 for equal fingerprints, and 0 where just one text is empty.

The query pairs each document with the next in order of id. Ids are cut into ranges at quantiles;
the first documents of a range are also sent to the range before, so texts move once and neither a
window nor a join holds them. Null texts count as empty; null ids come first; rows with equal ids
are ordered by text. A single document is followed by itself; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epochloom.llm.batches import mix

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1812433253)
SPAN = 16
LANES = 64
_LOW = -(2**63)


class Powers:
    """Powers of the bases and of their inverses, grown on demand."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in PRIMES]
        self.down = [np.ones(1, np.uint64) for _ in PRIMES]

    def reach(self, n: int) -> None:
        if len(self.up[0]) > n:
            return
        size = 1 << (n + 1).bit_length()
        for k, (p, base) in enumerate(zip(PRIMES, BASES, strict=True)):
            for table, b in ((self.up, base), (self.down, pow(base, -1, p))):
                known = table[k]
                while len(known) < size:  # the table times the power that follows it
                    known = np.r_[known, known * np.uint64(pow(b, len(known), p)) % np.uint64(p)]
                table[k] = known


POWERS = Powers()


@dataclass
class Prefixes:
    """Prefix arrays of a text under both primes; entry i is for the first i code points."""

    arrays: tuple[np.ndarray, np.ndarray]

    @staticmethod
    def of(text: str) -> Prefixes:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        POWERS.reach(len(points))
        value = points.astype(np.uint64) + np.uint64(1)
        arrays = []
        for k, p in enumerate(PRIMES):
            terms = value * POWERS.up[k][: len(value)] % np.uint64(p)
            sums = np.zeros(len(value) + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            arrays.append(sums % np.uint64(p))
        return Prefixes(tuple(arrays))

    def __len__(self) -> int:
        return len(self.arrays[0]) - 1

    def spans(self, starts: np.ndarray, length: int, k: int) -> np.ndarray:
        """Hashes of the spans of a length at the given starts, under prime k."""
        p, a = np.uint64(PRIMES[k]), self.arrays[k]
        return (a[starts + length] + p - a[starts]) % p * POWERS.down[k][starts] % p

    def span(self, start: int, length: int) -> tuple[int, int]:
        at = np.array([start])
        return tuple(int(self.spans(at, length, k)[0]) for k in range(2))

    def spliced(self, keep: int, other: Prefixes, taken: int) -> Prefixes:
        """Prefix arrays of the first ``keep`` code points followed by ``taken`` of another text,
        without looking at either text."""
        POWERS.reach(keep + taken)
        out = []
        for k, p in enumerate(PRIMES):
            p, head = np.uint64(p), self.arrays[k][: keep + 1]
            tail = other.arrays[k][1 : taken + 1] * POWERS.up[k][keep] % p
            out.append(np.r_[head, (head[-1] + tail) % p])
        return Prefixes(tuple(out))


def equal_spans(x: Prefixes, i: int, y: Prefixes, j: int, length: int) -> bool:
    return x.span(i, length) == y.span(j, length)


def common_extension(x: Prefixes, i: int, y: Prefixes, j: int) -> int:
    """The largest length at which the spans from i in x and from j in y are equal."""
    low, high = 0, min(len(x) - i, len(y) - j)
    while low < high:
        middle = (low + high + 1) // 2
        if equal_spans(x, i, y, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def _lanes(values: np.ndarray) -> np.ndarray:
    """The smallest distinct values, ascending."""
    part = values
    if len(values) > 8 * LANES:
        part = values[values < np.uint64(2**32 * 4 * LANES // len(values))]
    found = np.unique(part)
    if len(found) < LANES and len(part) < len(values):
        found = np.unique(values)
    return found[:LANES]


def span_values(x: Prefixes, first: int = 0, last: int | None = None) -> np.ndarray:
    """32-bit values of the spans that start at ``first`` up to before ``last``."""
    n = len(x)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < SPAN:
        starts, length = np.zeros(1, np.int64), n
    else:
        starts, length = np.arange(first, n - SPAN + 1 if last is None else last), SPAN
    return mix(x.spans(starts, length, 0)) >> np.uint64(32)


def fingerprint(x: Prefixes, values: np.ndarray | None = None) -> str:
    whole = "".join(f"{h:08x}" for h in x.span(0, len(x)))
    lanes = _lanes(span_values(x) if values is None else values)
    return f"{len(x):x}-{whole}-{lanes.astype('>u4').tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    """0 to 1, from two fingerprints alone."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s.split("-")[2]), ">u4") for s in (a, b))
    union = np.union1d(x, y)[:LANES]
    if not len(x) or not len(y):
        return 0.0
    share = (np.isin(union, x) & np.isin(union, y)).mean()
    return float(2 * share / (1 + share))


def _edited(text: str, x: Prefixes, after: str, y: Prefixes) -> tuple[str, str]:
    """SHA-256 and fingerprint of a text whose last half is taken from the start of another."""
    n = len(x)
    taken = min(n // 2, len(y))
    keep = n - n // 2
    edited = x.spliced(keep, y, taken)
    digest = hashlib.sha256((text[:keep] + after[:taken]).encode()).hexdigest()
    # spans within either part are those of the texts; only those across the seam are new
    seam = span_values(edited, max(keep - SPAN + 1, 0), max(min(keep, keep + taken - SPAN + 1), 0))
    if keep < SPAN or taken < SPAN:
        return digest, fingerprint(edited)
    parts = span_values(x, 0, keep - SPAN + 1), span_values(y, 0, taken - SPAN + 1), seam
    return digest, fingerprint(edited, np.concatenate(parts))


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, next_prefix long"
)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, ahead, doc_id, text) in order to results; the last row waits for the next."""
    before = None
    for batch in batches:
        out: list[tuple] = []
        columns = (batch.column(c) for c in ("bucket", "ahead", "doc_id", "text"))
        for bucket, ahead, doc_id, text in zip(*columns, strict=True):
            bucket, ahead, text = bucket.as_py(), ahead.as_py(), text.as_py()
            x = Prefixes.of(text)
            here = (bucket, ahead, doc_id.as_py(), text, x, fingerprint(x))
            if before is not None and before[0] == bucket and not before[1]:
                out.append(_row(before, here))
            before = here
        if out:
            names = [part.split()[0] for part in RESULT.split(", ")]
            columns = [list(c) for c in zip(*out, strict=True)]
            kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
            types = [kinds[part.split()[1]] for part in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )


def _row(here: tuple, after: tuple) -> tuple:
    _, _, doc_id, text, x, mark = here
    digest, edited = _edited(text, x, after[3], after[4])
    return (
        doc_id,
        len(x),
        digest,
        mark,
        edited,
        likeness(mark, edited),
        likeness(mark, after[5]),
        common_extension(x, 0, after[4], 0),
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per row of (doc_id, text): its fingerprint, that of its edited text, their likeness
    to it and to the next document's, and how many code points it shares with the start of the
    next."""
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.where(F.col("doc_id").isNotNull()).approxQuantile(
        "doc_id", [i / count for i in range(1, count)], 0.1 / count
    )
    cuts = np.array(sorted({int(c) for c in cuts}), np.int64)

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), "right").astype(np.int32))

    key = F.coalesce(F.col("doc_id"), F.lit(_LOW))
    placed = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key")
    ).withColumn("bucket", bucket_of("key"))
    # a row per range
    firsts = sorted(
        placed.select("bucket", "key").groupBy("bucket").agg(F.min("key")).toLocalIterator()
    )
    lookahead = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    entries = [F.lit(x) for pair in lookahead.items() for x in pair]
    copies = F.create_map(*entries)[F.col("key")] if entries else F.lit(None).cast("int")
    places = F.array_compact(
        F.array(
            F.struct("bucket", F.lit(False).alias("ahead")),
            F.when(copies.isNotNull(), F.struct(copies.alias("bucket"), F.lit(True).alias("ahead"))),
        )
    )
    rows = placed.select("doc_id", "key", "text", F.inline(places))
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "ahead", "key", "text")
    return ordered.select("bucket", "ahead", "doc_id", "text").mapInArrow(_in_order, RESULT)
