"""Toxicity by two class-conditional Kneser-Ney models of the bytes in words.

Words, lower-cased A-Z and with a space on either side, are sequences of bytes; an n-gram is a
byte and up to five before it in the same word. A class's model takes its own counts of the full
n-grams, less a discount, and gives the rest to a backoff that both classes share: Kneser-Ney
continuation counts (in how many contexts a shorter n-gram occurs) of all labelled texts. An
expression seen in one class only thus differs by the weight of its own counts, one that neither
class has seen hardly at all.

Counts are taken by a distributed aggregate, over all labelled training rows but the few that the
regression below is fitted on. The log-likelihood
ratio of each n-gram, and of each context for unseen n-grams, stays in frames in the shared
folder, whole at any size and never gathered. The distinct words of all texts meet them once: a
chunk of words is reduced to its distinct n-grams, and these are joined by buckets of contexts, as
many as the n-grams on both sides need (``BUCKET``). A word's ratio is the sum of its n-grams'.

Documents then look up words. The ``FREQUENT`` most frequent ones at most are broadcast, a fixed
bound at any size; every other word of a document goes through a join by word, whose keys are rare
by choice, and back to its document. Words count as equal when their 64-bit hashes do.

A word's ratio is divided by its length. A document has the ratio over all its bytes, divided by
their number, and the means of its highest 1, 3 and 10 words (absent words count 0); a logistic
regression on these and the length, fitted on up to ``SAMPLE`` rows per class and no more than
about one row in ``APART``, turns them into the score. Only these rows are kept out of the counts.

Null and empty texts have all features 0 and get the score of that. Without labelled rows of both
classes every score is 0.5. Rows are scored one by one, so repeated rows agree.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from epochloom.llm.batches import (
    Texts,
    map_slices,
    mix,
    run_index,
    run_sums,
    texts_of,
    word_hashes,
    words_of,
)
from epochloom.llm.shared import discard, release, saved, shared_folder
from epochloom.llm.training import (
    bounded_sample,
    fit_logistic,
    held_out,
    known_labels,
    only_likely,
    remainder,
    sampled_texts,
    sigmoid,
)

ORDER = 6
DISCOUNT = 0.75
#: Rows per class on which the final regression is fitted.
SAMPLE = 3000
#: One in so many training rows may be among them.
APART = 5
#: Bytes of distinct words, as they stand in memory, that look up their n-grams together.
CHUNK = 1 << 21
#: Bytes of text that are cut into n-grams or words together, and n-grams built at a time.
TEXT_BYTES, SPAN = 1 << 19, 1 << 17
#: The most words whose ratios are broadcast (16 bytes each), and steps per doubling of their times.
FREQUENT, STEPS = 1 << 20, 8
#: Highest words of a document that are told apart.
TOP = 10
#: N-grams that a task looks up at a time, and the fewest buckets.
BUCKET, LEAST_BUCKETS = 1 << 19, 24
FEATURES = ("mean_ratio", "top_1", "top_3", "top_10", "log_words")


def byte_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram of each byte as an integer, last byte lowest; bytes per word; words per text."""
    return _grams(texts_of(column).lowered())


def _grams(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = words_of(texts)
    lengths = words.lengths + 1
    ends = np.cumsum(lengths)
    out, first = np.empty(int(lengths.sum()), np.uint64), 0
    while first < len(lengths):  # whole words; a span's arrays are many times its n-grams
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + SPAN, "right")))
        span = slice(first, last)
        out[done : ends[last - 1]] = _span_grams(texts.data, words.starts[span], words.lengths[span])
        first = last
    return out, lengths, words.counts


def _span_grams(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    lengths = sizes + 2
    at = run_index(lengths)
    inside = (at > 0) & (at < np.repeat(lengths, lengths) - 1)
    stream = np.full(len(at), 32, np.uint8)
    places = np.repeat(starts - 1, lengths) + at
    stream[inside] = data[places[inside]]
    grams = stream.astype(np.uint64)
    for k in range(1, ORDER):
        before = np.zeros(len(stream), np.uint64)
        before[k:] = stream[:-k]
        before[at < k] = 0
        grams |= before << np.uint64(8 * k)
    return grams[at > 0]


def class_counts(texts: DataFrame) -> DataFrame:
    """(gram, n0, n1) over all rows of (text, label)."""

    def make():
        def step(batch):
            grams, lengths, counts = byte_grams(batch.column("text"))
            label = batch.column("label").to_numpy()
            per_byte = np.repeat(np.repeat(label, counts), lengths)
            out = []
            for k in (0, 1):
                found, times = np.unique(grams[per_byte == k], return_counts=True)
                out.append((found, times * (k == 0), times * (k == 1)))
            gram, n0, n1 = (np.concatenate(x) for x in zip(*out, strict=True))
            return {"gram": gram.view(np.int64), "n0": n0, "n1": n1}

        return step

    rows = map_slices(texts.select("text", "label"), make, "gram long, n0 long, n1 long", size=TEXT_BYTES)
    return rows.groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _suffix(size: int):
    return F.col("gram").bitwiseAND(F.lit((1 << (8 * size)) - 1))


def _context():
    return F.call_function("shiftright", F.col("gram"), F.lit(8))


def shared_backoff(grams: DataFrame) -> DataFrame:
    """(gram, p) for n-grams one byte shorter than the given: the shared Kneser-Ney model."""
    levels, current = [], grams
    for size in range(ORDER - 1, 0, -1):
        current = saved(
            current.select(_suffix(size).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
        )
        levels.append(current)
    lower = levels.pop()
    # of at most 256 rows; the discount is left to all bytes alike
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept = F.col("n") - DISCOUNT + DISCOUNT * F.count("*").over(everything) / 256
    lower = lower.select("gram", (kept / F.sum("n").over(everything)).alias("p"))
    for size, level in zip(range(2, ORDER), reversed(levels), strict=True):
        contexts = level.groupBy(_context().alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds")
        )
        lower = (
            level.withColumn("context", _context())
            .withColumn("shorter", _suffix(size - 1))
            .join(contexts, "context")
            .join(lower.select(F.col("gram").alias("shorter"), F.col("p").alias("below")), "shorter")
            .select(
                "gram",
                (
                    (F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("below"))
                    / F.col("total")
                ).alias("p"),
            )
        )
    return lower


def ratios(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, value): the log ratio of label 1 to 0 of every seen n-gram; and (context, other):
    what an unseen n-gram gets in each context."""
    contexts = counts.groupBy(_context().alias("context")).agg(
        *[F.sum(f"n{k}").alias(f"total{k}") for k in (0, 1)],
        *[F.sum((F.col(f"n{k}") > 0).cast("long")).alias(f"kinds{k}") for k in (0, 1)],
    )
    contexts = saved(contexts)

    def left(k: int):
        """The share that a class leaves to the backoff in a context."""
        share = DISCOUNT * F.col(f"kinds{k}") / F.col(f"total{k}")
        return F.when(F.col(f"total{k}") > 0, share).otherwise(1.0)

    def own(k: int):
        some = F.greatest(F.col(f"n{k}") - DISCOUNT, F.lit(0.0)) / F.col(f"total{k}")
        return F.when(F.col(f"total{k}") > 0, some).otherwise(0.0) + left(k) * F.col("p")

    seen = (
        counts.withColumn("context", _context())
        .withColumn("shorter", _suffix(ORDER - 1))
        .join(contexts, "context")
        .join(shared_backoff(counts).withColumnRenamed("gram", "shorter"), "shorter")
        .select("gram", F.log(own(1) / own(0)).cast("float").alias("value"))
    )
    unseen = contexts.select("context", F.log(left(1) / left(0)).cast("float").alias("other"))
    return _in_parquet(seen), _in_parquet(unseen)


def _in_parquet(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def distinct_words(docs: DataFrame) -> DataFrame:
    """(word, times) over all rows of (text), lower-cased."""

    def make():
        def step(batch):
            texts = texts_of(batch.column("text")).lowered()
            words = words_of(texts)
            _, one, times = np.unique(
                word_hashes(texts.data, words), return_index=True, return_counts=True
            )
            lengths = words.lengths[one]
            data = texts.data[np.repeat(words.starts[one], lengths) + run_index(lengths)]
            ends = np.r_[0, np.cumsum(lengths)].astype(np.int64)
            found = pa.LargeStringArray.from_buffers(
                len(one), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))
            )
            return {"word": found, "times": times}

        return step

    rows = map_slices(docs.select("text"), make, "word string, times long", size=TEXT_BYTES)
    return rows.groupBy("word").agg(F.sum("times").alias("times"))


CHUNKS = "slice long, words binary, times binary, grams long"


def write_chunks(words: DataFrame, path: str) -> None:
    """The words of (word, times), ``CHUNK`` bytes of them to a row, each followed by a space; with
    the number of their distinct n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)

        def chunk(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            body = "".join(f"{w} " for w in table.column("word").to_pylist()).encode()
            distinct = len(np.unique(_word_grams(np.frombuffer(body, np.uint8))[0]))
            times = table.column("times").to_numpy().astype(np.int64)
            values = (next(number), zlib.compress(body, 1), zlib.compress(times.tobytes(), 1), distinct)
            names = ["slice", "words", "times", "grams"]
            return pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))])

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size >= CHUNK:
                yield chunk(waiting)
                waiting, size = [], 0
        if size:
            yield chunk(waiting)

    rows = words.mapInArrow(run, CHUNKS)
    rows.write.option("compression", "zstd").parquet(path)


def _unpacked(blob: pa.Scalar) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob.as_buffer()), np.uint8)


def _word_grams(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the words in one text, and their numbers per word."""
    grams, lengths, _ = _grams(Texts(body, np.array([0, len(body)])))
    return grams, lengths


def _by_bucket(contexts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by bucket, the buckets that occur, and where each starts and the last ends."""
    bucket = (mix(contexts) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    used, starts = np.unique(bucket[order], return_index=True)
    return order, used, np.r_[starts, len(order)]


_PACKED = "bucket long, kind int, slice long, grams binary, values binary"


def _packed(contexts, grams, values, buckets: int, kind: int, piece: int) -> pa.RecordBatch:
    """One row for each bucket with the n-grams, and their values if any."""
    order, used, edges = _by_bucket(contexts, buckets)
    parts = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
    grams = grams[order]
    values = None if values is None else values[order]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used, pa.int64()),
            pa.array(np.full(len(used), kind, np.int32)),
            pa.array(np.full(len(used), piece, np.int64)),
            pa.array([grams[a:b].tobytes() for a, b in parts], pa.binary()),
            pa.array([values is not None and values[a:b].tobytes() or b"" for a, b in parts], pa.binary()),
        ],
        names=["bucket", "kind", "slice", "grams", "values"],
    )


def _looked_up(group: pa.Table) -> pa.Table:
    """slice, bucket, values of a bucket's n-grams (kind 2), from the seen n-grams (kind 0) and
    the contexts (kind 1): an unseen n-gram has what its context gives, or else 0."""
    kind = group.column("kind").to_numpy()

    def joined(k: int, name: str, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(group.column(name).filter(kind == k).to_pylist()), dtype)

    def found(k: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = joined(k, "grams", np.uint64), joined(k, "values", np.float32)
        if not len(keys):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.float32)
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        return hit, np.where(hit, values[at], np.float32(0))

    wanted = joined(2, "grams", np.uint64)
    hit, values = found(0, wanted)
    values[~hit] = found(1, wanted[~hit] >> np.uint64(8))[1]
    rows = group.filter(kind == 2)
    sizes = np.array([len(x) for x in rows.column("grams").to_pylist()], np.int64) // 8
    ends = np.cumsum(sizes)
    blobs = [values[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
    return pa.table(
        [rows.column("slice"), rows.column("bucket"), pa.array(blobs, pa.binary())],
        names=["slice", "bucket", "values"],
    )


def bucket_values(
    words: DataFrame, tables: tuple[DataFrame, DataFrame], buckets: int
) -> DataFrame:
    """slice, bucket, values for (slice, words): the values of the slice's distinct n-grams in the
    bucket, ascending."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, body in zip(batch.column("slice"), batch.column("words"), strict=True):
                grams = np.unique(_word_grams(_unpacked(body))[0])
                yield _packed(grams >> np.uint64(8), grams, None, buckets, 2, piece.as_py())

    def table(kind: int, rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                grams = batch.column(0).to_numpy().view(np.uint64)
                contexts = grams if kind else grams >> np.uint64(8)
                yield _packed(contexts, grams, batch.column(1).to_numpy(), buckets, kind, 0)

        return rows.mapInArrow(run, _PACKED)

    rows = words.mapInArrow(keys, _PACKED)
    for kind, frame in enumerate(tables):
        rows = rows.union(table(kind, frame))
    return rows.groupBy("bucket").applyInArrow(_looked_up, "slice long, bucket long, values binary")


def word_ratios(words: DataFrame, tables: tuple[DataFrame, DataFrame], path: str) -> DataFrame:
    """(word, length, ratio, times) for (word, times), stored in the folder: the word by its hash,
    its n-grams, and the sum of their values."""
    spark = words.sparkSession
    write_chunks(words, f"{path}/chunks")
    # read twice: cogroup does not take two frames of one origin
    rows, again = (spark.read.schema(CHUNKS).parquet(f"{path}/chunks") for _ in range(2))
    total = rows.agg(F.coalesce(F.sum("grams"), F.lit(0))).first()[0]
    total += sum(table.count() for table in tables)
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        body = _unpacked(left.column("words")[0])
        grams, sizes = _word_grams(body)
        distinct, place = np.unique(grams, return_inverse=True)
        order, _, _ = _by_bucket(distinct >> np.uint64(8), buckets)
        values = np.zeros(len(order), np.float32)
        blobs = right.sort_by("bucket").column("values").to_pylist()
        values[order] = np.frombuffer(b"".join(blobs), np.float32)
        hashes = word_hashes(body, words_of(Texts(body, np.array([0, len(body)]))))
        return pa.table(
            [
                pa.array(hashes.view(np.int64)),
                pa.array(sizes),
                pa.array(run_sums(values[place].astype(np.float64), sizes)),
                pa.array(_unpacked(left.column("times")[0]).view(np.int64)),
            ],
            names=["word", "length", "ratio", "times"],
        )

    values = bucket_values(again.select("slice", "words"), tables, buckets)
    schema = "word long, length long, ratio double, times long"
    found = rows.drop("grams").groupBy("slice").cogroup(values.groupBy("slice"))
    found = found.applyInArrow(run, schema)
    found.write.option("compression", "zstd").parquet(f"{path}/words")
    discard(spark, f"{path}/chunks")
    return spark.read.schema(schema).parquet(f"{path}/words")


def frequent_from(words: DataFrame) -> int:
    """The least number of times such that at most ``FREQUENT`` words occur as often."""
    steps = F.floor(F.log2("times") * STEPS).cast("int")
    sizes = words.groupBy(steps.alias("step")).agg(F.count("*").alias("n"), F.min("times").alias("t"))
    cut, within = 1 << 62, 0
    for row in sizes.orderBy(F.desc("step")).collect():  # at most 64 * STEPS
        within += row["n"]
        if within > FREQUENT:
            break
        cut = row["t"]
    return cut


def document_parts(docs: DataFrame, frequent: pa.Table) -> DataFrame:
    """What the frequent words give each row of (doc_id, text, mark): the sum of their ratios and
    the ``TOP`` highest per byte; the bytes and words of the text; the other words, repeated."""
    spark = docs.sparkSession
    keys = frequent.column("word").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], frequent.column("ratio").to_numpy()[order]))

    def make():
        keys, ratios = shared.value
        number = itertools.count(TaskContext.get().partitionId() << 40)

        def step(batch):
            texts = texts_of(batch.column("text")).lowered()
            words = words_of(texts)
            kinds, which = np.unique(word_hashes(texts.data, words), return_inverse=True)
            at = np.searchsorted(keys, kinds)
            known = np.zeros(len(kinds), bool)
            known[at < len(keys)] = keys[at[at < len(keys)]] == kinds[at < len(keys)]
            ratio = np.zeros(len(kinds))
            ratio[known] = ratios[at[known]]
            ratio, other = ratio[which], ~known[which]
            lengths = words.lengths + 1
            value, doc = ratio / np.maximum(lengths, 1), words.doc
            return {
                "row": list(itertools.islice(number, len(texts))),
                "doc_id": batch.column("doc_id"),
                "mark": batch.column("mark"),
                "ratio": run_sums(ratio, words.counts),
                "bytes": run_sums(lengths, words.counts),
                "words": words.counts,
                "top": _highest(doc, value, len(texts)),
                "others": _lists(doc[other], kinds.view(np.int64)[which[other]], len(texts)),
            }

        return step

    return map_slices(docs.select("doc_id", "text", "mark"), make, PARTS, size=TEXT_BYTES)


PARTS = (
    "row long, doc_id long, mark int, ratio double, bytes long, words long, top array<double>, "
    "others array<long>"
)


def _lists(doc: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """One list per text; ``doc`` ascends."""
    ends = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _highest(doc: np.ndarray, value: np.ndarray, n: int) -> pa.Array:
    """The ``TOP`` highest of each text that are above 0, descending."""
    high = value > 0
    doc, value = doc[high], value[high]
    order = np.lexsort((-value, doc))
    doc, value = doc[order], value[order]
    kept = run_index(np.bincount(doc, minlength=n)) < TOP
    return _lists(doc[kept], value[kept], n)


def _merged_top(*lists):
    none = F.array().cast("array<double>")
    both = F.concat(*[F.coalesce(x, none) for x in lists])
    return F.slice(F.sort_array(both, asc=False), 1, TOP)


def features(docs: DataFrame, tables: tuple[DataFrame, DataFrame], path: str) -> DataFrame:
    """doc_id, mark and FEATURES for every row of (doc_id, text, mark); steps stay in the folder,
    which must not exist and is read by the result."""
    spark = docs.sparkSession
    words = word_ratios(distinct_words(docs), tables, path)
    cut = frequent_from(words)
    frequent = words.where(F.col("times") >= cut).select("word", "ratio").toArrow()
    release(spark)
    parts = document_parts(docs, frequent)
    parts.write.option("compression", "zstd").parquet(f"{path}/parts")
    parts = spark.read.schema(PARTS).parquet(f"{path}/parts")
    per_byte = F.col("ratio") / F.col("length")
    others = (
        parts.select("row", F.explode("others").alias("word"))
        .join(words.where(F.col("times") < cut).drop("times"), "word")
        .groupBy("row")
        .agg(
            F.sum("ratio").alias("more"),
            # of one document: as long as its text at most
            _merged_top(F.collect_list(F.when(F.col("ratio") > 0, per_byte))).alias("more_top"),
        )
    )
    rows = parts.drop("others").join(others, "row", "left")
    rows = rows.withColumn("top", _merged_top(F.col("top"), F.col("more_top")))

    def mean_of(k: int):
        total = F.aggregate(F.slice("top", 1, k), F.lit(0.0), lambda a, x: a + x)
        return (total / k).alias(f"top_{k}")

    ratio = F.col("ratio") + F.coalesce("more", F.lit(0.0))
    return rows.select(
        "doc_id",
        "mark",
        (ratio / F.greatest("bytes", F.lit(1))).alias("mean_ratio"),
        *[mean_of(k) for k in (1, 3, TOP)],
        F.log1p(F.col("words").cast("double")).alias("log_words"),
    )


class ToxicityModel:
    """Ratio frames and the regression on top; ``weights`` is None without labelled rows."""

    def __init__(self, tables=None, weights=None, center=None, scale=None):
        self.tables, self.weights, self.center, self.scale = tables, weights, center, scale

    def scores(self, docs: DataFrame) -> DataFrame:
        """doc_id, mark, score for every row of (doc_id, text, mark)."""
        if self.weights is None:
            return docs.select("doc_id", "mark", F.lit(0.5).alias("score"))
        weights, center, scale = self.weights, self.center, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.stack([batch.column(n).to_numpy() for n in FEATURES], axis=1)
                score = sigmoid((x - center) / scale @ weights[:-1] + weights[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("mark"), pa.array(score)],
                    names=["doc_id", "mark", "score"],
                )

        rows = features(docs, self.tables, shared_folder(docs.sparkSession))
        return rows.mapInArrow(run, "doc_id long, mark int, score double")


def train(docs: DataFrame, labels: DataFrame, modulus: int = 0, rest: int = 0) -> ToxicityModel:
    """A model of the labelled rows, without those whose crc32 remainder is ``rest``."""
    known = known_labels(labels, "toxic", modulus, rest)
    apart = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(APART)) == 0
    of_use = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    if modulus:  # before the join, which moves texts
        of_use = of_use.where(remainder(modulus) != rest)
    fitted = saved(bounded_sample(known.where(apart), SAMPLE))
    counted = known.join(F.broadcast(fitted.select("doc_id")), "doc_id", "left_anti")
    sample = saved(sampled_texts(docs, fitted))  # bounded; read twice
    tables = ratios(saved(class_counts(only_likely(of_use, counted).join(counted, "doc_id"))))
    release(docs.sparkSession)
    path = shared_folder(docs.sparkSession)
    found = features(sample.withColumnRenamed("label", "mark"), tables, path).toArrow()
    discard(docs.sparkSession, path)
    y = found.column("mark").to_numpy().astype(np.float64)
    if not (0 < y.sum() < len(y)):
        return ToxicityModel()
    x = np.stack([found.column(n).to_numpy() for n in FEATURES], axis=1)
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return ToxicityModel(tables, fit_logistic((x - center) / scale, y), center, scale)


def score(
    docs: DataFrame, model: ToxicityModel, threshold: float, modulus: int = 3, rest: int = 1
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    rows = docs.select("doc_id", "text", held_out(modulus, rest).cast("int").alias("mark"))
    return model.scores(rows).select(
        "doc_id",
        (F.col("mark") == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
