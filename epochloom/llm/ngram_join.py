"""N-gram Jaccard join by PartEnum signatures: which texts share most of their word shingles.

A document's set holds 64-bit values of its distinct shingles of ``words`` words, lower-cased
A-Z; with fewer words the whole sequence is the one shingle, without words the set is empty.
Two documents link when ``100 * intersection >= percent * union``.

Sets of equal content are one class, known by a 64-bit key of the set. Class sizes fall into
bands so that a linked pair lies in one band or in two neighbours. For each band there is one
instance with a bound k on the symmetric difference of linked sets. The shingle domain is split
by value into ``k // 2 + 1`` parts, so one part differs in at most one shingle; each part is
split into three again, and the enumerated signatures are the contents of two of the three. A
linked pair therefore shares a signature, whatever the data.

Where links may differ much (below ``THIRDS_FROM`` percent) there are so many parts that signatures
come out empty by chance, and all sets with the same empty one would meet. There parts are split
in two, and e further parts are added: then a linked pair has 1 + e parts that differ in at most
one shingle. A set of which at most e parts have an empty signature leaves these signatures out;
a part remains in which the pair shares one that is not empty. All other sets keep all of theirs.

Classes that share a signature form a bucket. First each member is compared with the bucket's
smallest member only (exact set sizes of the texts, no estimate); this joins groups of copies
without naming their pairs. Members of one bucket still in different components are then compared
with each other, less those that the triangle inequality of the Jaccard distance rules out.

Empty texts and null ids: a document without words links with nothing and is its own component;
rows with the same id are the same document for links of either text. An empty table gives an
empty result. Values are equal when their 64-bit values are; nothing else is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epochloom.llm.batches import map_slices, mix, run_sums, texts_of, word_hashes, words_of
from epochloom.llm.components import components
from epochloom.llm.shared import saved

#: Bits of a signature that are kept: buckets only propose pairs, so two that fall together cost
#: comparisons and no more, while every byte is shuffled several hundred times per text.
SIGNATURE_BITS = 48
_SEED = np.uint64(0xD6E8FEB86659FD93)
#: From this percentage on, parts are split in three and none is spare.
THIRDS_FROM = 85


@dataclass(frozen=True)
class Band:
    """Sizes low..high, and the largest symmetric difference of a linked pair whose smaller set
    lies in it."""

    low: int
    high: int
    bound: int


def bands(percent: int, largest: int) -> list[Band]:
    """Bands up to one past the given size."""
    out, low = [], 1
    while True:
        high = low * 100 // percent
        total = high + high * 100 // percent
        out.append(Band(low, high, total * (100 - percent) // (100 + percent)))
        if low > largest:
            return out
        low = high + 1


def layout(band: Band, percent: int) -> tuple[int, int, int]:
    """Parts of a band's instance, what each is split into, and how many of the parts are spare."""
    least = band.bound // 2 + 1
    if percent >= THIRDS_FROM:
        return least, 3, 0
    spare, most = 0, least // 3 if band.bound else 0
    while spare < most:
        parts = least + spare
        empty = 2 * parts * np.exp(-band.low / (2 * parts))  # parts with an empty signature
        if empty + 2 * np.sqrt(empty) <= spare:
            break
        spare += 1
    return least + spare, 2, spare


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle values of all texts end to end, ascending within each, and their counts."""
    texts = texts_of(column).lowered()
    found = words_of(texts)
    each = word_hashes(texts.data, found)
    n, counts = len(each), found.counts
    starts = np.cumsum(counts) - counts
    values = np.full(n, _SEED)
    left = np.repeat(starts + counts, counts) - np.arange(n)
    for k in range(words):
        here = left > k
        values[here] = mix(values[here] * np.uint64(3) + each[np.flatnonzero(here) + k])
    short = np.repeat(counts < words, counts)
    keep = (left >= words) | (short & (left == np.repeat(counts, counts)))
    doc, values = found.doc[keep], values[keep]
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    if len(values):
        new = np.r_[True, (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])]
        doc, values = doc[new], values[new]
    return values, np.bincount(doc, minlength=len(counts)).astype(np.int64)


def set_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One value per set, the same for sets of equal content."""
    return mix(run_sums(mix(values ^ _SEED), sizes) + sizes.astype(np.uint64))


def signatures(
    values: np.ndarray, sizes: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, set index, 1 for the upper band of the instance) of all sets."""
    if not len(values):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int8)
    table = bands(percent, int(sizes.max()))
    band_of = np.searchsorted([b.low for b in table], sizes, "right") - 1
    bound = np.array([b.bound for b in table])
    laid_out = [layout(b, percent) for b in table]
    parts_of, split, spare_of = (np.array(x) for x in zip(*laid_out, strict=True))
    split = int(split.min())
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = []
    for side in (0, 1):
        instance = band_of - side
        used = (instance >= 0) & (sizes > 0)
        parts = np.where(used, parts_of[np.maximum(instance, 0)], 0)
        single = used & (bound[np.maximum(instance, 0)] == 0)
        rows = used[owner]
        value, of = values[rows], owner[rows]
        slot = mix(value + _SEED)
        part = (slot >> np.uint64(32)) % parts[of].astype(np.uint64)
        third = (slot & np.uint64(0xFFFFFFFF)) % np.uint64(split)
        first = np.cumsum(parts) - parts
        cell = (first[of] + part.astype(np.int64)) * split + third.astype(np.int64)
        total = int(parts.sum())
        order = np.argsort(cell, kind="stable")
        held = np.bincount(cell, minlength=total * split)
        sums = run_sums(mix(value ^ _SEED)[order], held)
        sums, held = sums.reshape(total, split), held.reshape(total, split)
        of_part = np.repeat(np.arange(len(sizes)), parts)
        place = mix(
            (np.repeat(instance, parts) << 32).astype(np.uint64)
            + (np.arange(total) - first[of_part]).astype(np.uint64)
        )
        empty = (held.sum(axis=1)[:, None] == held) & ~single[of_part][:, None]
        lacking = np.bincount(of_part, empty.any(axis=1), len(sizes))
        left_out = used & (lacking <= np.where(used, spare_of[np.maximum(instance, 0)], -1))
        for omitted in range(split):
            content = sums.sum(axis=1) - np.where(single[of_part], 0, sums[:, omitted])
            rows = ~single[of_part] if omitted else np.ones(total, bool)
            rows = rows & ~(empty[:, omitted] & left_out[of_part])
            values_ = mix(mix(content) + place + np.uint64(omitted + 1))
            out.append((values_[rows], of_part[rows], np.full(total, side, np.int8)[rows]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def sketch_bits(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Bits of a set's sketch: a power of two, several times the difference that linked sets may
    have."""
    bound = np.maximum(2 * sizes * (100 - percent) // percent, 1)
    return np.maximum(256, 2 ** np.ceil(np.log2(bound * 8)).astype(np.int64))


def sketches(values: np.ndarray, sizes: np.ndarray, percent: int) -> list[bytes]:
    """Parities of the values per bit. Where two sketches differ in n bits, the sets differ in n
    values at least, so a sketch can refute a link but never lose one."""
    bits = sketch_bits(sizes, percent)
    first = np.cumsum(bits) - bits
    at = (mix(values + np.uint64(7)) % np.repeat(bits, sizes).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(np.repeat(first, sizes) + at, minlength=int(bits.sum())) & 1
    packed = np.packbits(odd.astype(np.uint8))
    return [packed[a // 8 : (a + n) // 8].tobytes() for a, n in zip(first, bits, strict=True)]


def document_sets(
    docs: DataFrame, words: int, percent: int, carried: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_shingles, the key of the set (null for an empty one), its sketch, and the named
    columns of longs."""

    def make():
        def step(batch):
            values, sizes = shingle_sets(batch.column("text"), words)
            return {
                "doc_id": batch.column("doc_id"),
                "n_shingles": sizes,
                "set_key": pa.array(set_keys(values, sizes).view(np.int64), mask=sizes == 0),
                "sketch": sketches(values, sizes, percent),
            } | {c: batch.column(c) for c in carried}

        return step

    schema = "doc_id long, n_shingles long, set_key long, sketch binary"
    schema += "".join(f", {c} long" for c in carried)
    return map_slices(docs.select("doc_id", "text", *carried), make, schema)


def signature_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """signature, upper, set_key: one row per signature of each class met in a slice."""

    def make():
        def step(batch):
            values, sizes = shingle_sets(batch.column("text"), words)
            keys = set_keys(values, sizes)
            _, first = np.unique(keys, return_index=True)
            chosen = np.zeros(len(sizes), bool)
            chosen[first] = True
            values, sizes = values[np.repeat(chosen, sizes)], np.where(chosen, sizes, 0)
            signature, owner, upper = signatures(values, sizes, percent)
            return {
                "signature": (signature >> np.uint64(64 - SIGNATURE_BITS)).view(np.int64),
                "upper": upper,
                "set_key": keys[owner].view(np.int64),
            }

        return step

    return map_slices(docs.select("text"), make, "signature long, upper byte, set_key long")


def bucket_rows(rows: DataFrame) -> DataFrame:
    """signature, center, member, upper: the members of buckets with several classes.

    The center is a bucket's first class; buckets of upper classes only are left to the instance
    in which these are the lower ones. Rows of a signature are read in order, and only the first
    is remembered, so a bucket of any size takes no memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = head = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy() for k in range(3)]
            if last is not None:
                columns = [np.r_[np.array([x], c.dtype), c] for x, c in zip(last, columns)]
            signature, upper, key = columns
            starts = np.r_[True, signature[1:] != signature[:-1]]
            new = np.r_[last is None, starts[1:] | (upper[1:] != upper[:-1]) | (key[1:] != key[:-1])]
            run_of = np.cumsum(starts) - 1
            heads, tops = key[starts], upper[starts]
            if last is not None:
                heads[0], tops[0] = head
            emit = new & ~starts & (tops[run_of] == 0) & (key != heads[run_of])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(x[emit])
                    for x in (signature, heads[run_of], key, upper.astype(np.int8))
                ],
                names=["signature", "center", "member", "upper"],
            )
            last = (signature[-1], upper[-1], key[-1])
            head = (heads[-1], tops[-1])

    ordered = rows.repartition("signature").sortWithinPartitions("signature", "upper", "set_key")
    return ordered.mapInArrow(run, "signature long, center long, member long, upper byte")


def _allowed(total: np.ndarray, percent: int) -> np.ndarray:
    """The largest symmetric difference of two linked sets with so many values together."""
    return total * (100 - percent) // (100 + percent)


def _differing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int64)


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch of fewer bits: positions are taken modulo, so halves add up."""
    whole = np.frombuffer(sketch, np.uint8).reshape(-1, size)
    return np.bitwise_xor.reduce(whole, axis=0)


def plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sizes and sketches don't refute a link."""
    from pyspark.sql.types import BooleanType

    @F.pandas_udf(BooleanType())
    def may_link(a, b, x, y):
        import pandas as pd

        out = np.zeros(len(a), bool)
        for i, (m, n, left, right) in enumerate(zip(a, b, x, y, strict=True)):
            size = min(len(left), len(right))
            out[i] = _differing(_folded(left, size), _folded(right, size)) <= _allowed(
                np.int64(m + n), percent
            )
        return pd.Series(out)

    def side(name):
        return classes.select(
            F.col("set_key").alias(name),
            F.col("n_shingles").alias(f"n_{name}"),
            F.col("sketch").alias(f"sketch_{name}"),
        )

    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    alike = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sized.where(alike).where(may_link("n_a", "n_b", "sketch_a", "sketch_b")).select("a", "b")


FILTER_BITS = 1 << 24


def _filter(keys: DataFrame) -> np.ndarray:
    """A bit set of fixed size with a bit on for each key."""
    bit = F.pmod(F.xxhash64("set_key"), F.lit(FILTER_BITS))
    blocks = keys.groupBy((bit / 32).cast("int").alias("block")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int"))).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    found = blocks.toArrow()  # in one job; FILTER_BITS / 32 rows at most
    out[found.column("block").to_numpy()] = found.column("bits").to_numpy()
    return out


def linked(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int
) -> DataFrame:
    """The pairs (a, b) whose sets link, by the size of the intersection.

    Sets are built anew for the documents that stand for the classes; a bit set of fixed size
    keeps most others out, a join the rest.
    """
    wanted = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct()
    chosen = saved(wanted.join(classes, "set_key").select("set_key", "doc_id"))
    on = docs.sparkSession.sparkContext.broadcast(
        _filter(chosen.select(F.col("doc_id").alias("set_key")))
    )
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))

    def make():
        bits = on.value

        def step(batch):
            at = batch.column("bit").to_numpy()
            hit = (bits[at // 32] >> (at % 32).astype(np.uint32)) & 1 == 1
            if not hit.any():
                return None
            batch = batch.filter(pa.array(hit))
            values, sizes = shingle_sets(batch.column("text"), words)
            ends = np.cumsum(sizes)
            return {
                "set_key": set_keys(values, sizes).view(np.int64),
                "doc_id": batch.column("doc_id"),
                "shingles": [values[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)],
            }

        return step

    schema = "set_key long, doc_id long, shingles binary"
    sets = map_slices(
        docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", bit.alias("bit")),
        make,
        schema,
    )
    sets = sets.join(chosen, ["set_key", "doc_id"], "left_semi").drop("doc_id")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            columns = batch.column("left_set"), batch.column("right_set")
            for i, (x, y) in enumerate(zip(*columns, strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    joined = (
        pairs.join(sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("left_set")), "a")
        .join(sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("right_set")), "b")
        .select("a", "b", "left_set", "right_set")
    )
    return joined.mapInArrow(test, "a long, b long").distinct()


BLOCK = 256


def open_pairs(
    buckets: DataFrame, roots: DataFrame, classes: DataFrame, percent: int, closest: bool
) -> DataFrame:
    """Pairs (a, b) of one bucket and different components that sketches don't refute.

    A bucket is cut into blocks of about ``BLOCK`` members by a hash, and each task compares two
    blocks, so a large one is spread out. ``closest`` keeps one pair for each two components of a
    task, those with the most similar sketches.
    """
    centers = buckets.select(
        "signature", F.col("center").alias("set_key"), F.lit(0).cast("byte").alias("upper")
    ).distinct()
    members = centers.union(buckets.select("signature", "member", "upper"))
    placed = members.join(roots, F.col("set_key") == F.col("node"), "left").select(
        "signature", "set_key", "upper", F.coalesce("root", "set_key").alias("root")
    )
    unsettled = (
        placed.groupBy("signature")
        .agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where("n > 2 and low < high")
        .select("signature", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    rows = (
        placed.join(unsettled, "signature")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "signature",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "set_key",
            "upper",
            "root",
        )
        .join(classes.select("set_key", "n_shingles", "sketch"), "set_key")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            edges = _group_edges(held)
            yield _closest_pairs(held, edges[:-1], percent, closest)
            held = held.slice(edges[-2])
        if held is not None:
            yield _closest_pairs(held, _group_edges(held), percent, closest)

    keys = ["signature", "low", "high"]
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _group_edges(batch: pa.RecordBatch) -> np.ndarray:
    """Where groups of rows with equal signature, low and high start, and the end."""
    new = np.zeros(max(batch.num_rows - 1, 0), bool)
    for name in ("signature", "low", "high"):
        column = batch.column(name).to_numpy()
        new |= column[1:] != column[:-1]
    return np.r_[0, np.flatnonzero(new) + 1, batch.num_rows]


def _closest_pairs(
    batch: pa.RecordBatch, edges: np.ndarray, percent: int, closest: bool
) -> pa.RecordBatch:
    """Pairs (a, b) of each group's rows that may link; groups hold two blocks at most."""
    column = {
        n: batch.column(n).to_numpy()
        for n in ("low", "high", "block", "set_key", "upper", "root", "n_shingles")
    }
    sketch = batch.column("sketch")
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        part = {n: c[start:end] for n, c in column.items()}
        root, n, key = part["root"], part["n_shingles"], part["set_key"]
        if end - start < 2 or (root == root[0]).all():
            continue
        raw = [x.as_buffer() for x in sketch.slice(start, end - start)]
        size = min(x.size for x in raw)
        bits = np.stack([_folded(x, size) for x in raw]).view(np.uint64)
        within = part["low"][0] == part["high"][0]
        rows = max(1, 1_000_000 // bits.size)
        for top in range(0, end - start, rows):
            some = slice(top, top + rows)
            differ = _differing(bits[some, None, :], bits[None, :, :])
            ok = differ <= _allowed(n[some, None] + n[None, :], percent)
            ok &= root[some, None] != root[None, :]
            ok &= (part["upper"][some, None] == 0) | (part["upper"][None, :] == 0)
            ok &= key[some, None] < key[None, :]
            if not within:
                ok &= part["block"][some, None] != part["block"][None, :]
            i, j = np.nonzero(ok)
            differ, i = differ[i, j], i + top
            if closest and len(i):
                low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
                order = np.lexsort((differ, high, low))
                i, j, low, high = i[order], j[order], low[order], high[order]
                first = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
                i, j = i[first], j[first]
            found.append((key[i], key[j]))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def ngram_jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs`` (doc_id, text and any other columns).

    component_id is the smallest doc_id that links lead to, the document's own included.
    """
    return row_components(docs, words, percent).drop("root")


def row_components(
    docs: DataFrame, words: int, percent: int, carried: tuple[str, ...] = ()
) -> DataFrame:
    """The same, with the component as a value of its own, root (null for rows without words), and
    the named columns of longs. Two components may have one smallest id; their roots differ."""
    documents = saved(document_sets(docs, words, percent, carried))
    classes = documents.where("set_key is not null and doc_id is not null")
    # any document of a class can stand for it; the smallest id is the same in every run
    classes = saved(
        classes.groupBy("set_key").agg(
            F.min("doc_id").alias("doc_id"),
            F.min("n_shingles").alias("n_shingles"),
            F.min("sketch").alias("sketch"),
        )
    )
    buckets = saved(bucket_rows(signature_rows(docs, words, percent)))
    stars = buckets.select(
        F.least("center", "member").alias("a"), F.greatest("center", "member").alias("b")
    ).distinct()

    def links(pairs: DataFrame) -> DataFrame:
        return saved(linked(saved(plausible(pairs, classes, percent)), docs, classes, words, percent))

    found = links(stars)
    for closest in (True, False):
        roots = saved(components(found))
        pairs = saved(open_pairs(buckets, roots, classes, percent, closest))
        found = saved(found.union(links(pairs.join(found, ["a", "b"], "left_anti"))).distinct())
    roots = saved(components(found))
    placed = classes.join(roots, F.col("set_key") == F.col("node"), "left").select(
        "set_key", "doc_id", F.coalesce("root", "set_key").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = placed.join(least, "root").select("set_key", "component_id", "root")
    return documents.join(labels, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "root",
        *carried,
    )


#: The join of three words and 90 percent in DuckDB SQL, by all pairs that share a shingle.
JOIN_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        END) AS shingle
    FROM worded
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    JOIN sizes a ON a.doc_id = x.doc_id JOIN sizes b ON b.doc_id = y.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
       least(d.doc_id, coalesce(min(r.b), d.doc_id))::BIGINT AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reached r ON r.a = d.doc_id
GROUP BY d.doc_id, s.n
"""
