"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A byte-level BPE vocabulary (A) encodes a space and the text, a SentencePiece model (B) the text,
before which it puts the space itself; special strings are plain text to both. Byte offsets at
which a token of either ends cut the tokens into groups, and tokens whose bytes overlap are linked.
How often a pair of ids is linked is counted in documents, over the whole table.

Texts are shuffled by their full text, so each distinct text is tokenised and aligned once and
counts for as many documents as have it. Inside a task texts are cut before spaces that follow
another character, where both tokenizers cut as well; such chunks recur, and each is encoded once
while a worker remembers it. The tokens of all new chunks lie end to end, so groups and links come
from sorted byte offsets.

Each task keeps the links of its texts in slices of up to ``SLICE_BYTES`` of text: per text the
numbers, in the slice's list of distinct pairs, of the pairs it holds, and per slice that list with
the documents that hold each pair. Only the lists are exploded, summed by pair, joined to the sums
and brought back to their slice, where the texts' measures are added up. No row per text and pair
is ever shuffled. Measures go to the documents by a digest of the text.

Null and empty texts, and those whose tokens of either side do not spell a space and the text (such
as texts with U+2581), have no tokens: zeros, and an empty digest. Rows of one id are rows of their
own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import sys
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from epochloom.llm.batches import (
    IS_SPACE,
    Texts,
    Words,
    run_index,
    run_sums,
    slices,
    texts_of,
    word_hashes,
)
from epochloom.llm.chunks import holds_wide_space
from epochloom.llm.shared import release, shared_folder
from epochloom.llm.token_counts import byte_characters

#: Text whose links share a list of distinct pairs; a longer text has a slice of its own.
SLICE_BYTES = 32_000_000
#: Chunks that a worker remembers.
REMEMBERED = 600_000
SPACE = "▁"
_SHIFT = np.int64(32)


class Encoders:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, vocabulary: bytes, model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabulary.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        names = json.loads(vocabulary)
        ids = {t["content"]: t["id"] for t in names.get("added_tokens") or []}
        plain = {i: bytes(byte_of[c] for c in n) for n, i in names["model"]["vocab"].items()
                 if n not in ids}
        plain |= {i: n.encode() for n, i in ids.items()}
        self.bytes_a = [plain.get(i, b"") for i in range(max(plain) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        return self.b.id_to_piece(i).replace(SPACE, " ").encode()

    def __call__(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of chunks that begin with a space."""
        a = [x.ids for x in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        b = self.b.encode([c[1:] for c in chunks], num_threads=1)
        # the empty text has no tokens by itself, but a space at the end of a text is one
        alone = [self.b.piece_to_id(SPACE)]
        return a, [alone if c == " " else x for c, x in zip(chunks, b, strict=True)]


def chunks_of(texts: Texts) -> Words:
    """Texts that begin with a space cut before each U+0020 that does not follow white space; not
    at all where they hold other white space than ASCII's."""
    data, offsets = texts.data, texts.offsets
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        apart = IS_SPACE[data] | (data < 0x20)
        cut[1:-1] = (data[1:] == 0x20) & ~apart[:-1]
        for i in np.flatnonzero(holds_wide_space(texts)):
            cut[offsets[i] : offsets[i + 1]] = False
    cut[offsets[:-1]] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.r_[starts, len(data)])
    return Words(starts, lengths, np.diff(np.searchsorted(starts, offsets)))


class Alignment:
    """Groups and links of texts that lie end to end, from the ids of their tokens and the sizes of
    these in bytes; both sides cover the same bytes of each text."""

    def __init__(self, a, size_a, b, size_b):
        self.a, self.b = a, b
        self.ends_a, self.ends_b = np.cumsum(size_a), np.cumsum(size_b)
        self.cuts = np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)
        self.group_a = np.searchsorted(self.cuts, self.ends_a)
        self.group_b = np.searchsorted(self.cuts, self.ends_b)
        first = np.searchsorted(self.ends_b, self.ends_a - size_a, "right")
        last = np.searchsorted(self.ends_b, self.ends_a, "left")
        #: links of each token of A, and all links as one number each
        self.width = last - first + 1
        with_b = np.repeat(first, self.width) + run_index(self.width)
        self.links = np.repeat(a.astype(np.int64) << _SHIFT, self.width) | b[with_b]

    def lines(self, counts_a, counts_b) -> list[str]:
        """``a1,a2|b1;`` for the groups of each text, of so many tokens."""
        group = np.r_[self.group_a, self.group_b]
        side = np.r_[np.zeros(len(self.a), np.int8), np.ones(len(self.b), np.int8)]
        order = np.argsort(group * 2 + side, kind="stable")
        ids, group, side = np.r_[self.a, self.b][order], group[order], side[order]
        new = np.r_[(group[1:] != group[:-1]) | (side[1:] != side[:-1]), True]
        marks = np.where(~new, 0, np.where(side == 0, 1, 2))
        words = list(map(str, ids.tolist()))
        signs = [",|;"[m] for m in marks.tolist()]
        whole = list(chain.from_iterable(zip(words, signs, strict=True)))
        ends = (2 * np.cumsum(counts_a + counts_b)).tolist()
        return ["".join(whole[x:y]) for x, y in zip([0, *ends[:-1]], ends, strict=True)]


class Chunks:
    """What a worker remembers of chunks: counts, links and groups by a 64-bit key."""

    def __init__(self, encoders: Encoders):
        self.encoders = encoders
        self.clear()

    def clear(self) -> None:
        self.keys, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        #: tokens of A and B, groups; -1 where the tokens do not spell the chunk
        self.counts = np.zeros((0, 3), np.int64)
        self.starts = self.widths = np.zeros(0, np.int64)
        self.links, self.used = np.zeros(1 << 16, np.int64), 0
        self.lines: list[bytes] = []

    def rows(self, keys: np.ndarray, spelled) -> np.ndarray:
        """Where each of the distinct keys is kept; ``spelled`` gives the chunks at places."""
        if len(self.keys) + len(keys) > REMEMBERED:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            self._add(keys[fresh], spelled(fresh))
            at = np.searchsorted(self.keys, keys)
        return self.row[at]

    def _add(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        a, b = self.encoders([c.decode("utf-8", "replace") for c in chunks])
        bytes_a, bytes_b = self.encoders.bytes_a, self.encoders.bytes_b
        good = [
            b"".join([bytes_a[i] for i in x]) == c == b"".join([bytes_b[i] for i in y])
            for c, x, y in zip(chunks, a, b, strict=True)
        ]
        a = [x if g else [] for x, g in zip(a, good, strict=True)]
        b = [y if g else [] for y, g in zip(b, good, strict=True)]
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        flat_a = np.fromiter(chain.from_iterable(a), np.int64, int(n_a.sum()))
        flat_b = np.fromiter(chain.from_iterable(b), np.int64, int(n_b.sum()))
        found = Alignment(
            flat_a, self.encoders.size_a[flat_a], flat_b, self.encoders.size_b[flat_b]
        )
        width = run_sums(found.width, n_a)
        last = np.cumsum(n_a) - 1
        upto = np.r_[0, found.group_a + 1]  # groups before each token of A
        groups = np.where(n_a > 0, upto[last + 1] - upto[last + 1 - n_a], 0)
        counts = np.where(np.array(good)[:, None], np.c_[n_a, n_b, groups], -1)
        self._links(found.links)
        starts = self.used - len(found.links) + np.cumsum(width) - width
        place = len(self.lines) + np.arange(len(keys))
        self.lines += [x.encode() for x in found.lines(n_a, n_b)]
        self.counts = np.r_[self.counts, counts]
        self.starts, self.widths = np.r_[self.starts, starts], np.r_[self.widths, width]
        merged = np.r_[self.keys, keys]
        order = np.argsort(merged, kind="stable")
        self.keys, self.row = merged[order], np.r_[self.row, place][order]

    def _links(self, more: np.ndarray) -> None:
        if len(self.links) < self.used + len(more):
            room = np.zeros(2 * (self.used + len(more)), np.int64)
            room[: self.used] = self.links[: self.used]
            self.links = room
        self.links[self.used : self.used + len(more)] = more
        self.used += len(more)


class Pairs:
    """The distinct pairs of a slice in the order they came, and the documents that hold each."""

    def __init__(self):
        self.keys, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.docs = np.zeros(0, np.int64)

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers of distinct pairs, ascending."""
        at = np.minimum(np.searchsorted(self.keys, pairs), max(len(self.keys) - 1, 0))
        known = self.keys[at] == pairs if len(self.keys) else np.zeros(len(pairs), bool)
        fresh = pairs[~known]
        if len(fresh):
            merged = np.r_[self.keys, fresh]
            order = np.argsort(merged, kind="stable")
            ids = np.r_[self.ids, len(self.keys) + np.arange(len(fresh))]
            self.keys, self.ids = merged[order], ids[order]
            self.docs = np.r_[self.docs, np.zeros(len(fresh), np.int64)]
            at = np.searchsorted(self.keys, pairs)
        return self.ids[at]

    def listed(self) -> np.ndarray:
        out = np.zeros(len(self.keys), np.int64)
        out[self.ids] = self.keys
        return out


_SCHEMA = (
    "kind int, slice long, digest string, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, held binary, pairs array<long>, docs array<long>"
)


def _aligned_rows(batches: Iterator[pa.RecordBatch], chunks: Chunks) -> Iterator[dict]:
    """One dict of columns per step: the texts of a piece of a batch, then a slice's pairs."""
    from pyspark import TaskContext

    number, pairs, size = TaskContext.get().partitionId() << 24, Pairs(), 0
    for batch in batches:
        for piece in slices(batch):
            more = pc.sum(pc.binary_length(piece.column("text"))).as_py()
            if size and size + more > SLICE_BYTES:
                yield _listed(number, pairs)
                number, pairs, size = number + 1, Pairs(), 0
            size += more
            yield _measured(piece, number, pairs, chunks)
    if size:
        yield _listed(number, pairs)


def _listed(number: int, pairs: Pairs) -> dict:
    return {
        "kind": [1], "slice": [number], "pairs": [pairs.listed()], "docs": [pairs.docs],
    }


def _measured(piece: pa.RecordBatch, number: int, pairs: Pairs, chunks: Chunks) -> dict:
    column = piece.column("text")
    copies = piece.column("copies").to_numpy()
    texts = texts_of(pc.binary_join_element_wise(" ", column, ""))
    cut = chunks_of(texts)
    keys, first, which = np.unique(
        word_hashes(texts.data, cut), return_index=True, return_inverse=True
    )
    body = texts.data.tobytes()

    def spelled(at: np.ndarray) -> list[bytes]:
        begin = cut.starts[first[at]]
        ends = (begin + cut.lengths[first[at]]).tolist()
        return [body[x:y] for x, y in zip(begin.tolist(), ends, strict=True)]

    row = chunks.rows(keys, spelled)[which]
    n = len(texts)
    good = run_sums((chunks.counts[row, 0] >= 0).astype(np.int64), cut.counts) == cut.counts
    counts = [run_sums(chunks.counts[row, k], cut.counts) for k in range(3)]
    width = chunks.widths[row]
    n_links = run_sums(width, cut.counts)
    links = chunks.links[np.repeat(chunks.starts[row], width) + run_index(width)]
    of_text = np.repeat(np.arange(n), n_links)
    kept = good[of_text]
    of_text, links = of_text[kept], links[kept]
    kinds, local = np.unique(links, return_inverse=True)
    ids = pairs.numbers(kinds)
    held, times = np.unique(of_text * len(kinds) + local, return_counts=True) if len(kinds) else (
        np.zeros(0, np.int64), np.zeros(0, np.int64)
    )
    owner, here = (held // len(kinds), ids[held % len(kinds)]) if len(kinds) else (held, held)
    weight = np.bincount(here, copies[owner], len(pairs.docs)).astype(np.int64)
    pairs.docs += weight
    order = np.lexsort((here, owner))
    here, times = here[order], times[order]
    per_text = np.cumsum(np.bincount(owner, minlength=n)).tolist() if n else []
    spans = texts.offsets.tolist()
    ends = np.cumsum(cut.counts).tolist()
    rows, lines = row.tolist(), chunks.lines
    sha, packed, digest = [], [], []
    for i in range(n):
        digest.append(hashlib.sha256(body[spans[i] + 1 : spans[i + 1]]).hexdigest())
        some = rows[ends[i - 1] if i else 0 : ends[i]]
        whole = b"".join([lines[r] for r in some])[:-1] if good[i] else b""
        sha.append(hashlib.sha256(whole).hexdigest() if good[i] else "")
        x, y = per_text[i - 1] if i else 0, per_text[i]
        packed.append(pack(here[x:y], times[x:y]))
    zero = lambda values: np.where(good, values, 0)
    return {
        "kind": [0] * n,
        "slice": [number] * n,
        "digest": digest,
        "n_a": zero(counts[0]),
        "n_b": zero(counts[1]),
        "n_groups": zero(counts[2]),
        "n_links": zero(n_links),
        "groups_sha256": sha,
        "held": packed,
    }


def pack(ids: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers of pairs and how often each is linked, in few bytes."""
    gaps = np.diff(ids, prepend=0).astype("<u4")
    return zlib.compress(gaps.tobytes() + times.astype("<u4").tobytes(), 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def _remembered(name: str, make):
    """What this worker has made under a name, also in earlier tasks."""
    kept = sys.modules.setdefault("_kept_by_worker", type(sys)("_kept_by_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def align_texts(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Alignments of all distinct texts, written to the shared folder and read again: rows of kind 0
    for texts, of kind 1 for the pairs of a slice. The paths are the driver's."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file_a, open(model, "rb") as file_b:
        files = spark.sparkContext.broadcast((file_a.read(), file_b.read()))
    name = f"alignment_{hashlib.sha256(b''.join(files.value)).hexdigest()}"
    distinct = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))

    target = StructType.fromDDL(_SCHEMA)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        chunks = _remembered(name, lambda: Chunks(Encoders(*files.value)))
        for columns in _aligned_rows(batches, chunks):
            n = len(columns["kind"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns.get(f.name, [None] * n), f.type) for f in arrow], schema=arrow
            )

    path = shared_folder(spark)
    distinct.mapInArrow(run, target).write.option("compression", "zstd").parquet(path)
    release(spark)  # the shuffled texts are not needed any more
    return spark.read.schema(target).parquet(path)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, documents and whether no pair of the same a is in more documents."""
    by_pair = _listed_pairs(aligned).groupBy("pair").agg(F.sum("docs").alias("documents"))
    by_a = F.shiftright("pair", 32).alias("a")
    sums = by_pair.select("pair", by_a, "documents")
    most = sums.groupBy("a").agg(F.max("documents").alias("most"))
    return sums.join(most, "a").select(
        "a",
        F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"),
        "pair",
        "documents",
        (F.col("documents") == F.col("most")).alias("best"),
    )


def _listed_pairs(aligned: DataFrame) -> DataFrame:
    each = aligned.where("kind = 1").select(
        "slice", F.posexplode(F.arrays_zip("pairs", "docs")).alias("id", "entry")
    )
    return each.select("slice", "id", "entry.pairs", "entry.docs").withColumnRenamed("pairs", "pair")


_MEASURES = (
    "digest string, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)


def text_measures(aligned: DataFrame) -> DataFrame:
    """The measures of each distinct text, by its digest."""
    counts = pair_counts(aligned).select("pair", "documents", "best")
    valued = _listed_pairs(aligned).join(counts, "pair").select(
        F.col("slice").alias("part"), "id", "documents", "best"
    )
    texts = aligned.where("kind = 0").drop("kind", "pairs", "docs")

    def add_up(values: pa.Table, rows: pa.Table) -> pa.Table:
        ids = values.column("id").to_numpy()
        documents, best = (np.zeros(len(ids), np.int64) for _ in range(2))
        documents[ids] = values.column("documents").to_numpy()
        best[ids] = values.column("best").to_numpy()
        n_best, total = [], []
        for held in rows.column("held").to_pylist():
            at, times = unpack(held)
            n_best.append(int((best[at] * times).sum()))
            total.append(int((documents[at] * times).sum()))
        names = ["digest", "n_a", "n_b", "n_groups", "n_links"]
        sha = rows.column("groups_sha256")
        columns = [*(rows.column(n) for n in names), pa.array(n_best, pa.int64()),
                   pa.array(total, pa.int64()), sha]
        return pa.table(columns, names=[*names, "n_best", "count_sum", "groups_sha256"])

    both = valued.groupBy("part").cogroup(texts.groupBy("slice"))
    return both.applyInArrow(add_up, _MEASURES)


def alignment_report(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row."""
    measures = text_measures(align_texts(docs, vocabulary, model))
    keyed = docs.select("doc_id", F.sha2("text", 256).alias("digest"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return keyed.join(measures, "digest", "left").select(
        "doc_id",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
