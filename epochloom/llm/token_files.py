"""Token ids as files of canonical length-limited Huffman codes, and back.

Ids are counted over the whole corpus; code lengths of at most ``MAX_BITS`` come from these counts
(package-merge), and the lengths alone, written beside the data, fix the canonical code. Documents
end with ``END``. Each document's codes start at a byte, and every ``BLOCK`` ids a checkpoint
keeps the bit offset, so blocks are decoded independently of each other; a table of
``2 ** MAX_BITS`` entries gives id and length for the bits ahead. A file's records hold
consecutive documents and about ``RECORD_BYTES`` of codes; records ascend by range of doc_id,
then by their number, and documents in them by doc_id.

Texts are tokenized once; their ids are kept in the shared folder between the two passes, for the
counts and for the codes, and removed at the end. Only codes are shuffled. Null counts as an empty
text, whose only id is ``END``. Null ids come first; rows with equal ids are ordered by their
codes. An empty table gives empty files and no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from epochloom.llm.batches import map_slices, run_index, slices, worker_kept, worker_values
from epochloom.llm.chunks import tokenized
from epochloom.llm.shared import discard

MAX_BITS = 16
BLOCK = 1024
END = 0
RECORD_BYTES = 2_000_000
#: Chunks that the library encodes as one text.
TOGETHER = 256
RECORD = (
    "bucket int, record int, doc_ids binary, has_id binary, n_ids binary, n_bytes binary, "
    "bits binary, offsets binary, total long"
)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    # package-merge: `taken` says which of each level's sorted entries are packages
    level, taken = weight, []
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weight, pairs])
        rank = np.argsort(merged, kind="stable")
        taken.append(rank >= len(weight))
        level = merged[rank]
    need = 2 * len(order) - 2
    for packages in reversed(taken):
        chosen = packages[:need]
        single = int((~chosen).sum())
        lengths[order[:single]] += 1
        need = 2 * int(chosen.sum())
    lengths[order[:need]] += 1
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: shorter codes first, equal lengths in id order."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    codes = np.zeros(len(lengths), np.uint32)
    size = lengths[order].astype(np.int64)
    spans = 1 << (MAX_BITS - size)
    codes[order] = ((np.cumsum(spans) - spans) >> (MAX_BITS - size)).astype(np.uint32)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each value of the next ``MAX_BITS`` bits."""
    ids, sizes = np.zeros(1 << MAX_BITS, np.int32), np.ones(1 << MAX_BITS, np.uint8)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    spans = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    ids[: spans.sum()] = np.repeat(order, spans)
    sizes[: spans.sum()] = np.repeat(lengths[order], spans)
    return ids, sizes


def pack(
    ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray
) -> tuple[list[bytes], list[bytes]]:
    """Codes of each document, and the bit offsets of its blocks after the first."""
    size = lengths[ids].astype(np.int64)
    before = np.cumsum(size) - size
    ends = np.cumsum(counts)
    first = before[ends - counts]
    bits = np.add.reduceat(size, ends - counts)
    width = (bits + 7) // 8
    base = (np.cumsum(width) - width) * 8
    at = before - np.repeat(first - base, counts)
    # codes that begin in one word of 64 bits are put together; the last of them may go on in the next
    value, total = codes[ids].astype(np.uint64), int(width.sum())
    word, free = at >> 6, 64 - size - (at & 63)
    out = np.zeros(total // 8 + 2, np.uint64)
    over = np.flatnonzero(free < 0)
    rest = value[over] << (64 + free[over]).astype(np.uint64)
    value[over] >>= (-free[over]).astype(np.uint64)
    value <<= np.maximum(free, 0).astype(np.uint64)
    begins = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[begins]] = np.bitwise_or.reduceat(value, begins)
    out[word[over] + 1] |= rest
    data = out.astype(">u8").tobytes()[:total]
    inner = run_index(counts)
    mark = (inner > 0) & (inner % BLOCK == 0)
    offset = (at - np.repeat(base, counts))[mark].astype(np.uint32)
    per_doc = (counts - 1) // BLOCK
    cut = np.cumsum(per_doc)
    edge = np.cumsum(width)
    return (
        [data[e - w : e] for e, w in zip(edge.tolist(), width.tolist(), strict=True)],
        [offset[e - n : e].tobytes() for e, n in zip(cut.tolist(), per_doc.tolist(), strict=True)],
    )


def unpack(data: bytes, starts: np.ndarray, counts: np.ndarray, table) -> np.ndarray:
    """The ids of blocks that start at the given bits, end to end; all blocks advance together."""
    ids_of, size_of = table
    stream = np.frombuffer(data + b"\0\0\0", np.uint8)
    order = np.argsort(-counts, kind="stable")
    at, out_at = starts[order].copy(), (np.cumsum(counts) - counts)[order]
    active = np.searchsorted(-counts[order], -np.arange(int(counts.max(initial=0))), "left")
    out = np.zeros(int(counts.sum()), np.int32)
    for t, n in enumerate(active):
        place = at[:n]
        byte = place >> 3
        ahead = (
            stream[byte].astype(np.int64) << 16
            | stream[byte + 1].astype(np.int64) << 8
            | stream[byte + 2]
        )
        ahead = ahead >> (8 - (place & 7)) & 0xFFFF
        out[out_at[:n] + t] = ids_of[ahead]
        at[:n] += size_of[ahead]
    return out


def token_bytes(model: dict) -> np.ndarray | None:
    """How many bytes of text each id of a tokenizer's JSON stands for; None for any other kind than
    plain byte-level BPE, whose tokens spell the text and never run from a letter into white space."""
    cut, bpe = model.get("pre_tokenizer") or {}, model["model"]
    added, after = model.get("added_tokens") or [], model.get("post_processor") or {}
    plain = (
        (cut.get("type"), cut.get("use_regex", True)) == ("ByteLevel", True)
        and not (cut.get("add_prefix_space") or model.get("normalizer"))
        and after.get("type", "ByteLevel") == "ByteLevel"
        and bpe.get("type") == "BPE"
        and not (bpe.get("dropout") or bpe.get("unk_token") or bpe.get("byte_fallback"))
        and not (bpe.get("continuing_subword_prefix") or bpe.get("end_of_word_suffix"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        and not any(c.isspace() for t in added for c in t["content"])
    )
    if not plain:
        return None
    out = np.zeros(1 + max([*bpe["vocab"].values(), *(t["id"] for t in added)]), np.int64)
    out[list(bpe["vocab"].values())] = [len(token) for token in bpe["vocab"]]
    for t in added:
        out[t["id"]] = len(t["content"].encode())
    return out


class LibraryTokenizer:
    """Chunks to ids by the ``tokenizers`` library, unpacked from its JSON text in each task.

    A call for each chunk would cost as much as its merges, so chunks that begin with white space
    and end without go to the library as one text, and the bytes of its tokens tell them apart.
    """

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.bytes = token_bytes(json.loads(text))

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joins = np.zeros(len(chunks), bool)
        if self.bytes is not None:
            joins[:] = [c[:1] in " \t\n\v\f\r" and not c[-1:].isspace() for c in chunks]
        some = [chunks[i] for i in np.flatnonzero(joins).tolist()]
        texts = ["".join(some[i : i + TOGETHER]) for i in range(0, len(some), TOGETHER)]
        flat, _ = self._each(texts)
        ends = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in some], dtype=np.int64)
        reached = np.cumsum(self.bytes[flat]) if some else ends
        last = np.searchsorted(reached, ends)
        if some and not (reached[-1] == ends[-1] and (reached[last] == ends).all()):
            return self._each(chunks)
        alone, sizes = self._each([chunks[i] for i in np.flatnonzero(~joins).tolist()])
        lengths = np.zeros(len(chunks), np.int64)
        lengths[joins], lengths[~joins] = np.diff(last, prepend=-1), sizes
        out, joined = np.empty(int(lengths.sum()), np.int32), np.repeat(joins, lengths)
        out[joined], out[~joined] = flat, alone
        return out, lengths

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths


def _with_end(flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(flat, np.cumsum(counts), END), counts + 1


def _split(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    data, width = ids.tobytes(), ids.itemsize
    ends = np.cumsum(counts) * width
    sizes = counts * width
    return [data[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def id_type(vocabulary: str) -> str:
    """The narrower of 16 and 32 bits, little-endian, that holds all ids."""
    with open(vocabulary, encoding="utf-8") as file:
        model = json.load(file)
    ids = [*model["model"]["vocab"].values(), *(t["id"] for t in model.get("added_tokens") or [])]
    return "<u2" if max(ids) < 1 << 16 else "<u4"


def document_ids(docs: DataFrame, vocabulary: str, kind: str = "<u4") -> DataFrame:
    """doc_id and ids, the end id included, as integers of that kind."""
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    name = f"token_files_{abs(hash(vocabulary))}"

    def make():
        seen = worker_values(name, np.int32)
        tokenizer = worker_kept(f"{name}_tokenizer", lambda: LibraryTokenizer(shared.value))

        def step(batch):
            ids, counts = _with_end(*tokenized(batch.column("text"), seen, tokenizer))
            return {"doc_id": batch.column("doc_id"), "ids": _split(ids.astype(kind), counts)}

        return step

    return map_slices(docs.select("doc_id", "text"), make, "doc_id long, ids binary")


def _ids_of(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    counts = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int32)
    return ids, counts // np.dtype(kind).itemsize


def id_counts(encoded: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs in all documents, end ids included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for piece in slices(batch, "ids"):
                found = np.bincount(_ids_of(piece.column("ids"), kind)[0], minlength=len(total))
                found[: len(total)] += total
                total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = encoded.select("ids").mapInArrow(run, "id long, n long")
    summed = rows.groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # one row per vocabulary id
    ids = summed.column("id").to_numpy()
    out = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    out[ids] = summed.column("n").to_numpy()
    return out


def write_ids(docs: DataFrame, vocabulary: str, path: str) -> None:
    """Encode every text and write the files below ``path``: ``lengths`` and ``records``."""
    spark = docs.sparkSession
    kind = id_type(vocabulary)
    document_ids(docs, vocabulary, kind).write.option("compression", "zstd").parquet(f"{path}/ids")
    encoded = spark.read.schema("doc_id long, ids binary").parquet(f"{path}/ids")
    lengths = code_lengths(id_counts(encoded, kind))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(
        1
    ).write.parquet(f"{path}/lengths")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = encoded.where(F.col("doc_id").isNotNull()).approxQuantile(
        "doc_id", [i / count for i in range(1, count)], 0.1 / count
    )
    code = spark.sparkContext.broadcast(
        (canonical_codes(lengths), lengths, np.array(sorted({int(c) for c in cuts}), np.int64))
    )

    def make():
        codes, sizes, cuts = code.value

        def step(batch):
            ids, counts = _ids_of(batch.column("ids"), kind)
            bits, offsets = pack(ids, counts, codes, sizes)
            doc_id = batch.column("doc_id")
            bucket = np.searchsorted(cuts, pc.fill_null(doc_id, 0).to_numpy(), "right")
            bucket[pc.is_null(doc_id).to_numpy(zero_copy_only=False)] = 0
            return {
                "doc_id": doc_id,
                "bucket": bucket,
                "n_ids": counts,
                "bits": bits,
                "offsets": offsets,
            }

        return step

    schema = "doc_id long, bucket int, n_ids long, bits binary, offsets binary"
    coded = map_slices(encoded, make, schema, sized_by="ids")
    ordered = coded.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "n_ids", "bits")
    ordered.mapInArrow(_records, RECORD).write.option("compression", "none").parquet(
        f"{path}/records"
    )
    discard(spark, f"{path}/ids")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive documents of a range together, about ``RECORD_BYTES`` each."""
    held: list[tuple] = []
    size, bucket, number = 0, None, 0

    def record() -> pa.RecordBatch:
        ids, counts, bits, offsets = zip(*held, strict=True)
        row = {
            "bucket": pa.array([bucket], pa.int32()),
            "record": pa.array([number], pa.int32()),
            "doc_ids": [np.array([i or 0 for i in ids], np.int64).tobytes()],
            "has_id": [np.array([i is not None for i in ids], np.uint8).tobytes()],
            "n_ids": [np.array(counts, np.int64).tobytes()],
            "n_bytes": [np.array([len(x) for x in bits], np.int64).tobytes()],
            "bits": [b"".join(bits)],
            "offsets": [b"".join(offsets)],
            "total": pa.array([sum(counts)], pa.int64()),
        }
        return pa.RecordBatch.from_pydict(row)

    for batch in batches:
        for here, *row in zip(
            *(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "n_ids", "bits", "offsets")),
            strict=True,
        ):
            if held and (here != bucket or size > RECORD_BYTES):
                yield record()
                number = number + 1 if here == bucket else 0
                held, size = [], 0
            bucket = here
            held.append(tuple(row))
            size += len(row[2])
    if held:
        yield record()


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files; with the ids
    themselves as an array where asked for."""
    lengths = np.frombuffer(spark.read.parquet(f"{path}/lengths").first()[0], np.uint8)
    shared = spark.sparkContext.broadcast(lengths)
    records = spark.read.schema(RECORD).parquet(f"{path}/records")
    sizes = records.select("bucket", "record", "total")
    buckets = sizes.groupBy("bucket").agg(F.sum("total").alias("all"))
    # one row per range of ids
    base = buckets.select(
        "bucket", (F.sum("all").over(Window.orderBy("bucket")) - F.col("all")).alias("base")
    )
    inside = Window.partitionBy("bucket").orderBy("record")
    starts = (
        sizes.join(base, "bucket")
        .withColumn("start", F.col("base") + F.sum("total").over(inside) - F.col("total"))
        .select("bucket", "record", "start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                yield _decoded(row, table, with_ids)

    schema = "bucket int, record int, doc_id long, inner long, n_tokens long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    decoded = records.mapInArrow(run, schema)
    out = decoded.join(starts, ["bucket", "record"])
    columns = ["doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"]
    return out.select(*columns, *(["ids"] if with_ids else []))


def _decoded(row: dict, table, with_ids: bool) -> pa.RecordBatch:
    n = np.frombuffer(row["n_ids"], np.int64)
    width = np.frombuffer(row["n_bytes"], np.int64)
    blocks = (n - 1) // BLOCK + 1
    place = run_index(blocks)
    starts = np.repeat((np.cumsum(width) - width) * 8, blocks)
    starts[place > 0] += np.frombuffer(row["offsets"], np.uint32)
    counts = np.minimum(np.repeat(n, blocks) - place * BLOCK, BLOCK)
    ids = unpack(row["bits"], starts, counts, table).astype("<u4")
    ends = np.cumsum(n)
    each = [ids[e - k : e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
    known = np.frombuffer(row["has_id"], np.uint8) == 0
    size = len(n)
    columns = [
        pa.array(np.full(size, row["bucket"], np.int32)),
        pa.array(np.full(size, row["record"], np.int32)),
        pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=known),
        pa.array(ends - n),
        pa.array(n),
        pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()),
    ]
    names = ["bucket", "record", "doc_id", "inner", "n_tokens", "ids_crc32"]
    if with_ids:
        columns.append(pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)
