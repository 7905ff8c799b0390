"""SentencePiece encoding and decoding over a lattice of pieces.

A text gets a leading space and is cut before spaces, where no piece of a model may continue; the
distinct words so found are encoded in batches. Each word's substrings up to the longest piece are
listed by length, equi-joined by hash to the table of pieces, and kept by word as edges (start,
length, piece). Then the edges are folded, all words at once:

* models with unigram scores: Viterbi, the path of the highest sum of scores;
* BPE models: the adjacent symbols whose union is the edge of the highest score are merged until
  none is left. There the scores are an order of merges, and the path of the highest sum is not
  what such a model encodes.

Characters without an edge fall back to byte pieces, or to the unknown piece without these. Words
recur so often that each is encoded once per worker; no text or word is shuffled.

Spaces and U+2581 are one character to a model, so decoding gives a space for either. Models with
another normalisation than none, or with pieces that hold a space past their start, are refused.
Null and empty texts have no pieces and decode to the empty text; rows are encoded one by one.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from epochloom.llm.batches import map_slices, mix, run_index, run_sums, texts_of, worker_values
from epochloom.llm.chunks import space_chunks_of, tokenized
from epochloom.llm.shared import arrived, shipped

SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 2**64))
FILTER = 1 << 22
#: Log score of an unknown character below that of the worst piece; a fixed value of the library.
UNKNOWN_PENALTY = 10.0
#: Code points that are encoded in one go; longer words go alone.
CODE_POINTS = 400_000


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base)
    out[0] = 1
    return np.multiply.accumulate(out)


class Substrings:
    """Hashes of all substrings of a sequence of code points, by a prefix polynomial."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        terms = mix(points.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n)[:n]
        self.prefix = np.r_[np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)]
        self.down = _powers(_INVERSE, n)

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        span = (self.prefix[starts + length] - self.prefix[starts]) * self.down[starts]
        return mix(span + np.uint64(length))


@dataclass
class Pieces:
    """The table of pieces: text, score, and what is needed to join to it and to decode."""

    texts: list[str]
    scores: np.ndarray
    usual: np.ndarray
    of_byte: np.ndarray
    unknown: int
    kind: str

    def __post_init__(self) -> None:
        ids = np.flatnonzero(self.usual)
        names = [self.texts[i] for i in ids]
        if any(SPACE in n.lstrip(SPACE) for n in names):
            raise ValueError("a piece continues after a space")
        lengths = np.array([len(n) for n in names])
        points = code_points("".join(names))
        starts, substrings = np.cumsum(lengths) - lengths, Substrings(points)
        hashes = np.zeros(len(names), np.uint64)
        for n in np.unique(lengths):
            some = lengths == n
            hashes[some] = substrings.at(starts[some], int(n))
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order].astype(np.int32)
        self.longest = int(lengths.max())
        self.filter = np.zeros(FILTER, bool)
        self.filter[(hashes % np.uint64(FILTER)).astype(np.int64)] = True
        self.order = np.argsort(np.argsort(-self.scores, kind="stable"), kind="stable")
        plain = [t.replace(SPACE, " ").encode("utf-8", "surrogatepass") for t in self.texts]
        for byte, i in enumerate(self.of_byte):
            if i >= 0:
                plain[i] = bytes([byte])
        self.sizes = np.array([len(p) for p in plain])
        self.bytes = np.frombuffer(b"".join(plain), np.uint8)

    @staticmethod
    def read(model: bytes, kind: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = model.get_piece_size()
        if model.decode(model.encode("ﬁ  a ")) != "ﬁ  a ":
            raise ValueError("the model normalises texts")
        of_byte = np.full(256, -1, np.int32)
        for b in range(256):
            i = model.piece_to_id(f"<0x{b:02X}>")
            if model.is_byte(i):
                of_byte[b] = i
        special = [
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
            for i in range(n)
        ]
        return Pieces(
            [model.id_to_piece(i) for i in range(n)],
            np.array([model.get_score(i) for i in range(n)]),
            ~np.array(special),
            of_byte,
            model.unk_id(),
            kind,
        )

    def join(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int32)
        some = np.flatnonzero(self.filter[(hashes % np.uint64(FILTER)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        out[some[hit]] = self.ids[at[hit]]
        return out


def lattice(points: np.ndarray, lengths: np.ndarray, pieces: Pieces) -> np.ndarray:
    """(place, length - 1) to the piece that starts there, -1 for none; words of the given lengths
    lie end to end and no edge leaves its word."""
    substrings = Substrings(points)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))
    edges = np.full((len(points), pieces.longest), -1, np.int32)
    starts = np.arange(len(points))
    for n in range(1, pieces.longest + 1):
        starts = starts[left[starts] >= n]
        if not len(starts):
            break
        edges[starts, n - 1] = pieces.join(substrings.at(starts, n))
    return edges


def fold_merges(
    edges: np.ndarray, lengths: np.ndarray, pieces: Pieces
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the symbols left when the best edges have been merged in order."""
    n = len(edges)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    start, size = np.arange(n), np.ones(n, np.int64)
    never = np.int64(len(pieces.order))
    done_start, done_size = [], []

    def ranks(at: np.ndarray) -> np.ndarray:
        out = np.full(len(at), never)
        inner = np.flatnonzero(at < len(start) - 1)
        here = at[inner]
        both = size[here] + size[here + 1]
        ok = (owner[here] == owner[here + 1]) & (both <= pieces.longest)
        inner, here, both = inner[ok], here[ok], both[ok]
        found = edges[start[here], both - 1]
        out[inner] = np.where(found >= 0, pieces.order[found], never)
        return out

    rank = ranks(np.arange(n))
    while len(start):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        count = np.diff(np.r_[first, len(owner)])
        least = np.minimum.reduceat(rank, first)
        going = np.repeat(least < never, count)
        done_start.append(start[~going])
        done_size.append(size[~going])
        at = np.flatnonzero(going & (rank == np.repeat(least, count)))
        run = np.diff(np.r_[np.flatnonzero(np.diff(at, prepend=-2) != 1), len(at)])
        at = at[run_index(run) % 2 == 0]
        size[at] += size[at + 1]
        keep = going.copy()
        keep[at + 1] = False
        touched = np.zeros(len(start), bool)
        touched[at] = True
        touched[np.maximum(at - 1, 0)] = True
        start, size, owner, rank, touched = (
            x[keep] for x in (start, size, owner, rank, touched)
        )
        again = np.flatnonzero(touched)
        rank[again] = ranks(again)
    start, size = np.concatenate([*done_start, start]), np.concatenate([*done_size, size])
    order = np.argsort(start)
    return start[order], size[order]


def fold_viterbi(
    edges: np.ndarray, lengths: np.ndarray, pieces: Pieces
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the symbols on each word's path of the highest sum of scores."""
    worst = float(pieces.scores[pieces.usual].min()) - UNKNOWN_PENALTY
    first = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(-lengths[order], -np.arange(1, int(lengths.max(initial=0)) + 1), "right")
    # best[i]: the best sum up to before place i of a word, kept at its start plus i plus its index
    shift = first + np.arange(len(lengths))
    best = np.full(len(edges) + len(lengths), -np.inf)
    best[shift] = 0.0
    step = np.zeros(len(edges) + len(lengths), np.int64)
    for t, n in enumerate(active, start=1):
        words = order[:n]
        top, choice = np.full(n, -np.inf), np.ones(n, np.int64)
        for size in range(min(t, pieces.longest), 0, -1):  # of equal sums the earliest start
            piece = edges[first[words] + t - size, size - 1]
            score = np.where(piece >= 0, pieces.scores[piece], worst if size == 1 else -np.inf)
            total = best[shift[words] + t - size] + score
            better = total > top
            top[better], choice[better] = total[better], size
        best[shift[words] + t], step[shift[words] + t] = top, choice
    starts, sizes = [], []
    at, words = lengths.copy(), np.flatnonzero(lengths)
    while len(words):
        size = step[shift[words] + at[words]]
        at[words] -= size
        starts.append(first[words] + at[words])
        sizes.append(size)
        words = words[at[words] > 0]
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, size = np.concatenate(starts), np.concatenate(sizes)
    order = np.argsort(start)
    return start[order], size[order]


class WordEncoder:
    """Distinct words, with their leading spaces, to ids."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.fold = {"bpe": fold_merges, "unigram": fold_viterbi}[pieces.kind]

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out, sizes, part, total = [], [], [], 0
        for word in [*words, None]:
            if part and (word is None or total + len(word) > CODE_POINTS):
                ids, counts = self._encode(part)
                out.append(ids)
                sizes.append(counts)
                part, total = [], 0
            if word is not None:
                part.append(word)
                total += len(word)
        if not out:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate(out), np.concatenate(sizes)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, lengths = self.pieces, np.array([len(w) for w in words])
        points = code_points("".join(words).replace(" ", SPACE))
        edges = lattice(points, lengths, pieces)
        start, size = self.fold(edges, lengths, pieces)
        ids = edges[start, size - 1]
        word_of = np.repeat(np.arange(len(words)), lengths)[start]
        missing = np.flatnonzero(ids < 0)
        copies = np.ones(len(ids), np.int64)
        instead: list[int] = []
        for i in missing:
            code = chr(points[start[i]]).encode("utf-8", "surrogatepass")
            of_byte = pieces.of_byte[list(code)]
            some = of_byte.tolist() if (of_byte >= 0).all() else [pieces.unknown]
            copies[i] = len(some)
            instead += some
        flat = np.repeat(ids, copies)
        flat[np.repeat(ids < 0, copies)] = instead
        return flat, np.bincount(word_of, copies, len(words)).astype(np.int64)


def _spaced(column: pa.Array) -> pa.Array:
    """What a model sees, with U+0020 for U+2581: a space before every text that isn't empty."""
    text = pc.replace_substring(pc.fill_null(column, ""), SPACE, " ")
    return pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(" ", text, ""))


def decoded(ids: np.ndarray, counts: np.ndarray, pieces: Pieces) -> list[bytes]:
    """The bytes of the texts, without the leading space."""
    first = np.cumsum(pieces.sizes) - pieces.sizes
    size = pieces.sizes[ids]
    data = pieces.bytes[np.repeat(first[ids], size) + run_index(size)].tobytes()
    width = run_sums(size, counts)
    ends = np.cumsum(width)
    return [data[e - w : e][1:] for e, w in zip(ends.tolist(), width.tolist(), strict=True)]


def read_pieces(model: str, kind: str = "bpe") -> Pieces:
    with open(model, "rb") as file:
        return Pieces.read(file.read(), kind)


def encode_documents(
    docs: DataFrame, pieces: Pieces, name: str, with_ids: bool = False
) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of little-endian 32-bit ids) and round_trip (decoding gives the
    text back, U+2581 as a space) for every row; the ids as an array where asked for. ``name``
    tells models apart."""
    shared = shipped(docs.sparkSession, pieces)
    kept = f"sentencepiece_{abs(hash((name, pieces.kind)))}"

    def make():
        pieces = arrived(shared)
        encoder = WordEncoder(pieces)
        seen = worker_values(kept, np.int32)

        def step(batch):
            text = _spaced(batch.column("text"))
            ids, counts = tokenized(text, seen, encoder, cut=space_chunks_of)
            source, back = texts_of(text), decoded(ids, counts, pieces)
            body, at = source.data.tobytes(), source.offsets.tolist()
            same = [body[a + 1 : b] == x for a, b, x in zip(at[:-1], at[1:], back, strict=True)]
            small, ends = ids.astype("<u4"), np.cumsum(counts)
            each = [small[e - n : e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            out = {
                "doc_id": batch.column("doc_id"),
                "n_pieces": counts,
                "ids_crc32": [zlib.crc32(x.tobytes()) for x in each],
                "round_trip": same,
            }
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, ends], pa.int32()), pa.array(ids, pa.int32())
                )
            return out

        return step

    schema = "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean"
    schema += ", ids array<int>" if with_ids else ""
    return map_slices(docs.select("doc_id", "text"), make, schema)


def decode_documents(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids decode to the empty text."""
    shared = shipped(encoded.sparkSession, pieces)

    def run(batches):
        pieces = arrived(shared)
        for batch in batches:
            lists = batch.column("ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            ids = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
            texts = decoded(ids, counts, pieces)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t.decode("utf-8", "replace") for t in texts])],
                names=["doc_id", "text"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
