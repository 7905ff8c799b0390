"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of arrays.

The distinct pieces of a slice of texts lie end to end in one array of symbols. In each round every
piece finds its pair of lowest rank, and all of these pairs, in all pieces, are merged at once;
pieces without a mergeable pair drop out, and their surviving symbols are counted. Pairs are looked
up in a hash table of the vocabulary's merges, whose size is fixed.

The vocabulary file, a ``tokenizers`` JSON file, is read by the driver and broadcast. Special
strings inside texts count as one token each, as the library does by default; no tokens are added.
Null counts as empty, which has no tokens. Rows are counted one by one, so repeated rows agree;
a text is never cut short.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from epochloom.llm.batches import map_slices, run_index, worker_values
from epochloom.llm.chunks import WIDE_SPACES, tokenized
from epochloom.llm.shared import arrived, shipped

NEVER = np.int32(2**31 - 1)
_SPACE = r"\t-\r " + WIDE_SPACES
#: Fixed value: the pattern of byte-level BPE, its white space spelled out.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+"
    r"|[" + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+"
)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for i, b in enumerate(sorted(set(range(256)) - set(plain))):
        out[b] = chr(256 + i)
    return [out[b] for b in range(256)]


@dataclass
class MergeTable:
    """Open-addressed pairs of symbols with the rank and the result of their merge."""

    pairs: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    of_byte: np.ndarray
    special: list[str]

    @staticmethod
    def read(text: str) -> MergeTable:
        file = json.loads(text)
        vocabulary = file["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
        key = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], np.uint64)
        size = 1 << (len(merges) * 8).bit_length()
        pairs = np.full(size, 2**64 - 1, np.uint64)
        ranks, results = np.full(size, NEVER, np.int32), np.zeros(size, np.int32)
        place = MergeTable._slot(key, size)
        for rank, (a, b) in enumerate(merges):
            at = int(place[rank])
            while pairs[at] != 2**64 - 1 and pairs[at] != key[rank]:
                at = (at + 1) % size
            if pairs[at] != key[rank]:
                pairs[at], ranks[at], results[at] = key[rank], rank, vocabulary[a + b]
        special = [t["content"] for t in file.get("added_tokens") or []]
        of_byte = np.array([vocabulary[c] for c in byte_characters()], np.int32)
        return MergeTable(pairs, ranks, results, of_byte, special)

    @staticmethod
    def _slot(key: np.ndarray, size: int) -> np.ndarray:
        product = (key ^ key >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
        return (product >> np.uint64(65 - size.bit_length())).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, -1 for pairs that don't merge."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = self._slot(key, len(self.pairs))
        out = np.full(len(key), -1, np.int64)
        todo = np.arange(len(key))
        while len(todo):
            here = self.pairs[at[todo]]
            hit = here == key[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit & (here != np.uint64(2**64 - 1))]
            at[todo] = (at[todo] + 1) % len(self.pairs)
        return out


def surviving_symbols(pieces: list[bytes], table: MergeTable) -> np.ndarray:
    """How many symbols each piece has when no pair of it merges any more."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    out = np.zeros(len(pieces), np.int64)
    symbol = table.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), lengths)
    slot = _slots(symbol, owner, table)
    while len(symbol):
        rank = np.where(slot >= 0, table.ranks[slot], NEVER)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        size = np.diff(np.r_[starts, len(owner)])
        least = np.minimum.reduceat(rank, starts)
        out[owner[starts]] = size
        going = np.repeat(least < NEVER, size)
        chosen = (rank == np.repeat(least, size)) & going
        at = np.flatnonzero(chosen)
        # of equal pairs in a row, such as in a run of one symbol, every second one merges
        run = np.diff(np.r_[np.flatnonzero(np.diff(at, prepend=-2) != 1), len(at)])
        at = at[run_index(run) % 2 == 0]
        symbol[at] = table.results[slot[at]]
        keep = going.copy()
        keep[at + 1] = False
        touched = np.zeros(len(symbol), bool)
        touched[at] = True
        touched[np.maximum(at - 1, 0)] = True
        symbol, owner, slot, touched = symbol[keep], owner[keep], slot[keep], touched[keep]
        again = np.flatnonzero(touched)
        slot[again] = _slots(symbol, owner, table, again)
    return out


def _slots(
    symbol: np.ndarray, owner: np.ndarray, table: MergeTable, at: np.ndarray | None = None
) -> np.ndarray:
    """The merge of each symbol with its right neighbour, -1 where there is none."""
    at = np.arange(len(symbol)) if at is None else at
    out = np.full(len(at), -1, np.int64)
    inner = np.flatnonzero(at < len(symbol) - 1)
    inner = inner[owner[at[inner]] == owner[at[inner] + 1]]
    out[inner] = table.find(symbol[at[inner]], symbol[at[inner] + 1])
    return out


class ChunkCounter:
    def __init__(self, table: MergeTable):
        self.table = table
        self.find = regex.compile(PIECES).findall
        marks = "|".join(regex.escape(s) for s in sorted(table.special, key=len, reverse=True))
        self.special = regex.compile(f"({marks})") if marks else None

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts, pieces, owner = np.zeros(len(chunks), np.int64), [], []
        for i, chunk in enumerate(chunks):
            parts = [chunk]
            if self.special and self.special.search(chunk):
                parts = self.special.split(chunk)
                counts[i] += len(parts) // 2
                parts = parts[::2]
            for part in parts:
                found = self.find(part)
                pieces += found
                owner += [i] * len(found)
        kinds = {p: k for k, p in enumerate(dict.fromkeys(pieces))}
        left = surviving_symbols([p.encode() for p in kinds], self.table)
        each = left[[kinds[p] for p in pieces]] if pieces else np.zeros(0)
        counts += np.bincount(owner, each, len(chunks)).astype(np.int64)
        return np.zeros(0, np.int32), counts


def count_tokens(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for every row;
    ``vocabulary`` is the path of the vocabulary file on the driver."""
    with open(vocabulary, encoding="utf-8") as file:
        shared = shipped(docs.sparkSession, MergeTable.read(file.read()))

    def make():
        counter = ChunkCounter(arrived(shared))
        seen = worker_values(f"token_counts_{abs(hash(vocabulary))}", np.int32)

        def step(batch):
            text = batch.column("text")
            _, counts = tokenized(text, seen, counter, count_only=True)
            return {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pc.fill_null(pc.binary_length(text), 0),
                "n_tokens": counts,
                "over_limit": counts > limit,
            }

        return step

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_slices(docs.select("doc_id", "text"), make, schema)
