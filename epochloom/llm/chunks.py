"""Texts cut into chunks that a byte-level tokenizer treats independently of each other.

A chunk is a run of white space and the characters up to the next one. The pattern of byte-level
BPE never lets a piece run from another character into white space, so texts can be cut there, and
chunks recur so often that each distinct one is tokenized once per worker. White space beyond
ASCII joins runs without being a cut; a text that holds any is one chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from epochloom.llm.batches import IS_SPACE, SeenValues, Texts, Words, texts_of, word_hashes

#: The white space beyond ASCII.
WIDE_SPACES = "".join(
    map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)


def holds_wide_space(texts: Texts) -> np.ndarray:
    data, found = texts.data, [np.zeros(0, np.int64)]
    codes = [character.encode() for character in WIDE_SPACES]
    for first in {code[0] for code in codes}:
        begins = np.flatnonzero(data == first)
        for code in (c for c in codes if c[0] == first):
            at = begins[begins + len(code) <= len(data)]
            for k in range(1, len(code)):
                at = at[data[at + k] == code[k]]
            found.append(at)
    places = np.sort(np.concatenate(found))
    return np.diff(np.searchsorted(places, texts.offsets)) > 0


def chunks_of(texts: Texts) -> Words:
    """Chunks of all texts, in order; together they are the texts."""
    data, offsets = texts.data, texts.offsets
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        space = IS_SPACE[data]
        cut[1:-1] = space[1:] & ~space[:-1]
        for i in np.flatnonzero(holds_wide_space(texts)):
            cut[offsets[i] : offsets[i + 1]] = False
    cut[offsets[:-1]] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.r_[starts, len(data)])
    return Words(starts, lengths, np.diff(np.searchsorted(starts, offsets)))


def space_chunks_of(texts: Texts) -> Words:
    """As ``chunks_of``, with U+0020 as the only white space."""
    data = texts.data
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        space = data == 0x20
        cut[1:-1] = space[1:] & ~space[:-1]
    cut[texts.offsets[:-1]] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.r_[starts, len(data)])
    return Words(starts, lengths, np.diff(np.searchsorted(starts, texts.offsets)))


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values ascending, a place of each, and which each place holds; places of one value are
    in no order, which spares a stable sort."""
    order = np.argsort(hashes)
    ranked = hashes[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]][: len(ranked)]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[new], order[new], which


def tokenized(
    column: pa.Array,
    seen: SeenValues,
    tokenize: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
    count_only: bool = False,
    cut: Callable[[Texts], Words] = chunks_of,
) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of all texts end to end, and their number per text.

    ``tokenize`` gets distinct chunks and returns their tokens end to end and how many each has.
    With ``count_only`` the first result is empty and the numbers are all there is.
    """
    texts = texts_of(column)
    chunks = cut(texts)
    hashes = word_hashes(texts.data, chunks)
    kinds, first, which = _distinct(hashes)
    if len(seen.keys) + len(kinds) > seen.limit:
        seen.clear()
    fresh = np.flatnonzero(seen.places(kinds) < 0)
    if len(fresh):
        body = texts.data.tobytes()
        begin, size = chunks.starts[first[fresh]], chunks.lengths[first[fresh]]
        ends = (begin + size).tolist()
        strings = [
            body[a:b].decode("utf-8", "replace") for a, b in zip(begin.tolist(), ends, strict=True)
        ]
        values, lengths = tokenize(strings)
        if count_only:
            values = values[:0]
            seen.add(kinds[fresh], values, np.zeros(len(fresh), np.int64))
            at = seen.places(kinds[fresh])
            seen.lengths[at] = lengths
        else:
            seen.add(kinds[fresh], values, lengths)
    at = seen.places(kinds)
    lengths = seen.lengths[at][which]
    total = np.r_[0, np.cumsum(lengths)]
    ends = np.cumsum(chunks.counts)
    per_text = total[ends] - total[ends - chunks.counts]
    if count_only:
        return np.zeros(0, seen.dtype), per_text
    places = np.repeat(seen.starts[at][which] - total[:-1], lengths)
    places += np.arange(len(places))
    flat = seen.flat[places]
    return flat, per_text
