"""Both tokenizers against their libraries, and the id files as an exact round trip."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from epochloom.llm import sentencepiece_lattice as sl
from epochloom.llm import token_counts as tc
from epochloom.llm import token_files as tf
from epochloom.llm.batches import SeenValues
from epochloom.llm.chunks import space_chunks_of, tokenized
from tests.llm.rows import awkward, empty, frame

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "abcde  tion\n\t'sé日🎉12.!_<|> 　\x1c▁A"


def random_texts(seed, n=120):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def pieces():
    return sl.read_pieces(PIECES)


def library_ids(library, texts):
    return [e.ids for e in library.encode_batch(list(texts), add_special_tokens=False)]


def test_counts_of_random_texts(library):
    with open(BYTES, encoding="utf-8") as file:
        counter = tc.ChunkCounter(tc.MergeTable.read(file.read()))
    texts = random_texts(1) + [t or "" for _, t in awkward()] + ["aaaaaaa" * 30, "ababab" * 40]
    _, counts = tokenized(pa.array(texts), SeenValues(np.int32), counter, count_only=True)
    assert counts.tolist() == [len(ids) for ids in library_ids(library, texts)]


def test_counts_of_documents(spark, library):
    rows = awkward()
    found = tc.count_tokens(frame(spark, rows), BYTES, 512).collect()
    sizes = [len(ids) for ids in library_ids(library, [t or "" for _, t in rows])]
    wanted = [(i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, sizes)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    assert tc.count_tokens(empty(spark), BYTES, 512).count() == 0


def test_a_small_cache_changes_nothing(library):
    tokenizer = tf.LibraryTokenizer(open(BYTES, encoding="utf-8").read())
    seen, texts = SeenValues(np.int32, limit=50), random_texts(2)
    for part in (texts[:40], texts[40:80], texts[:40], texts[80:]):
        ids, counts = tokenized(pa.array(part), seen, tokenizer)
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == library_ids(library, part)


@pytest.mark.parametrize("limit", [4, 7, 16])
def test_code_lengths_are_optimal(limit):
    rng = random.Random(limit)
    for size in (2, 3, 9, 16):
        counts = np.array([int(2 ** rng.uniform(0, 20)) for _ in range(size)])
        lengths = tf.code_lengths(counts, limit)
        assert lengths.max() <= limit and sum(2.0**-n for n in lengths.tolist()) <= 1
        assert (counts * lengths).sum() == least_cost(tuple(sorted(counts.tolist())), limit)


def least_cost(counts, limit):
    """All multisets of code lengths that fit, by dynamic programming over used code space."""
    best = {0: 0}
    floor = 1
    space = 1 << limit
    states = {(0, limit): 0}
    for c in counts:  # rarest first, so lengths never grow
        fresh = {}
        for (used, longest), cost in states.items():
            for n in range(floor, longest + 1):
                total = used + (space >> n)
                if total <= space:
                    key = (total, n)
                    fresh[key] = min(fresh.get(key, 1 << 62), cost + c * n)
        states = fresh
    assert best
    return min(states.values())


def test_one_id_and_no_id():
    assert tf.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0]
    assert tf.code_lengths(np.array([0, 0])).tolist() == [0, 0]


def test_blocks_decode_on_their_own():
    rng = np.random.default_rng(3)
    counts = np.array([1, 5000, 1024, 1025, 2, 3000])
    ids = (rng.pareto(1.0, counts.sum()) * 3).astype(np.int64) % 3000
    lengths = tf.code_lengths(np.bincount(ids, minlength=3000))
    bits, offsets = tf.pack(ids, counts, tf.canonical_codes(lengths), lengths)
    table, at = tf.decoding_table(lengths), 0
    for data, marks, n in zip(bits, offsets, counts.tolist(), strict=True):
        starts = [0, *np.frombuffer(marks, np.uint32).tolist()]
        for k, start in enumerate(starts):
            size = min(tf.BLOCK, n - k * tf.BLOCK)
            part = tf.unpack(data, np.array([start]), np.array([size]), table)
            assert part.tolist() == ids[at + k * tf.BLOCK :][:size].tolist()
        at += n


def test_files_round_trip(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(tf, "RECORD_BYTES", 500)
    rows = awkward()
    tf.write_ids(frame(spark, rows), BYTES, str(tmp_path / "files"))
    found = tf.read_ids(spark, str(tmp_path / "files"), with_ids=True).collect()
    ids = [x + [0] for x in library_ids(library, [t or "" for _, t in rows])]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    got = sorted(str((r.doc_id, r.n_tokens, r.ids_crc32, list(r.ids))) for r in found)
    assert got == sorted(str((i, len(x), crc(x), x)) for (i, _), x in zip(rows, ids, strict=True))
    found.sort(key=lambda r: r.start)
    assert [r.start for r in found] == [
        sum(r.n_tokens for r in found[:k]) for k in range(len(found))
    ]
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert keys == sorted(keys)


def test_no_documents_in_files(spark, tmp_path):
    tf.write_ids(empty(spark), BYTES, str(tmp_path / "none"))
    assert tf.read_ids(spark, str(tmp_path / "none")).count() == 0


def encoded(texts, pieces):
    column = sl._spaced(pa.array(texts, pa.string()))
    ids, counts = tokenized(
        column, SeenValues(np.int32), sl.WordEncoder(pieces), cut=space_chunks_of
    )
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts)]


def test_pieces_of_random_texts(model, pieces):
    texts = random_texts(5) + [t or "" for _, t in awkward()] + ["aaaa" * 50, "\x00 ﻿"]
    assert encoded(texts, pieces) == model.encode(texts)


def test_viterbi_takes_the_best_path(pieces):
    rng = random.Random(6)
    names = ["▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "cab", "aa"]
    scores = np.array([-rng.uniform(1, 9) for _ in names])
    usual = np.ones(len(names) + 1, bool)
    usual[-1] = False
    small = sl.Pieces([*names, "<unk>"], np.r_[scores, 0.0], usual, np.full(256, -1), 10, "unigram")
    texts = ["".join(rng.choices("abcz", k=rng.randint(1, 9))) for _ in range(40)]
    for text, ids in zip(texts, encoded(texts, small), strict=True):
        word = "▁" + text
        best = [(0.0, [])]
        for end in range(1, len(word) + 1):
            options = []
            for start in range(end):
                part = word[start:end]
                if part in names:
                    options.append((best[start][0] + scores[names.index(part)], start, names.index(part)))
                elif end - start == 1:
                    options.append((best[start][0] + scores.min() - sl.UNKNOWN_PENALTY, start, 10))
            total, start, piece = max(options)
            best.append((total, best[start][1] + [piece]))
        assert ids == best[-1][1], text


def test_documents_encode_and_decode(spark, model, pieces):
    rows = awkward()
    frame_ = sl.encode_documents(frame(spark, rows), pieces, "test", with_ids=True)
    found = frame_.collect()
    wanted = [(i, model.encode(t or "")) for i, t in rows]
    assert sorted(str((r.doc_id, list(r.ids))) for r in found) == sorted(map(str, wanted))
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in found)
    back = sl.decode_documents(frame_, pieces).collect()
    texts = [(i, (t or "").replace("▁", " ")) for i, t in rows]
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, texts))
    assert sl.encode_documents(empty(spark), pieces, "test").count() == 0


class Counted:
    """A tokenizer that keeps how many texts it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.given += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_chunks_are_encoded_together(library):
    with open(BYTES, encoding="utf-8") as file:
        tokenizer = tf.LibraryTokenizer(file.read())
    tokenizer.tokenizer = counted = Counted(tokenizer.tokenizer)
    texts = [" " + " ".join(f"{w}{k}" for k in range(400)) for w in ("é'sa", "<|x", "日, \n")]
    texts += [" a <|endoftext|> b", "<|endoftext|>", "", " \u3000 x", "\x1c y \x1c", "z  "]
    ids, counts = tokenized(pa.array(texts), SeenValues(np.int32), tokenizer)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == library_ids(library, texts)
    assert counted.given < 40


def test_chunks_of_other_tokenizers_are_encoded_alone():
    with open(BYTES, encoding="utf-8") as file:
        model = json.load(file)
    assert tf.token_bytes(model) is not None
    for change in (
        {"normalizer": {"type": "NFC"}},
        {"pre_tokenizer": {"type": "Whitespace"}},
        {"pre_tokenizer": model["pre_tokenizer"] | {"add_prefix_space": True}},
        {"added_tokens": [model["added_tokens"][0] | {"lstrip": True}]},
    ):
        assert tf.token_bytes(model | change) is None


def test_ids_are_kept_in_the_fewest_bytes(spark):
    assert tf.id_type(BYTES) == "<u2"
    rows = [(1, "a bc"), (2, None)]
    narrow, wide = (
        {r.doc_id: np.frombuffer(r.ids, kind).tolist() for r in tf.document_ids(frame(spark, rows), BYTES, kind).collect()}
        for kind in ("<u2", "<u4")
    )
    assert narrow == wide and narrow[2] == [tf.END]
