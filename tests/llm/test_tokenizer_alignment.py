import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from epochloom.llm import tokenizer_alignment as ta
from epochloom.llm.token_counts import byte_characters
from tests.llm.rows import awkward, empty, frame, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def tokens(libraries, text):
    """Ids and bytes of the tokens of both, from whole texts."""
    a, b = libraries
    byte_of = {c: n for n, c in enumerate(byte_characters())}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    spelled = lambda p: bytes([int(p[3:-1], 16)]) if len(p) == 6 and p[:3] == "<0x" else (
        p.replace("▁", " ").encode()
    )
    return (
        [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in ids_a],
        [(i, spelled(b.id_to_piece(i))) for i in ids_b],
    )


def aligned(libraries, text):
    """(line of groups, links) pair by pair, None without tokens."""
    if not text:
        return None
    sides = tokens(libraries, text)
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
        return None
    spans = []
    for side in sides:
        at, out = 0, []
        for i, data in side:
            out.append((i, at, at + len(data)))
            at += len(data)
        spans.append(out)
    ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups = []
    for start, end in zip([0, *ends[:-1]], ends, strict=True):
        inside = [",".join(str(i) for i, s, e in x if start <= s and e <= end) for x in spans]
        groups.append("|".join(inside))
    links = []
    for i, s, e in spans[0]:
        links += [(i, j) for j, t, f in spans[1] if s < f and t < e]
    return len(spans[0]), len(spans[1]), groups, links


def report(libraries, rows):
    found = [aligned(libraries, text) for _, text in rows]
    documents = Counter()
    for x in found:
        documents.update(set(x[3]) if x else ())
    most = Counter()
    for (a, _), n in documents.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), x in zip(rows, found, strict=True):
        if x is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = x
        best = sum(documents[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        total = sum(documents[p] for p in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, total, digest))
    return sorted(map(str, out))


def mixed():
    texts = [
        " leading", "trailing ", "tab\tand\nline  two   spaces", "it's we'll don't 3.14 12345",
        "ends with space \x1c x \x1d", "日本語 テスト", "naïve café 🎉🎉 ok", "▁under", "a ▁ b",
        "<0x41> <unk> <|endoftext|> <s>", "\x00 zero", "wide　space and more", "  x",
        "  ", "\n\n", "éééé éé", "snowman☃ ☃☃",
    ]
    return [r for r in awkward() if len(r[1] or "") < 6000] + [
        (300 + i, t) for i, t in enumerate(texts)
    ]


def test_report_against_pairwise_alignment(spark, libraries):
    rows = mixed()
    found = ta.alignment_report(frame(spark, rows), VOCABULARY, MODEL).collect()
    assert sorted(str(tuple(r)) for r in found) == report(libraries, rows)


def test_many_slices_and_forgotten_chunks(spark, libraries, monkeypatch):
    import random

    rng = random.Random(4)
    monkeypatch.setattr(ta, "SLICE_BYTES", 1500)
    monkeypatch.setattr(ta, "REMEMBERED", 120)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(300)]
    found = ta.alignment_report(frame(spark, rows), VOCABULARY, MODEL).collect()
    assert sorted(str(tuple(r)) for r in found) == report(libraries, rows)


def test_pairs_are_counted_in_documents(spark, libraries):
    rows = [(1, "the cat the cat"), (2, "the cat the cat"), (3, "the dog"), (3, "the dog")]
    counts = ta.pair_counts(ta.align_texts(frame(spark, rows), VOCABULARY, MODEL)).collect()
    wanted = Counter()
    for _, text in rows:
        wanted.update(set(aligned(libraries, text)[3]))
    assert {(r.a, r.b): r.documents for r in counts} == wanted
    assert all(r.best for r in counts if r.documents == max(wanted.values()))


def test_packed_links_come_back():
    import numpy as np

    ids, times = np.array([0, 5, 6, 70000]), np.array([1, 2, 300, 70001])
    assert [x.tolist() for x in ta.unpack(ta.pack(ids, times))] == [ids.tolist(), times.tolist()]
    assert [len(x) for x in ta.unpack(ta.pack(ids[:0], times[:0]))] == [0, 0]


def test_long_text_without_a_space_and_no_rows(spark, libraries):
    rows = [(1, "x" * 100_000), (2, "ab" * 50_000)]
    found = {r.doc_id: r for r in
             ta.alignment_report(frame(spark, rows), VOCABULARY, MODEL).collect()}
    for doc_id, text in rows:
        a, b = tokens(libraries, text)
        assert (found[doc_id].n_a, found[doc_id].n_b) == (len(a), len(b))
    assert ta.alignment_report(empty(spark), VOCABULARY, MODEL).count() == 0
    assert json.loads(open(VOCABULARY).read())["model"]["vocab"]
