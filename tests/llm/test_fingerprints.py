import hashlib
import os
import random

import pytest

from epochloom.llm import fingerprints as fp
from tests.llm.rows import awkward, empty, frame, prose


def naive(text: str, k: int) -> int:
    return sum((ord(c) + 1) * pow(fp.BASES[k], i, fp.PRIMES[k]) for i, c in enumerate(text)) % fp.PRIMES[k]


def test_spans_are_polynomials_wherever_they_stand():
    text = "abcabcé🎉abc" * 5
    x = fp.Prefixes.of(text)
    for i, n in ((0, 0), (0, len(text)), (3, 3), (7, 20), (len(text), 0)):
        assert x.span(i, n) == tuple(naive(text[i : i + n], k) for k in (0, 1))


@pytest.mark.parametrize("seed", range(3))
def test_extension_and_equality_against_brute_force(seed):
    rng = random.Random(seed)
    a, b = ("".join(rng.choices("ab", k=60)) for _ in range(2))
    x, y = fp.Prefixes.of(a), fp.Prefixes.of(b)
    for _ in range(200):
        i, j = rng.randrange(61), rng.randrange(61)
        n = rng.randrange(61 - max(i, j))
        assert fp.equal_spans(x, i, y, j, n) == (a[i : i + n] == b[j : j + n])
        assert fp.common_extension(x, i, y, j) == len(os.path.commonprefix([a[i:], b[j:]]))


def test_spliced_prefixes_are_those_of_the_spliced_text():
    a, b = "hello there" * 9, "other words" * 4
    for keep, taken in ((0, 0), (5, 44), (99, 0), (50, 30)):
        whole = fp.Prefixes.of(a[:keep] + b[:taken])
        parts = fp.Prefixes.of(a).spliced(keep, fp.Prefixes.of(b), taken)
        assert all((p == q).all() for p, q in zip(parts.arrays, whole.arrays))


def test_likeness_estimates_the_share_in_common():
    rng = random.Random(4)
    a, b = prose(rng, 3000), prose(rng, 3000)
    prints = [fp.fingerprint(fp.Prefixes.of(t)) for t in (a, a[: len(a) // 2] + b, b, a + " x", "", "")]
    assert fp.likeness(prints[0], prints[0]) == 1.0
    assert 0.25 < fp.likeness(prints[0], prints[1]) < 0.6
    assert fp.likeness(prints[0], prints[2]) < 0.1
    assert fp.likeness(prints[0], prints[3]) > 0.9
    assert fp.likeness(prints[4], prints[5]) == 1.0 and fp.likeness(prints[0], prints[4]) == 0.0


def test_documents_against_brute_force(spark):
    rows = awkward()
    found = fp.fingerprint_documents(frame(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    wanted, prints = [], {}
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        marks = [fp.fingerprint(fp.Prefixes.of(t)) for t in (text, edited, after)]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        shared = len(os.path.commonprefix([text, after]))
        near = fp.likeness(marks[0], marks[1]), fp.likeness(marks[0], marks[2])
        wanted.append((doc_id, len(text), digest, marks[0], marks[1], *near, shared))
        prints.setdefault(text, marks[0])
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, wanted))
    assert len(set(prints.values())) == len(prints)


def test_one_row_and_none(spark):
    row = fp.fingerprint_documents(frame(spark, [(7, "abcd")])).collect()
    assert [(r.doc_id, r.near_next, r.edited_sha256) for r in row] == [
        (7, 1.0, hashlib.sha256(b"abab").hexdigest())
    ]
    assert fp.fingerprint_documents(empty(spark)).count() == 0
