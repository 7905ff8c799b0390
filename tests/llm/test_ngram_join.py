import random

import numpy as np
import pyarrow as pa
import pytest

from epochloom.llm import ngram_join as nj
from epochloom.llm.components import components
from tests.llm.rows import WORD, awkward, empty, frame, prose


def shingles(text, words):
    found = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} - {()}


def brute(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(
        (str(doc_id), len(sets[i]), least.get(root(i)) if doc_id is not None else None)
        for i, (doc_id, _) in enumerate(rows)
        if doc_id is not None
    )


def near_copies(seed):
    """Groups of texts at all distances around the threshold."""
    rng = random.Random(seed)
    rows, doc_id = [], 1000
    for words in (1, 4, 12, 60, 150):
        base = prose(rng, words).split()
        for _ in range(14):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = prose(rng, 1)
            rows.append((doc_id, (" " * rng.randint(1, 2)).join(text).upper()))
            doc_id += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (2, 60)])
def test_against_brute_force(spark, words, percent):
    rows = awkward() + near_copies(words)
    found = nj.ngram_jaccard_join(frame(spark, rows), words, percent)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in found.collect() if r.doc_id)
    assert got == brute(rows, words, percent)
    assert found.count() == len(rows)


def test_empty_table(spark):
    assert nj.ngram_jaccard_join(empty(spark), 3, 90).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_linked_sets_share_a_signature_of_an_instance(percent):
    rng = np.random.default_rng(percent)
    for size in (1, 2, 5, 9, 10, 11, 40, 200, 1000):
        for _ in range(20):
            base = np.unique(rng.integers(1, 2**63, size + 200, dtype=np.uint64))
            a, common = base[:size], size
            while common > 1 and 100 * (common - 1) >= percent * (2 * size - common + 1):
                common -= 1
            grown = size * 100 // percent
            for b in (
                np.r_[a[: common], base[size : 2 * size - common]],
                np.r_[a, base[size : min(grown, len(base))]],
            ):
                values = np.concatenate([np.sort(a), np.sort(b)])
                sign, owner, upper = nj.signatures(values, np.array([len(a), len(b)]), percent)
                left = set(zip(sign[owner == 0].tolist(), upper[owner == 0].tolist()))
                right = set(zip(sign[owner == 1].tolist(), upper[owner == 1].tolist()))
                shared = {s for s, u in left for t, v in right if s == t and u + v < 2}
                assert shared, (percent, size, len(b))


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(0)
    for size in (3, 50, 700):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        b = np.r_[a[: size // 2], rng.integers(0, 2**63, size, dtype=np.uint64)]
        x, y = nj.sketches(np.r_[a, b], np.array([len(a), len(b)]), 90)
        n = min(len(x), len(y))
        differ = nj._differing(nj._folded(x, n), nj._folded(y, n))
        assert differ <= len(set(a.tolist()) ^ set(b.tolist()))


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 4)
    rows = near_copies(9)
    found = nj.ngram_jaccard_join(frame(spark, rows), 3, 90)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in found.collect())
    assert got == brute(rows, 3, 90)


def test_shingle_sets():
    column = pa.array(["A b c d", "a B c", "x y", None, "", "r r r r r"])
    values, sizes = nj.shingle_sets(column, 3)
    assert sizes.tolist() == [2, 1, 1, 0, 0, 1]
    assert values[2] in values[:2]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (200, 201)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    wanted = {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert {r.node: r.root for r in found} == wanted and len(found) == len(wanted)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_are_shuffled_in_six_bytes(spark):
    rows = nj.signature_rows(frame(spark, near_copies(9)), 3, 90).collect()
    assert rows and all(0 <= r.signature < 1 << 48 for r in rows)


def test_sets_that_share_a_bucket_by_chance_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(nj, "SIGNATURE_BITS", 6)
    rows = near_copies(9)
    found = nj.ngram_jaccard_join(frame(spark, rows), 3, 90)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in found.collect())
    assert got == brute(rows, 3, 90)
