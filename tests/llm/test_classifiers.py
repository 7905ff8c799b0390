"""Held-out accuracy on the test tables, parts against brute force, and awkward rows."""

import collections
import itertools
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from epochloom.llm import language_id as li
from epochloom.llm import quality_classifier as qc
from epochloom.llm import quality_rules as qr
from epochloom.llm import toxicity as tox
from epochloom.llm.queries import documents, labels
from epochloom.llm.training import sampled_texts
from tests.llm.rows import WORD, awkward, empty, frame, prose

SF = "/root/testdata/sf0.01"


def nobody(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF)


@pytest.fixture(scope="module")
def marked(spark):
    return labels(spark, SF)


# --- toxicity -------------------------------------------------------------------------------


def expressions(spark, n=240):
    """Texts in which label 1 has a few expressions of its own, with varied endings."""
    import random

    rng = random.Random(8)
    rows, known = [], []
    for i in range(n):
        words, bad = prose(rng, rng.randint(8, 60)).split(), i % 3 == 0
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(len(words)), "zyx" + rng.choice(["um", "or", "eh", "ip"]))
        rows.append((i, " ".join(words)))
        known.append((i, 1, int(bad)))
    return rows, spark.createDataFrame(known, "doc_id long, quality int, toxic int")


def test_toxic_expressions_are_found_in_held_out_rows(spark):
    rows, known = expressions(spark)
    docs = frame(spark, rows)
    model = tox.train(docs, known, modulus=3, rest=1)
    found = tox.score(docs, model, 0.7).collect()
    truth = {i: int(i % 3 == 0) for i, _ in rows}
    out = [r for r in found if r.held_out]
    assert len(found) == len(rows) and 50 < len(out) < 110
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    odd = tox.score(frame(spark, awkward()), model, 0.7).collect()
    assert len(odd) == len(awkward())
    scores = {r.score for r in odd if r.doc_id in (1, 2, 3)}
    assert len(scores) == 1


def test_shared_backoff_is_a_distribution(spark):
    """The probabilities after each context sum to one over all bytes, seen or not."""
    texts = [("the cat sat", 0), ("the dog ran", 1), ("a cat ran", 0)]
    counts = tox.class_counts(spark.createDataFrame(texts, "text string, label int"))
    table = {r.gram: r.p for r in tox.shared_backoff(counts).collect()}
    kinds = {r.gram for r in counts.collect()}
    for size in range(1, tox.ORDER):
        grams = {g & ((1 << 8 * size) - 1) for g in kinds}
        if size == tox.ORDER - 1:
            assert grams == set(table)
            for context in {g >> 8 for g in grams}:
                assert 0 < sum(p for g, p in table.items() if g >> 8 == context) <= 1 + 1e-9


def test_rows_outside_the_regression_are_counted(spark, monkeypatch):
    rows, known = expressions(spark)
    counted, whole = [], tox.class_counts
    monkeypatch.setattr(tox, "SAMPLE", 5)
    monkeypatch.setattr(tox, "class_counts", lambda t: counted.append(t.count()) or whole(t))
    tox.train(frame(spark, rows), known)
    assert counted == [len(rows) - 10]


@pytest.mark.parametrize("most", [0, 3, 1 << 20])
def test_each_gram_has_its_own_value(spark, monkeypatch, tmp_path, most):
    """With more n-grams than any fixed table: a seen one has its own value, an unseen one what its
    context gives, one in an unseen context 0; however many words are looked up by broadcast."""
    monkeypatch.setattr(tox, "FREQUENT", most)
    monkeypatch.setattr(tox, "CHUNK", 100)
    for name in ("SLOTS", "CONTEXT_SLOTS"):  # tables that earlier versions had
        monkeypatch.setattr(tox, name, 16, raising=False)
    rows = [("the cat sat on a mat", 0), ("the dog ran off with bats", 1), ("a cat ran", 0)]
    tables = tox.ratios(tox.class_counts(spark.createDataFrame(rows, "text string, label int")))
    seen = {r.gram: r.value for r in tables[0].collect()}
    unseen = {r.context: r.other for r in tables[1].collect()}
    assert len(seen) > 40 and len(unseen) > 20
    texts = [t for t, _ in rows] + ["the catz zzz", "", None, "the the dogs bats bats"]
    docs = spark.createDataFrame(
        [(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, mark int"
    )
    found = {r.doc_id: r for r in tox.features(docs.repartition(3), tables, str(tmp_path / "slices")).collect()}
    assert sorted(found) == list(range(len(texts)))
    for i, text in enumerate(texts):
        grams, lengths, _ = tox.byte_grams(pa.array([text], pa.string()))
        each = np.array([seen.get(g, unseen.get(g >> 8, 0.0)) for g in map(int, grams)])
        ends = np.cumsum(lengths)
        per_word = [each[e - n : e].sum() / n for e, n in zip(ends, lengths)]
        top = sorted([v for v in per_word if v > 0], reverse=True)
        wanted = [each.sum() / max(len(each), 1), *[sum(top[:k]) / k for k in (1, 3, 10)]]
        assert np.allclose([found[i][n] for n in tox.FEATURES[:4]], wanted, atol=1e-6)
        assert found[i].log_words == pytest.approx(np.log1p(len(lengths)))


def test_grams_are_bytes_with_their_context():
    grams, lengths, counts = tox.byte_grams(pa.array(["Ab  c", None]))
    text = [int(g).to_bytes(8, "big").lstrip(b"\0") for g in grams]
    assert text == [b" a", b" ab", b" ab ", b" c", b" c "]
    assert lengths.tolist() == [3, 2] and counts.tolist() == [2, 0]


def test_without_labels_scores_are_even(spark):
    model = tox.train(frame(spark, awkward()), nobody(spark), 3, 1)
    assert {r.score for r in tox.score(frame(spark, awkward()), model, 0.7).collect()} == {0.5}
    assert tox.score(empty(spark), model, 0.7).count() == 0


# --- samples --------------------------------------------------------------------------------


def test_samples_are_bounded_in_rows(spark, monkeypatch):
    """An id that many rows repeat is one training row, the same in every order of the rows."""
    rows = [(1, f"text {i}", "en") for i in range(40)] + [(1, "ein text", "de"), (2, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, label int")
    found = [
        sorted(map(tuple, sampled_texts(docs.repartition(n), sample).collect())) for n in (1, 5)
    ]
    assert found[0] == found[1] and [x[:2] for x in found[0]] == [(1, 0), (2, 1)]
    monkeypatch.setattr(li, "fit", lambda texts, label, languages: [languages[i] for i in label])
    assert sorted(li.train(docs)) == ["de", "en", "en"]


# --- quality rules --------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(inside), failed


def test_counts_against_brute_force(spark):
    rows = awkward() + [(300, "a b c a b c d\nx\n\nx\n x\n" * 9), (301, "p q r s " * 40 + "t")]
    found = qr.apply_rules(frame(spark, rows), qr.QualityModel()).collect()
    got = sorted(str((r.doc_id, *[r[c] for c in qr.COUNTS], r.base_failed)) for r in found)
    assert got == sorted(str((i, *brute_counts(t))) for i, t in rows)
    assert all(r.kept is not r.base_failed for r in found)
    assert qr.apply_rules(empty(spark), qr.QualityModel()).count() == 0


def test_regression_on_the_test_tables(spark, docs, marked):
    model = qr.train(docs, marked)
    found = qr.apply_rules(docs, model, carried=("text", "lang")).join(marked, "doc_id").collect()
    assert all(r.kept == (not r.base_failed and r.probability >= qr.KEEP_AT) for r in found)
    assert np.mean([(r.probability >= 0.5) == (r.quality == 1) for r in found]) > 0.98
    assert np.mean([r.kept for r in found if r.quality and not r.base_failed]) > 0.98
    assert qr.train(docs, nobody(spark)).weights is None


# --- quality classifier ---------------------------------------------------------------------


def test_quality_of_held_out_rows(spark, docs, marked):
    model = qc.train(docs, marked, modulus=5, rest=0)
    found = qc.score(docs, model, 0.3).join(marked, "doc_id").where("held_out").collect()
    assert len(found) > 30
    assert np.mean([r.predicted == r.quality for r in found]) > 0.93
    odd = qc.score(frame(spark, awkward()), model, 0.3).collect()
    assert len(odd) == len(awkward()) and all(0 <= r.score <= 1 for r in odd)
    assert qc.score(empty(spark), model, 0.3).count() == 0


def test_contexts_against_brute_force(spark):
    rows = awkward()[:18]
    found = qc.context_vectors(frame(spark, rows))
    place, sign = qc.index_vectors()
    wanted = np.zeros((qc.TYPES, qc.DIMENSIONS))
    for _, text in rows:
        types, _ = qc.token_types(pa.array([text], pa.string()))
        for i, j in itertools.product(range(len(types)), repeat=2) if len(types) < 300 else ():
            if 0 < abs(i - j) <= qc.WINDOW:
                np.add.at(wanted[types[i]], place[types[j]], sign[types[j]])
        if len(types) >= 300:
            for i in range(len(types)):
                for j in range(max(0, i - qc.WINDOW), min(len(types), i + qc.WINDOW + 1)):
                    if i != j:
                        np.add.at(wanted[types[i]], place[types[j]], sign[types[j]])
    wanted /= np.maximum(np.linalg.norm(wanted, axis=1, keepdims=True), 1e-9)
    assert np.allclose(found, wanted, atol=1e-6)


def test_tokens_part_letters_from_marks():
    types, counts = qc.token_types(pa.array(["ab!! 12é", "", None, "ab"]))
    assert counts.tolist() == [4, 0, 0, 1] and types[0] == types[4]


def test_temperature():
    margins = np.array([8.0, 8.0, 8.0, -8.0, -8.0, 8.0])
    assert qc.fit_temperature(margins, np.array([1, 1, 1, 0, 0, 0])) > 2
    assert qc.train is not None


def test_without_quality_labels(spark):
    model = qc.train(frame(spark, awkward()), nobody(spark), 5, 0)
    assert {r.score for r in qc.score(frame(spark, awkward()), model, 0.3).collect()} == {0.5}


# --- language -------------------------------------------------------------------------------


def test_languages_of_held_out_rows(spark, docs):
    model = li.train(docs, modulus=4, rest=2)
    found = li.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in found if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    odd = {r.doc_id: r for r in li.identify(frame(spark, awkward()), model).collect()}
    assert {odd[i].lang_pred for i in (1, 2, 3, 15)} == {"und"} and odd[15].score == 0
    assert all(0 <= r.score <= 1 for r in odd.values())
    # a text in two languages: neighbouring words share one
    mixed = "Stinging the thing of and that. Enheit der und ist nicht verkeit schung enlich."
    batch = li.batch_of(pa.array([mixed]))
    marginal, _, _ = li.forward_backward(
        li.emissions(batch, model.weights)[batch.which], model.transition, batch.counts
    )
    best = [model.languages[i] for i in marginal.argmax(axis=1)]
    assert best[0] == "en" and best[-1] == "de" and sum(a != b for a, b in zip(best, best[1:])) <= 3


def test_training_batch_is_that_of_the_whole():
    texts = [t or "" for _, t in awkward()] * 30
    parts, whole = li._training_batch(texts), li.batch_of(pa.array(texts))
    for name in ("feature", "owner", "size"):
        for a, b in zip(getattr(parts, name), getattr(whole, name), strict=True):
            assert sorted(a.tolist()) == sorted(b.tolist())
    assert np.array_equal(parts.which, whole.which) and np.array_equal(parts.counts, whole.counts)
    assert np.array_equal(parts.letter, whole.letter)
    weights = np.random.default_rng(1).normal(size=(len(li.KINDS), li.TABLE, 3))
    assert np.allclose(li.emissions(parts, weights), li.emissions(whole, weights))
    assert len(li._training_batch([]).which) == 0


def test_languages_by_brute_force(spark, docs):
    """Means over words with a letter, and spans, from each text's own forward-backward."""
    model = li.train(docs, modulus=4, rest=2)
    mixed = "Stinging the thing of and that 12 Enheit der und ist nicht verkeit schung enlich."
    rows = awkward() + [(400, "hallo 12 34 56"), (401, mixed), (402, "7 8 the 9 éé")]
    named = {str(r): r for r in li.identify(frame(spark, rows), model).collect()}
    spans = collections.defaultdict(list)
    for r in li.label_words(frame(spark, rows), model).collect():
        spans[r.doc_id].append((r.first_word, r.last_word, r.lang, round(r.score, 6)))
    for i, text in [x for x in rows if x[0] not in (None, 10)]:
        row = next(r for r in named.values() if r.doc_id == i)
        words = WORD.findall(text or "")
        kept = [any(c.isalpha() for c in w) for w in words]
        if not words:
            assert (row.lang_pred, row.score, spans[i]) == ("und", 0.0, [])
            continue
        marginal = model.marginals(li.batch_of(pa.array([text])))
        likely = [model.languages[k] for k in marginal.argmax(axis=1)]
        if any(kept):
            mean = marginal[kept].mean(axis=0)
            assert row.lang_pred == model.languages[mean.argmax()]
            assert row.score == pytest.approx(mean.max(), abs=1e-6)
        else:
            assert (row.lang_pred, row.score) == ("und", 0.0)
        wanted = [(k, len(list(g))) for k, g in itertools.groupby(likely)]
        got = [(x[2], x[1] - x[0] + 1) for x in sorted(spans[i])]
        assert got == wanted and sorted(spans[i])[0][0] == 0
        ends = np.cumsum([x[1] for x in wanted])
        for (a, b, lang, score), end in zip(sorted(spans[i]), ends):
            own = marginal[a : b + 1, model.languages.index(lang)]
            assert b + 1 == end and score == pytest.approx(own.mean(), abs=2e-6)
    assert li.label_words(empty(spark), model).count() == 0


def test_words_of_texts_in_two_languages(spark, docs):
    """Held-out texts of two languages end to end: most words get their own language."""
    model = li.train(docs, modulus=4, rest=2)
    held = li.identify(docs, model).where("held_out").select("doc_id")
    rows = docs.join(held, "doc_id").where("lang is not null and text is not null").orderBy("doc_id").collect()
    good = total = 0
    for a, b in zip(rows, rows[1:]):
        parts = [" ".join(r.text.split()[:40]) for r in (a, b)]
        marginal = model.marginals(li.batch_of(pa.array([" ".join(parts)])))
        truth = [r.lang for r, p in zip((a, b), parts) for _ in p.split()]
        good += sum(model.languages[k] == x for k, x in zip(marginal.argmax(axis=1), truth))
        total += len(truth)
    print("words right", good / total, "of", total)
    assert total > 1000 and good / total > 0.9


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(2)
    counts = np.array([3, 0, 1, 4])
    emission, transition = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    marginal, expected, total = li.forward_backward(emission, transition, counts)
    wanted, moves, partition, at = np.zeros((8, 3)), np.zeros((3, 3)), 0.0, 0
    for n in counts:
        paths = list(itertools.product(range(3), repeat=int(n))) if n else []
        score = [
            np.exp(
                sum(emission[at + t, s] for t, s in enumerate(p))
                + sum(transition[a, b] for a, b in zip(p, p[1:]))
            )
            for p in paths
        ]
        for p, s in zip(paths, score):
            for t, state in enumerate(p):
                wanted[at + t, state] += s / sum(score)
            for a, b in zip(p, p[1:]):
                moves[a, b] += s / sum(score)
        partition += np.log(sum(score)) if n else 0
        at += n
    assert np.allclose(marginal, wanted) and np.allclose(expected, moves)
    assert total == pytest.approx(partition)


def test_no_language_is_known(spark):
    model = li.train(empty(spark), 4, 2)
    found = li.identify(frame(spark, awkward()), model).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
    assert li.identify(empty(spark), model).count() == 0


def test_grams_take_little_memory():
    words = np.random.default_rng(1).integers(97, 123, (200_000, 9), np.uint8)
    words[:, 8] = 32
    column = pa.array([words[i : i + 2000].tobytes().decode() for i in range(0, len(words), 2000)])
    tracemalloc.start()
    grams, lengths, counts = tox.byte_grams(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lengths.tolist() == [9] * len(words) and counts.sum() == len(words)
    assert len(grams) == 9 * len(words) and peak < 60e6  # the n-grams themselves are 14 MB


def test_a_word_longer_than_a_span(monkeypatch):
    column = pa.array(["ab " + "xyz" * 40 + " c", None, "d e"])
    wanted = tox.byte_grams(column)
    monkeypatch.setattr(tox, "SPAN", 5)
    for a, b in zip(wanted, tox.byte_grams(column), strict=True):
        assert a.tolist() == b.tolist()
