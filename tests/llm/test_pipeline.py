"""Every stage on the small tables, against brute force where its method is exact."""

import random

import pytest
import public_tokenizers
import sentencepiece

import __spark_entry__
import corpus_pipeline as cp
from epochloom.llm.queries import documents, llm_queries, llm_sql
from tests.llm.rows import awkward, empty, frame, prose
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = documents(spark, SF), {}
    root = tmp_path_factory.mktemp("stages")
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out[name] = docs
    return out


def test_filters_keep_whole_rows(spark, stages):
    before = {r.doc_id: r for r in documents(spark, SF).select(*cp.COLUMNS).collect()}
    for name in ("language", "quality", "near_duplicates"):
        rows = stages[name].collect()
        assert tuple(stages[name].columns) == cp.COLUMNS
        assert all(before[r.doc_id] == r for r in rows) and len(rows) <= len(before)
        before = {r.doc_id: r for r in rows}
    assert len(before) > 100


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality"].collect()]
    wanted = {int(i) for i, _, c in brute(rows, cp.SHINGLE_WORDS, cp.ALIKE_PERCENT) if int(i) == c}
    assert {r.doc_id for r in stages["near_duplicates"].collect()} == wanted


def test_mixture_repeats_documents(stages):
    kept = {r.doc_id for r in stages["near_duplicates"].collect()}
    times = {}
    for r in stages["mixture"].collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times) <= kept and 1 <= min(times.values()) and max(times.values()) <= 3


def test_pieces_of_the_last_stage(stages):
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    text = {r.doc_id: r.text for r in stages["mixture"].collect()}
    found = stages["sentencepiece"].collect()
    assert len(found) == stages["mixture"].count()
    assert all(list(r.ids) == model.encode(text[r.doc_id]) and r.round_trip for r in found)


def test_run_gives_the_last_stage(spark, stages):
    found = cp.run(spark, SF)
    columns = ["doc_id", "n_pieces", "ids_crc32"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(
        map(tuple, stages["sentencepiece"].select(columns).collect())
    )


def test_near_duplicates_are_judged_by_row(spark):
    """Repeated and null ids: a row goes for its own text only, and equal rows stay once."""
    rows = awkward()
    own = prose(random.Random(77), 60)
    copied = next(t for i, t in rows if i == 100)
    rows += [(300, copied), (300, own), (301, own), (1, None), (None, "without an id")]
    found = [(r.doc_id, r.text) for r in cp.near_duplicates(spark, frame(spark, rows), SF).collect()]
    twice = [(10, "twice"), (1, None)]
    gone = [(300, copied), (301, own), (200, copied), (5, "Word")]
    assert all(found.count(x) == 1 for x in [*twice, (300, own), (100, copied), (4, "word")])
    assert not any(x in found for x in gone)
    assert not {8, 9} & {i for i, _ in found}
    assert sorted(str(t) for i, t in found if i is None) == ["None"] + ["without an id"] * 2


@pytest.mark.parametrize("same", [7, None])
def test_mixture_takes_rows_and_not_ids(spark, same):
    """100 words of source b under one id or none, of which 80 fit; source a is taken three times."""
    rows = [(same, f"b{i} " * 10, "en", "b", 40) for i in range(10)]
    rows.append((1, "a " * 10, "en", "a", 20))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    found = [(r.doc_id, r.source, r.text) for r in cp.mixture(spark, docs, SF).collect()]
    assert [x[1] for x in found].count("a") == 3
    b = [x for x in found if x[1] == "b"]
    assert len(b) == len(set(b)) == 8 and {x[0] for x in b} == {same}


def test_stages_without_documents(spark):
    for name, stage in cp.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0, name


def test_registered_queries():
    numbers = sorted(int(n.split("_")[0][2:]) for n in llm_queries())
    assert numbers == list(range(1, 14))
    assert {*llm_queries(), "pipeline"} <= set(__spark_entry__.queries())
    assert set(llm_sql()) <= set(__spark_entry__.oracle_sql())
