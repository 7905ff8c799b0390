import random
import re

import duckdb
import pytest

from epochloom.llm import license_scan as ls
from tests.llm.rows import awkward, empty, frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOTICE = {t.label: " ".join(t.words) for t in ls.NOTICES}


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def licensed(seed=3):
    rng = random.Random(seed)
    texts = [
        "Under the MIT License.",
        "x under the mit-license; UNDER THE MIT LICENSE under the mit",
        "Licensed under CC BY-NC 4.0. cc cc by nc by nc cc by nc",
        "Apache License, Version 2.0 and the Apache  license\nversion 2",
        "under the mit licenseé, under thé mit license",
        "UNDER THE MİT LICENSE under the mit license",
        "K" + "under the MIT license".replace("k", "K"),
        "This is Licensed under the GNU General Public License, version 3.",
        "gnu public general license version 3",
        "This is Licensed, under the GNU General (Public) License; Version three",
        *NOTICE.values(),
        NOTICE["bsd"].replace("forms", "form"),
        NOTICE["bsd"].replace("redistribution", "copying").upper(),
        "under the mit license " * 3000,
        "mit " * 9000 + "under the license",
        prose(rng, 30) + " Released under the MIT License. " + prose(rng, 30),
    ]
    return awkward() + [(1000 + i, t) for i, t in enumerate(texts)]


def by_looking(rows):
    """Base columns straight from their definition."""
    out = []
    for doc_id, text in rows:
        own = words(text)
        places, labels = [], set()
        for t in ls.PHRASES:
            found = [i for i in range(len(own)) if tuple(own[i : i + len(t.words)]) == t.words]
            places += found
            labels |= {t.label} if found else set()
        ends = (min(places), max(places)) if places else (None, None)
        out.append((doc_id, len(own), len(places), *ends, ",".join(sorted(labels))))
    return sorted(map(str, out))


def test_base_columns_against_their_definition(spark):
    rows = licensed()
    found = ls.scan_report(ls.find_licenses(frame(spark, rows)))
    base = found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(str(tuple(r)) for r in base.collect()) == by_looking(rows)


def test_report_against_sql(spark, tmp_path):
    docs = frame(spark, licensed())
    docs.write.parquet(str(tmp_path / "docs"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/docs/*.parquet'")
    result = con.execute(ls.SCAN_SQL)
    names = [c[0] for c in result.description]
    found = ls.scan_report(ls.find_licenses(docs))
    assert found.columns == names
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, result.fetchall()))


def test_notices_are_found_where_they_stand(spark):
    rng = random.Random(2)
    before = prose(rng, 40)
    rows = [(i, f"{before} {text}. {prose(rng, 40)}") for i, text in enumerate(NOTICE.values())]
    rows += [(500 + i, prose(rng, 200)) for i in range(40)]
    found = {r.doc_id: r.places for r in ls.find_licenses(frame(spark, rows)).collect()}
    for i, label in enumerate(NOTICE):
        (place,) = [p for p in found[i] if p.label == label and not p.base]
        assert (place.start, place.share) == (40, 1.0)
    assert not any(found[500 + i] for i in range(40))


def test_notices_with_a_wrong_word_and_without_a_key_phrase(spark):
    wrong = NOTICE["bsd"].replace("provided", "given")
    rows = [(1, wrong), (2, NOTICE["bsd"].replace("conditions", "terms")), (3, "free of charge")]
    found = {r.doc_id: r for r in ls.scan_report(ls.find_licenses(frame(spark, rows))).collect()}
    assert found[1].labels == "bsd" and 0.8 < found[1].score < 1
    assert (found[2].labels, found[2].score) == ("", 0.0)
    assert (found[3].labels, found[3].n_base) == ("", 0)


def test_empty_table_and_templates_of_few_words(spark):
    assert ls.scan_report(ls.find_licenses(empty(spark))).count() == 0
    with pytest.raises(ValueError):
        ls.template("x", "two words")


def test_no_python_in_the_plan(spark):
    plan = ls.scan_report(ls.find_licenses(empty(spark)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
