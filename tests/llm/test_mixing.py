import duckdb
import pytest

from epochloom.llm import mixing
from tests.llm.rows import WORD, awkward, empty, frame


def brute_targets(sizes):
    """Reshare what is above the caps until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > 3 * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in above}


SIZES = [
    {"a": 100, "b": 10, "c": 5, None: 3},
    {"a": 1, "b": 1000, "c": 2, "d": 1, "é": 40, "Z": 7},
    {"a": 0, "b": 5},
    {None: 9},
]


@pytest.mark.parametrize("sizes", SIZES)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(df).collect()}
    wanted = brute_targets(sizes)
    assert found.keys() == wanted.keys()
    assert all(found[s] == pytest.approx(wanted[s]) for s in wanted)


@pytest.mark.parametrize("range_rows", [3, 100_000])
def test_taken_words(spark, monkeypatch, tmp_path, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rows = awkward()
    docs = frame(spark, rows)
    found = mixing.mix_sources(docs).collect()
    assert len(found) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted(r["size"] for r in found) == sorted(size(t) for _, t in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in found)
    taken = {}
    for r in found:
        key = (r.source_size, r.target)
        taken[key] = taken.get(key, 0) + r.taken
    assert all(0 <= target - words < 1 for (_, target), words in taken.items())
    con = duckdb.connect()
    docs.write.parquet(str(tmp_path / "docs"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/docs/*.parquet'")
    wanted = con.execute(mixing.MIX_SQL).fetchall()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))


def test_no_words_and_no_rows(spark):
    assert mixing.mix_sources(empty(spark)).count() == 0
    found = mixing.mix_sources(frame(spark, [(1, None), (2, " ")])).collect()
    assert [(r["size"], r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2
