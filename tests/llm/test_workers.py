"""Workers that cannot import the package, and what their tasks leave behind."""

import os
import re
import subprocess
import sys
import textwrap

import public_tokenizers
import pyarrow as pa
import pytest

from epochloom.llm.batches import map_slices

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def absent(batches):
    import pyarrow as pa
    try:
        import epochloom
    except ImportError:
        yield from (pa.RecordBatch.from_pydict({{"x": [1]}}) for _ in batches)

assert spark.range(1).mapInArrow(absent, "x long").count() == 1, "workers have the package"
from epochloom.llm import (conversation_repair, language_id, license_scan, quality_classifier,
                           quality_rules, sentencepiece_lattice, token_counts,
                           tokenizer_alignment)
words = ["ab", "cd", "ef", "gh", "ij"]
rows = [(i, " ".join(words[(i * k) % 5] for k in range(60)), "x" if i % 2 else "y") for i in range(40)]
docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
json, model = {public_tokenizers.path("byte_bpe_50k.json")!r}, {public_tokenizers.path("piece_bpe_32k.model")!r}
talk = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b")],
                             "conv_id long, turn long, role string, text string")
for name, found in {{
    "op4": sentencepiece_lattice.encode_documents(
        docs, sentencepiece_lattice.read_pieces(model), model),
    "op5": token_counts.count_tokens(docs, json, 512),
    "op8": quality_rules.apply_rules(docs, quality_rules.train(docs, labels)),
    "op9": quality_classifier.score(docs, quality_classifier.train(docs, labels), 0.3),
    "op10": language_id.identify(docs, language_id.train(docs)),
    "op11": license_scan.scan_report(license_scan.find_licenses(docs)),
    "op12": conversation_repair.repair_report(talk),
    "op13": tokenizer_alignment.alignment_report(docs, json, model),
}}.items():
    assert len(found.collect()) == (1 if name == "op12" else 40), name
    print("ran", name)
"""


def test_operators_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "away.py"
    script.write_text(textwrap.dedent(SCRIPT))
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.split("ran ")[1:] == [f"op{n}\n" for n in (4, 5, 8, 9, 10, 11, 12, 13)]


class Inside:
    """Stands for a frame: gives the function of a task itself, to run in this process."""

    def mapInArrow(self, run, schema):
        return run


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_task_gives_its_memory_back(spark):
    def memory():
        with open("/proc/self/status") as status:
            return int(re.search(r"RssAnon:\s+(\d+)", status.read())[1]) // 1024

    kept, most = [], []

    def make():
        blocks = [b"x" * 60_000 for _ in range(5000)]  # 300 MB in pieces that come from the heap
        kept.append(b"y" * 60_000)  # on top of them: so the heap doesn't shrink by itself

        def step(batch):
            most.append(memory())
            return {"n": [len(blocks)] * batch.num_rows}

        return step

    before = memory()
    run = map_slices(Inside(), make, "n long")
    out = list(run(iter([pa.RecordBatch.from_pydict({"text": ["a", None]})])))
    assert [x.to_pydict() for x in out] == [{"n": [5000, 5000]}]
    assert most[0] - before > 200
    assert memory() - before < 60
