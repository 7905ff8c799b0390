"""From documents to encoded training text, in five stages that each use one operator.

Every stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet in the shared
folder and read again as the next stage's documents. All but the last keep the columns of
documents. Models are trained on the labelled rows of the tables in ``sf_dir``, so that a stage
judges by the same model whatever its predecessors removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from epochloom.llm import language_id, quality_rules
from epochloom.llm.mixing import mix_sources
from epochloom.llm.ngram_join import row_components
from epochloom.llm.queries import documents, labels, vocabulary
from epochloom.llm.sentencepiece_lattice import encode_documents, read_pieces
from epochloom.llm.shared import saved, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document goes if no language has this mean probability over its words.
LEAST_LANGUAGE = 0.5
#: Near duplicates share this percentage of their shingles of so many words.
SHINGLE_WORDS, ALIKE_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language: not without letters, nor with no language prevailing."""
    model = language_id.train(documents(spark, sf_dir), modulus=4, rest=2)
    found = language_id.identify(docs, model, carried=COLUMNS[1:])
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)
    return found.where(sure).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base rules and the regression."""
    model = quality_rules.train(documents(spark, sf_dir), labels(spark, sf_dir))
    found = quality_rules.apply_rules(docs, model, carried=COLUMNS[1:])
    return found.where("kept").select(*COLUMNS)


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with a hash of the row and a number of its own, kept in the shared folder;
    ids may be null or repeated, so stages that judge rows act by the number."""
    path = shared_folder(spark)
    marks = F.xxhash64(*COLUMNS).alias("_tie"), F.monotonically_increasing_id().alias("_row")
    rows = docs.select(*COLUMNS, *marks)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, of its smallest id. Texts are in groups, not
    ids: of an id with two texts each is judged in its own group. Rows without words are alike
    when id and text are; rows without an id are in no group, and all stay."""
    rows = numbered(spark, docs)
    same_text = F.xxhash64("text").alias("_text")
    found = row_components(
        rows.withColumn("_text", same_text),
        SHINGLE_WORDS,
        ALIKE_PERCENT,
        carried=("_text", "_tie", "_row"),
    ).where("doc_id is not null")
    alone = [F.when(F.col("root").isNull(), F.col(c)).alias(f"_{c}") for c in ("doc_id", "_text")]
    found = saved(found.select("root", *alone, "doc_id", "_tie", "_row"))
    kept = found.groupBy("root", "_doc_id", "__text").agg(
        F.min(F.struct("doc_id", "_tie", "_row")).alias("least")
    )
    # rows to drop: these are few beside the texts, which are not shuffled by a broadcast of them
    # where it is small
    dropped = found.select("_row").join(kept.select("least._row"), "_row", "left_anti")
    return rows.join(dropped, "_row", "left_anti").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops rows by the words the mix takes of each; one that is taken in part stays
    whole. Rows of one id are taken one by one, rows without an id like all others."""
    rows = numbered(spark, docs)
    times = mix_sources(rows, carried=("_tie", "_row")).where("taken > 0").select(
        "_row", F.ceil(F.col("taken") / F.col("size")).cast("int").alias("times")
    )
    return (
        rows.join(times, "_row")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(*COLUMNS)
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each document, and whether decoding gives the text back."""
    model = vocabulary("piece_bpe_32k.model")
    return encode_documents(docs, read_pieces(model), model, with_ids=True)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("sentencepiece", encode),
]

#: Trained models and BPE have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = documents(spark, sf_dir), shared_folder(spark)
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}_{name}")
        docs = spark.read.parquet(f"{path}/{k}_{name}")
    return docs
