"""One query per operator: the production parameters, over a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from epochloom.llm import language_id, quality_classifier, quality_rules, toxicity
from epochloom.llm.conversation_repair import damage, repair_report
from epochloom.llm.fingerprints import fingerprint_documents
from epochloom.llm.license_scan import SCAN_SQL, find_licenses, scan_report
from epochloom.llm.mixing import MIX_SQL, mix_sources
from epochloom.llm.ngram_join import JOIN_SQL, ngram_jaccard_join
from epochloom.llm.sentencepiece_lattice import encode_documents, read_pieces
from epochloom.llm.shared import shared_folder
from epochloom.llm.token_counts import count_tokens
from epochloom.llm.token_files import read_ids, write_ids
from epochloom.llm.tokenizer_alignment import alignment_report

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(documents(spark, sf_dir), words=3, percent=90)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    return encode_documents(documents(spark, sf_dir), read_pieces(model), model)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), limit=512)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_ids(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), path)
    return read_ids(spark, path)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, labels(spark, sf_dir), modulus=3, rest=1)
    return toxicity.score(docs, model, threshold=0.7)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_rules.train(docs, labels(spark, sf_dir))
    return quality_rules.apply_rules(docs, model)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_classifier.train(docs, labels(spark, sf_dir), modulus=5, rest=0)
    return quality_classifier.score(docs, model, threshold=0.3)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train(docs, modulus=4, rest=2))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_report(find_licenses(documents(spark, sf_dir)))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(damage(rows), rows.select("conv_id"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    return alignment_report(documents(spark, sf_dir), *files)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_ngram_join": op2_ngram_join,
        "op3_mixing": op3_mixing,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_token_counts": op5_token_counts,
        "op6_token_files": op6_token_files,
        "op7_toxicity": op7_toxicity,
        "op8_quality_rules": op8_quality_rules,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_language_id": op10_language_id,
        "op11_license_scan": op11_license_scan,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_tokenizer_alignment": op13_tokenizer_alignment,
    }


def llm_sql() -> dict[str, str]:
    return {"op2_ngram_join": JOIN_SQL, "op3_mixing": MIX_SQL, "op11_license_scan": SCAN_SQL}
