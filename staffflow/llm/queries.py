"""Registered queries over the given tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from staffflow.llm.alignment import alignment
from staffflow.llm.chunks import vocabulary
from staffflow.llm.common import read
from staffflow.llm.decontamination import contaminated
from staffflow.llm.hard_negatives import HARD_SQL, mined
from staffflow.llm.language_id import languages
from staffflow.llm.language_model import language_model_scores
from staffflow.llm.mixing import MIX_SQL, mix
from staffflow.llm.near_duplicates import near_duplicates
from staffflow.llm.quality import QUALITY_SQL, judge
from staffflow.llm.secrets import find_secrets
from staffflow.llm.token_counts import token_counts
from staffflow.llm.token_ids import digest, token_files
from staffflow.llm.toxicity import toxicity
from staffflow.llm.urls import URL_SQL, filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


@query("op2_minhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_source_mixing", MIX_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op7_token_id_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(token_files(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


@query("op5_toxicity_scores")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op10_benchmark_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op6_url_filter", URL_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"))


@query("op3_adaptive_quality_rules", QUALITY_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"))


@query("op8_linked_secrets")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read(spark, sf_dir, "documents"))


@query("op1_language_model_scores")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(read(spark, sf_dir, "documents"))


@query("op11_hard_negatives", HARD_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(read(spark, sf_dir, "embeddings"))


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query("op13_language_id")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
