"""The corpus pipeline: five stages from raw documents to files of token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one gets what was
written of it. All but the last return the columns of ``docs``. Rows that repeat a doc_id, nulls
and empty texts are treated as the stages' operators say. A stage starts by deleting the working
tables of the one before it, as ``docs``, which was written meanwhile, holds all that is left of it.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from staffflow.llm.chunks import vocabulary
from staffflow.llm.common import drop_tables, read, recorded, small_batches
from staffflow.llm.decontamination import without_benchmark
from staffflow.llm.mixing import mixed_texts
from staffflow.llm.near_duplicates import one_of_each
from staffflow.llm.token_ids import digest, token_files
from staffflow.llm.toxicity import without_toxic
from staffflow.session import remove, written

TOKENIZER = "byte_bpe_50k.json"

#: Working tables of the last stage that ran.
_LEFT: list[str] = []


def leaves_nothing(stage):
    """The stage without the working tables of the one before; its own go with the next."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        drop_tables(_LEFT, docs)
        with recorded(_LEFT):
            return stage(spark, docs, sf_dir)

    return run_stage


@leaves_nothing
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return without_toxic(docs, read(spark, sf_dir, "labels"))


@leaves_nothing
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return one_of_each(docs)


@leaves_nothing
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_benchmark(docs, read(spark, sf_dir, "benchmark"))


@leaves_nothing
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed_texts(docs, read(spark, sf_dir, "labels"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix, and per document what they hold."""
    small_batches(spark)
    drop_tables(_LEFT, docs)
    return digest(token_files(docs, vocabulary(TOKENIZER)))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("token-ID output", token_ids),
]

#: Trained scores, sketches and a tokenizer are not SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs, before = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, path = written(stage(spark, docs, sf_dir))
        if before is not None:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
