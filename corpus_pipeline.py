"""A corpus pipeline: quality rules, exact and near deduplication, mixing, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet below the shared folder and reads it as the next stage's docs. All
but the last return the columns of documents. What a stage wrote for itself is
deleted when a later one begins with docs that do not read it.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tarn.llm.exact_dedup import drop_exact_copies
from tarn.llm.jaccard import drop_near_copies
from tarn.llm.mixing import mixed_documents, weights_in_order
from tarn.llm.packing import pack_documents
from tarn.llm.quality import keep_good
from tarn.llm.queries import SHARE, WEIGHTS, tokenizer_path
from tarn.session import drop_staged, stage, staged_paths

# near copies share four fifths of their 5-word sets; op9 has a contract of its own
NEAR_WORDS, NEAR_PERCENT = 5, 80

_own_files: list[str] = []


def _with_own_files(step):
    """A stage that first deletes what earlier stages wrote for themselves, unless its docs read it."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _own_files else []
        done = [p for p in _own_files if not any(p.rpartition("/")[2] in file for file in read)]
        drop_staged(spark, done)
        before = set(staged_paths())
        result = step(spark, docs, sf_dir)
        _own_files[:] = [p for p in _own_files if p not in done] + [p for p in staged_paths() if p not in before]
        return result

    return run


@_with_own_files
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the cutoffs of their language and source reject go."""
    return keep_good(docs)


@_with_own_files
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return drop_exact_copies(docs)


@_with_own_files
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that similar 5-word sets connect, the document with the smallest id stays."""
    return drop_near_copies(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


@_with_own_files
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents are left out or repeated."""
    return mixed_documents(docs, weights_in_order(WEIGHTS), SHARE)


@_with_own_files
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in the training sequences."""
    return pack_documents(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix),
    ("best_fit_packing", pack),
]

# no SQL for the sketches of the first stage and the patterns of the last; tests/llm compares with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
