"""A training-data pipeline over ``documents``: quality rules, near-duplicate
removal, repeated-passage removal, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on every document that its
predecessor kept and returns a DataFrame; ``run`` writes each result as
Parquet in the folder named by ``spark.checkpoint.dir`` and reads it again for
the next stage.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import mixing, packing, quality, simhash, substring
from quarry.llm.common import read_table, stash
from quarry.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the host-level quality rules."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs, k=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat."""
    return substring.remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mix sources", mix_sources),
    ("pack sequences", pack_sequences),
]

# Rows of an Arrow batch between Spark and Python workers: texts are long, and
# each task holds such batches outside the heap.
BATCH_ROWS = 1_000

# Fingerprints, the sampling draw and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = stash(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
