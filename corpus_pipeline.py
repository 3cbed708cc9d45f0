"""Training-corpus pipeline: five stages over ``documents``, each one of the operators of ``parley.llm``.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the
shared folder and rereads it as the next stage's ``docs``. All but the last return the columns of
``documents``. SQL cannot express the string-kernel machine of the first stage, so there is no SQL for the
whole; the tests compare with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe, decontaminate, quality, simhash, toxicity
from parley.llm.common import free_name, read_columns
from parley.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 1/2; the model learns from the labelled documents of four folds."""
    labels = read_columns(spark, sf_dir, "labels", ["doc_id", "toxic"])
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = toxicity.train(docs, labels.where(fold != 0))
    name = free_name(docs.columns, "toxicity")
    return toxicity.score(docs, model, name=name).where(F.col(name) < 0.5).select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest id."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither copied nor edited."""
    return decontaminate.remove_leaking(docs, read_columns(spark, sf_dir, "benchmark", ["item_id", "text"]))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with digests of the ids and of the decoded bytes."""
    return bpe.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
