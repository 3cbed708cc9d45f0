"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """S3: scan one driver table; ``columns`` prunes the read schema at the Parquet reader."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def balanced(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan over all cores when it yields fewer partitions than the cluster's parallelism
    (one small file read by a few tasks); large inputs already have many splits and pass through.
    Hash on ``key`` keeps the placement deterministic when a task is retried."""
    spark = df.sparkSession
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want, key)
    return df


#: fixed values: text column names in order of preference
TEXT_COLUMNS = ("sentence", "text", "transcript", "transcription")


def find_text_column(df: DataFrame, candidates: Sequence[str] = TEXT_COLUMNS) -> str:
    """First candidate present in the schema (a driver-side schema check, no job)."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of {list(candidates)} is a column; the table has {df.columns}")


def require_columns(df: DataFrame, required: Sequence[str], what: str = "input") -> DataFrame:
    """Fail before planning when required columns are missing, listing the available ones."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {missing}; the table has {df.columns}")
    return df


def profile(df: DataFrame, text_col: str, preview_chars: int = 250, order_col: str | None = None) -> DataFrame:
    """Row count, column list and a preview of the first row's text (by ``order_col``, else
    file order), as one row."""
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    first = F.min_by(F.substring(F.col(text_col), 1, preview_chars), order)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), first.alias("preview")).select(
        F.lit(",".join(df.columns)).alias("columns"), "n_rows", "preview")
