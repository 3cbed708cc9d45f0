"""File manifests and sinks.

Binary files are listed with Spark's ``binaryFile`` source; selecting only ``path``/``length``
keeps the reader from loading file contents.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIO_EXTENSIONS = (".wav", ".mp3", ".m4a", ".flac", ".ogg")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "modificationTime", "length")


def audio_manifest(files: DataFrame, extensions: Sequence[str] = AUDIO_EXTENSIONS) -> tuple[DataFrame, DataFrame]:
    """Accepted audio files and rejects with a reason (no name, unsupported type, empty file).

    Spark's file scan already skips zero-length files, so from ``binaryFile`` an empty file is never
    accepted but also not listed; the ``empty file`` reason covers manifests built from other listings.
    """
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    reason = (F.when(name == "", F.lit("missing file name"))
              .when(~ext.isin(*[e.lower() for e in extensions]), F.lit("unsupported file type"))
              .when(F.col("length") <= 0, F.lit("empty file")))
    x = files.select("path", "length", "modificationTime", name.alias("name"), ext.alias("ext"), reason.alias("reason"))
    return x.where(F.col("reason").isNull()).drop("reason"), x.where(F.col("reason").isNotNull())


def sizes_mb(files: DataFrame, by_directory: bool = True) -> DataFrame:
    """M7: sizes in MB rounded to 2 (per file, or summed per directory)."""
    if not by_directory:
        return files.select("path", F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"))
    d = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.groupBy(d.alias("directory")).agg(F.count(F.lit(1)).alias("n_files"),
                                                   F.round(F.sum("length") / (1024 * 1024), 2).alias("size_mb"))


def write_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """K1/K3: JSON Lines, UTF-8 (non-ASCII kept as is); optional partitioning (e.g. by split)."""
    w = df.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON Lines with an explicit schema (no inference pass)."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)


def write_report(rows: DataFrame, path: str, title: str = "Benchmark report") -> str:
    """K5: a small aggregate (a few rows) as JSON lines plus a Markdown table; returns the Markdown."""
    write_jsonl(rows.coalesce(1), path + "/json")
    recs = [r.asDict() for r in rows.collect()]  # report-sized input: a handful of rows
    cols = rows.columns
    md = [f"# {title}", "", "| " + " | ".join(cols) + " |", "|" + "---|" * len(cols)]
    md += ["| " + " | ".join("" if r[c] is None else str(r[c]) for c in cols) + " |" for r in recs]
    text = "\n".join(md) + "\n"
    spark = rows.sparkSession
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path + "/markdown")
    return text


def report_record(rows: DataFrame, key: str, value: str) -> str:
    """K5 JSON form: ``{key: value}`` of a few aggregate rows as one JSON object string."""
    return json.dumps({r[key]: r[value] for r in rows.collect()}, ensure_ascii=False, indent=2)
