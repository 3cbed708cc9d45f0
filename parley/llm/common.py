"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 2_000_000


def read_columns(spark: SparkSession, sf_dir: str, table: str, columns: list[str]) -> DataFrame:
    """The named columns of a driver table, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*columns)


def blocks(batches: Iterable[pa.RecordBatch], text_col: str = "text",
           max_bytes: int = BLOCK_BYTES, max_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``max_bytes`` of text (a longer text is a slice of its own)
    and at most ``max_rows`` rows.

    Working memory of a task then follows the block, not the Arrow batch.
    """
    for b in batches:
        if b.num_rows == 0:
            continue
        n = np.asarray(pc.fill_null(pc.binary_length(b.column(text_col)), 0), dtype=np.int64)
        cuts, total = [0], 0
        for i, x in enumerate(n.tolist()):
            if i > cuts[-1] and (total + x > max_bytes or i - cuts[-1] >= max_rows):
                cuts.append(i)
                total = 0
            total += x
        cuts.append(b.num_rows)
        for lo, hi in zip(cuts, cuts[1:]):
            yield b.slice(lo, hi - lo)


def texts_of(batch: pa.RecordBatch, text_col: str = "text") -> list[str]:
    """The texts of a batch; null reads as the empty text."""
    return ["" if t is None else t for t in batch.column(text_col).to_pylist()]


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only; every other character stays."""
    return text.encode().lower().decode()


def fold(doc_id, modulus: int) -> int:
    """crc32 of the id's decimal text, modulo ``modulus`` (null ids hash as the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of ``df`` but for those of the given names (in any case): new columns replace them."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def free_name(names: Iterable[str], name: str) -> str:
    """``name`` with as many underscores as it takes to differ from ``names``."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


def annotate(docs: DataFrame, start: Callable[[], Callable[[list[str]], dict[str, pa.Array]]], added: str,
             text_col: str = "text") -> DataFrame:
    """``docs`` with further columns computed from each text, in one pass and without a shuffle.

    ``start`` is called once a task and returns the function from a block of texts to the added columns, whose
    schema is ``added``. They replace columns of the same names.
    """
    from pyspark.sql.types import StructType

    more = StructType.fromDDL(added)
    keep = without(docs, more.names)
    source = free_name([*keep, *more.names], "text")

    def run(batches):
        work = start()
        for b in blocks(batches, source):
            new = work(texts_of(b, source))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(new[f] for f in more.names)], names=[*keep, *more.names])

    src = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).cast("string").alias(source))
    return src.mapInArrow(run, StructType([*(docs.schema[c] for c in keep), *more.fields]))
