"""Operator 11: importance resampling towards a target distribution.

Features are all runs of ``lo`` to ``hi`` consecutive words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are
lower-cased) joined by one space, hashed into buckets (unsigned CRC-32 of the UTF-8 bytes, modulo ``buckets``). With S features of
all documents, s of them in a bucket, and T and t for the target texts, a bucket's gain is
``floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))`` and a document's weight the sum over its features.
A Gumbel number from ``sha256("<seed>:<id>")`` is added to it, and the highest scores are drawn, ties to the smaller id.

1. Buckets are counted in one map pass: a task sends one row for each bucket, whatever its input.
2. The gains, one array of ``buckets`` numbers, go to all tasks; a second map pass adds up each document's features by
   array look-up. Scores, ids and a row number are written to the shared folder; texts stay where they are.
3. The cutoff is found by bisection on numbers: count jobs over the written scores halve the range of the score,
   then, among rows tied at the cutoff, the range of the id, then of the row number. Nothing is
   sorted, and only counts reach the driver.
4. Drawn rows are range-partitioned by (score, id, row) and numbered partition by partition; the offsets are the
   partitions' counts.

Defined results: a null text has no words and weight 0; only documents of ``min_words`` words or more can be
drawn; a null id is hashed as the empty text and comes after all others among equal scores; repeated rows are drawn one
by one, in an arbitrary but fixed order where id and score are equal; an empty target or an empty table gives weights from
the counts alone (an empty table an empty result). Ids are whole numbers. Only the id and text columns are read by
``weigh`` and ``resample``; ``draw`` returns whole rows, an added column replaces one of the same name.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, materialize, shuffle_partitions
from .common import blocks, free_name, texts_of, without

#: features of a task that are remembered with their buckets
CACHE = 300_000
#: counts of one job while the cutoff is searched: the range shrinks to a sixteenth a job
FAN = 16

_WORD_BYTES = bytes(c if c >= 0x80 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" else
                    c + 32 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 0x20 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Words in order: bytes of other characters become blanks."""
    return text.encode().translate(_WORD_BYTES).split()


class _Buckets(dict):
    """feature -> bucket, computed once a feature; starts anew when it holds ``CACHE`` features."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features_of(text: str, lo: int, hi: int) -> tuple[int, list[bytes]]:
    """Number of words, and all features of a text."""
    words = words_of(text)
    if (lo, hi) == (1, 1):
        return len(words), words
    return len(words), [b" ".join(words[i:i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def bucket_counts(texts: DataFrame, buckets: int, lo: int = 1, hi: int = 1, text_col: str = "text") -> np.ndarray:
    """Features of all texts in each bucket."""

    def count(batches):
        total, bucket = np.zeros(buckets, dtype=np.int64), _Buckets(buckets)
        for b in blocks(batches):
            for t in texts_of(b):
                found = features_of(t, lo, hi)[1]
                total += np.bincount(np.fromiter(map(bucket.__getitem__, found), np.int64, len(found)), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    src = texts.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in src.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, from the features of the documents and of the target in it."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def _gumbel(seed: int, id_col: Column) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of the hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, target: DataFrame, buckets: int = 10_000, lo: int = 1, hi: int = 1, seed: int = 2024,
          id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    gain = gains(bucket_counts(docs, buckets, lo, hi, text_col), bucket_counts(target, buckets, lo, hi, target_col))
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # ``buckets`` numbers
    id_type = docs.schema[id_col].dataType.simpleString()

    def add_up(batches):
        bucket = _Buckets(buckets)
        for b in blocks(batches):
            n_words, n_features, weight = [], [], []
            for t in texts_of(b):
                n, found = features_of(t, lo, hi)
                n_words.append(n)
                n_features.append(len(found))
                weight.append(int(sent.value[np.fromiter(map(bucket.__getitem__, found), np.int64, len(found))].sum()))
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "n_words": pa.array(n_words, pa.int64()),
                                              "n_features": pa.array(n_features, pa.int64()), "weight": pa.array(weight, pa.int64())})

    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = src.mapInArrow(add_up, f"id {id_type}, n_words bigint, n_features bigint, weight bigint")
    return out.withColumn("score", F.col("weight") + _gumbel(seed, F.col("id"))).withColumnRenamed("id", id_col)


def cutoff(table: DataFrame, value: str, k: int) -> tuple[int, int]:
    """(c, rows below c): c is the smallest value with at least ``k`` rows at or below it. 1 <= k <= rows.

    Every job counts the rows under ``FAN`` - 1 numbers of the range that holds c, and keeps one part of it.
    """
    lo, hi = table.agg(F.min(value), F.max(value)).first()
    below = 0
    while lo < hi:  # c lies in [lo, hi], ``below`` rows under lo
        cuts = sorted({lo + (hi - lo) * i // FAN for i in range(1, FAN)})
        counts = table.agg(*(F.count_if(F.col(value) <= c) for c in cuts)).first()
        at = next((i for i, n in enumerate(counts) if n >= k), len(cuts))
        if at:
            lo, below = cuts[at - 1] + 1, counts[at - 1]
        hi = cuts[at] if at < len(cuts) else hi
    return lo, below


def highest(scored: DataFrame, k: int) -> Column:
    """Condition for the ``k`` best rows: highest score, then smaller id (null last), then smaller row number."""
    if k <= 0:
        return F.lit(False)
    keys = [-F.col("score"), F.col("id").isNull().cast("bigint"), F.coalesce(F.col("id").cast("bigint"), F.lit(0)), F.col("row")]
    taken, rest = F.lit(False), F.lit(True)
    for key in keys:
        tied = scored.where(rest).select(key.alias("key"))
        at, below = cutoff(tied, "key", k)
        taken, rest, k = taken | (rest & (key < at)), rest & (key == at), k - below
        if tied.where(F.col("key") == at).count() == k:
            break
    return taken | rest


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    """(row, rank) of the ``k`` best rows."""
    drawn = scored.where(highest(scored, k)).select("score", "id", "row")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    spread = drawn.repartitionByRange(shuffle_partitions(scored.sparkSession), *order).sortWithinPartitions(*order)
    # partition number and place in the partition, as Spark numbers rows
    placed = cut_lineage(spread.select("row", F.monotonically_increasing_id().alias("_at")))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before, offsets = 0, []
    for p, n in sorted(placed.groupBy(part.alias("p")).count().collect()):
        offsets.append((p, before))
        before += n
    if not offsets:
        return placed.select("row", F.lit(0).cast("bigint").alias("rank"))
    starts = F.broadcast(scored.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint"))  # one row a partition
    return placed.join(starts, part == F.col("_part")).select("row", (F.col("_start") + place + 1).alias("rank"))


def _scored(docs: DataFrame, target: DataFrame, min_words: int, percent: int, **how) -> tuple[DataFrame, DataFrame, int]:
    id_col = how.get("id_col", "doc_id")
    scored = weigh(docs, target, **how).withColumnRenamed(id_col, "id")
    scored = cut_lineage(scored.withColumn("row", F.monotonically_increasing_id()))
    fit = scored.where(F.col("n_words") >= min_words)
    return scored, fit, percent * fit.count() // 100


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, id_col: str = "doc_id", **how) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; ``rank`` counts the drawn rows from 1, others have none.
    Drawn are ``percent`` of the rows with ``min_words`` words or more. ``how``: parameters of ``weigh``."""
    scored, fit, k = _scored(docs, target, min_words, percent, id_col=id_col, **how)
    out = scored.join(_ranked(fit, k), "row", "left")
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text",
         **how) -> DataFrame:
    """The drawn rows of ``docs`` with their ``rank``. The rows are written once with a row number, as ids may repeat."""
    cols = without(docs, ["rank"])
    row = free_name([*cols, "rank"], "row")
    whole = materialize(docs.select(*(F.col(f"`{c}`") for c in cols), F.monotonically_increasing_id().alias(row)), "resample")
    ids = whole.select(F.col(row).alias("at"), F.col(f"`{id_col}`").alias("id"))
    scored = weigh(whole, target, id_col=row, text_col=text_col, **how).withColumnRenamed(row, "at")
    # the Gumbel number belongs to the document's own id
    score = F.col("weight") + _gumbel(how.get("seed", 2024), F.col("id"))
    scored = cut_lineage(scored.drop("score").join(ids, "at").select("id", "n_words", "weight", F.col("at").alias("row"), score.alias("score")))
    fit = scored.where(F.col("n_words") >= min_words)
    ranks = cut_lineage(_ranked(fit, percent * fit.count() // 100).withColumnRenamed("row", row))
    return whole.join(ranks, row).select(*(F.col(f"`{c}`") for c in cols), "rank")
