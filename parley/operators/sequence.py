"""Skew-safe ordered context within groups: previous-row values, running sums, text tails.

Several operators need "the previous segment of the same call" (silence gaps), "the running sum of
durations" (derived times) or "the last characters of the agent text said before this segment"
(phrases that cross a segment boundary). The textbook form is a window partitioned by the call,
which sends a whole call to one task: a call holding a third of all rows would become one task.

Here a group is split into contiguous *chunks* of the global (key, order) sort:

1. a sample of at most one million (key, order) structs, sorted by Spark, picks ``n - 1`` split
   points, with ``n`` growing with the row count so that no chunk holds more than about four
   million rows (a chunk is one window task);
2. each row finds its chunk by binary search in one constant ``array<struct>`` of split points (an
   ``aggregate`` over powers of two, log2(n) struct comparisons - the same NULL-first, NaN-last
   ordering as the window's sort), so a hot key is spread over many chunks and the expression size
   does not grow with ``n``; windows run per (key, chunk);
3. each chunk boundary cuts at most one key, so the "carry" table that feeds the first rows of a
   chunk with the state of the earlier chunks has at most ``n - 1`` rows: it is broadcast with that
   size bound, never the data.

Small inputs (below ``split_min_rows``) skip the sample and use one chunk per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def _right(c: Column, n: int) -> Column:
    return F.substring(c, -n, n)


_SAMPLE_CAP = 1_000_000


def _key_field(c: Column, dtype: str) -> Column:
    """A sort field as a JSON-safe comparable value with the same order (NULLs stay NULL):
    timestamps and dates as integer micros/days, everything else unchanged."""
    if dtype in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp"))
    if dtype == "date":
        return F.unix_date(c)
    return c


def sort_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """``struct(cols)`` with JSON-safe field types; Spark's struct ordering (NULLs first, NaN last,
    per field in turn) is the order of an ascending sort on ``cols``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return F.struct(*[_key_field(F.col(c), types[c]).alias(f"f{i}") for i, c in enumerate(cols)])


def _split_points(keyed: DataFrame, n_chunks: int, seed: int, total: int) -> list[tuple]:
    """n_chunks - 1 split keys from a sample of at most _SAMPLE_CAP keys, sorted by Spark itself
    (so NULL/NaN/collation order is exactly the window's); only the sample reaches the driver."""
    want = min(n_chunks * 64, _SAMPLE_CAP)
    frac = min(1.0, 1.5 * want / max(total, 1))
    pts = [tuple(r[0]) for r in keyed.select("_sk").sample(False, frac, seed).limit(2 * want)
           .orderBy("_sk").collect()]
    if len(pts) < 2:
        return []
    step = len(pts) / n_chunks
    out: list[tuple] = []
    for i in range(1, n_chunks):
        p = pts[min(len(pts) - 1, int(i * step))]
        if not out or p != out[-1]:
            out.append(p)
    return out


def chunk_column(key: Column, key_type: str, points: list[tuple]) -> Column:
    """Number of split keys <= ``key``: a binary search (``aggregate`` over powers of two) in one
    constant ``array<struct>`` (parsed once from JSON and folded to a literal), compared with
    Spark's struct ordering; the expression does not grow with the number of chunks."""
    if not points:
        return F.lit(0)
    import json as _json
    names = [f"f{i}" for i in range(len(points[0]))]
    doc = _json.dumps([dict(zip(names, p)) for p in points])
    arr = F.from_json(F.lit(doc), f"array<{key_type}>")
    n = len(points)
    steps = F.array(*[F.lit(1 << b) for b in range(n.bit_length(), -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda acc, st: F.when(
        (acc + st <= n) & (F.get(arr, acc + st - 1) <= key), acc + st).otherwise(acc))


def chunk_count(total: int, spark, split_min_rows: int = 2_000_000, rows_per_chunk: int = 4_000_000) -> int:
    """1 below ``split_min_rows`` rows; else enough chunks that none holds more than about
    ``rows_per_chunk`` rows (a chunk is one window task), and at least the shuffle partitions."""
    if total < split_min_rows:
        return 1
    return max(shuffle_partitions(spark), -(-total // rows_per_chunk))


def decide_chunks(df: DataFrame, split_min_rows: int = 2_000_000, rows_per_chunk: int = 4_000_000) -> int:
    """Chunk count for ``ordered_context`` from one count; compute once per job and pass it to every
    ``ordered_context`` over the same rows."""
    return chunk_count(df.count(), df.sparkSession, split_min_rows, rows_per_chunk)


def ordered_context(df: DataFrame, key: str, order: Sequence[str], *, lags: Sequence[str] = (),
                    sums: Sequence[str] = (), tail: str | None = None, tail_chars: int = 0,
                    chunks: int | None = None, split_min_rows: int = 2_000_000, per_chunk: int = 64,
                    seed: int = 17) -> DataFrame:  # per_chunk kept for callers; the sample is capped globally
    """Add ``prev_<c>`` (value of ``c`` on the previous row of the same key in ``order``), ``cum_<c>``
    (inclusive running sum) and ``prev_tail`` (last ``tail_chars`` characters of the previous rows'
    ``tail`` values joined by one space; null on a key's first row).

    ``chunks``: number of ranges to split the (key, order) space into; ``None`` = the shuffle
    partition count when the input has at least ``split_min_rows`` rows, else 1.
    """
    order = list(order)
    sort_cols = [key] + order
    if chunks is None:
        total = df.count()
        n = chunk_count(total, df.sparkSession, split_min_rows)
    else:
        n, total = chunks, None
    points: list[tuple] = []
    keyed = df
    if n > 1:
        keyed = df.withColumn("_sk", sort_key(df, sort_cols))
        if total is None:
            total = df.count()
        points = _split_points(keyed, n, seed, total)
    split = bool(points)

    if split:
        key_type = keyed.schema["_sk"].dataType.simpleString()
        base = keyed.withColumn("_chunk", chunk_column(F.col("_sk"), key_type, points)).drop("_sk")
    else:
        base = df.withColumn("_chunk", F.lit(0))
    if tail:
        base = base.withColumn("_tv", _right(F.coalesce(F.col(tail), F.lit("")), tail_chars))
    # unsplit: partition by the key alone, so a later groupBy/window on the key reuses the exchange
    w = (Window.partitionBy(key, "_chunk") if split else Window.partitionBy(key)).orderBy(*order)
    adds = [F.row_number().over(w).alias("_rn")]
    adds += [F.lag(c).over(w).alias(f"_l_{c}") for c in lags]
    adds += [F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"_c_{c}")
             for c in sums]
    if tail:
        adds.append(F.collect_list("_tv").over(w.rowsBetween(-(tail_chars + 1), -1)).alias("_pa"))
        if split:
            adds.append(_right(F.array_join(F.collect_list("_tv").over(w.rowsBetween(-tail_chars, 0)), " "),
                               tail_chars).alias("_it"))
    local = base.select("*", *adds)

    if tail:
        local_prev = F.when(F.size("_pa") > 0, _right(F.array_join("_pa", " "), tail_chars))

    if not split:
        out = local
        exprs = [F.col(f"_l_{c}").alias(f"prev_{c}") for c in lags]
        exprs += [F.col(f"_c_{c}").alias(f"cum_{c}") for c in sums]
        if tail:
            exprs.append(local_prev.alias("prev_tail"))
        drop = ["_chunk", "_rn", "_tv", "_pa"] + [f"_l_{c}" for c in lags] + [f"_c_{c}" for c in sums]
        return out.select("*", *exprs).drop(*drop)

    ordkey = F.struct(*[F.col(c) for c in order])
    aggs = [F.sum(c).alias(f"_s_{c}") for c in sums]
    if lags:
        aggs.append(F.max_by(F.struct(*[F.col(c).alias(c) for c in lags]), ordkey).alias("_last"))
    if tail:
        aggs.append(F.max_by("_it", ordkey).alias("_t"))
    summary = local.groupBy(key, "_chunk").agg(*aggs)
    ws = Window.partitionBy(key).orderBy("_chunk")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = [F.col(key), F.col("_chunk"), F.lag("_chunk").over(ws).alias("_pc")]
    carry_cols += [F.sum(f"_s_{c}").over(before).alias(f"_k_{c}") for c in sums]
    if lags:
        carry_cols.append(F.lag("_last").over(ws).alias("_klast"))
    if tail:
        carry_cols.append(_right(F.array_join(F.collect_list("_t").over(before), " "), tail_chars).alias("_ktail"))
    # At most one key straddles each of the len(points) split points, so this has <= len(points) rows.
    carry = summary.select(*carry_cols).where(F.col("_pc").isNotNull()).drop("_pc")
    # fresh names for the join keys: the carry table derives from ``local`` (a self-join)
    carry = carry.withColumnRenamed(key, "_ck").withColumnRenamed("_chunk", "_cc")
    j = local.join(F.broadcast(carry), (local[key] == carry["_ck"]) & (local["_chunk"] == carry["_cc"]), "left") \
        .drop("_ck", "_cc")

    first = F.col("_rn") == 1
    exprs = [F.when(first, F.col("_klast")[c]).otherwise(F.col(f"_l_{c}")).alias(f"prev_{c}") for c in lags]
    exprs += [(F.col(f"_c_{c}") + F.coalesce(F.col(f"_k_{c}"), F.lit(0))).alias(f"cum_{c}") for c in sums]
    if tail:
        exprs.append(
            F.when(first, F.col("_ktail"))
            .when((F.col("_rn") <= tail_chars + 1) & F.col("_ktail").isNotNull(),
                  _right(F.concat(F.col("_ktail"), F.lit(" "), F.array_join("_pa", " ")), tail_chars))
            .otherwise(local_prev).alias("prev_tail"))
    drop = ["_chunk", "_rn", "_tv", "_pa", "_it", "_klast", "_ktail"]
    drop += [f"_l_{c}" for c in lags] + [f"_c_{c}" for c in sums] + [f"_k_{c}" for c in sums]
    return j.select("*", *exprs).drop(*drop)
