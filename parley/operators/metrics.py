"""Evaluation metrics as aggregates.

Everything reduces with partial aggregates (counts, sums) or equi-joins on keys; no metric collects a
group's rows. Exact percentiles come from counting passes, word edits from bit vectors inside the row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_ws
from .sequence import ordered_context
from .spans import LABELS, bio_to_spans
from .tokens import row_key


def accuracy(pred: DataFrame, expected: DataFrame, keys=("call_id", "metric"), value: str = "score") -> DataFrame:
    """M1: agreement per metric and overall in one ROLLUP pass.

    ``metric = 'ALL'`` is the overall row, rounded to 4 decimals as the report prints it;
    denominators are ``max(1, total)``.
    """
    j = pred.select(*keys, F.col(value).alias("pred")).join(expected.select(*keys, F.col(value).alias("exp")), list(keys))
    g = j.rollup("metric").agg(F.sum((F.col("pred") == F.col("exp")).cast("int")).alias("correct"),
                               F.count(F.lit(1)).alias("total"))
    acc = F.col("correct") / F.greatest(F.col("total"), F.lit(1))
    return g.select(F.coalesce("metric", F.lit("ALL")).alias("metric"), F.col("correct").cast("bigint").alias("correct"),
                    "total", F.when(F.col("metric").isNull(), F.round(acc, 4)).otherwise(F.round(acc, 6)).alias("accuracy"))


def mismatches(pred: DataFrame, expected: DataFrame, metric: str | None = None, max_rows: int = 50,
               keys=("call_id", "metric")) -> DataFrame:
    """M2: disagreeing (call, metric) rows with the prediction's evidence, optional metric filter, at most N."""
    j = pred.join(expected.select(*keys, F.col("score").alias("expected")), list(keys))
    j = j.where(F.col("score") != F.col("expected"))
    if metric:
        j = j.where(F.col("metric") == metric)
    return j.orderBy(*keys).limit(max_rows)


def macro_f1(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """M3: accuracy and macro-F1 over the union of label and prediction classes (F1 = 0 on 0/0)."""
    cm = df.groupBy(F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # each cell of the confusion table counts for the class of its label and for the class of its prediction
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(F.struct(F.col("y").alias("c"), F.col("n").alias("t"), F.lit(0).cast("long").alias("q"), hit.alias("tp")),
                    F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("t"), F.col("n").alias("q"), F.lit(0).cast("long").alias("tp")))
    per = cm.select(F.explode(sides).alias("x")).select("x.*").groupBy("c").agg(F.sum("t").alias("t"), F.sum("q").alias("q"), F.sum("tp").alias("tp"))
    f1 = F.when(F.col("t") + F.col("q") > 0, 2 * F.col("tp") / (F.col("t") + F.col("q"))).otherwise(0.0)
    return per.agg(F.round(F.sum("tp") / F.greatest(F.sum("t"), F.lit(1)), 6).alias("accuracy"),
                   F.round(F.avg(f1), 6).alias("macro_f1"), F.count(F.lit(1)).alias("n_classes"))


def entity_f1(gold: DataFrame, pred: DataFrame, tag_gold: str = "tag", tag_pred: str = "tag") -> DataFrame:
    """M4: micro entity precision/recall/F1 (exact type and span) and token accuracy, as one lazy plan.

    ``gold``/``pred``: the row key, ``ti, s, e, tag`` over the same tokens, ``ti`` counting them. Chunks follow the BIO
    rules of ``bio_to_spans``; a span that both sides hold is a true positive. The ``O`` tokens become their number in
    the task that reads them; only the others are shuffled, and a token that no side tags is one they agree on.
    """
    key = row_key(gold)
    plain = F.col("tag").eqNullSafe("O") & ~F.coalesce((F.col("s") == 0) & (F.col("e") == 0), F.lit(False))
    side = lambda df, tag, own: df.select(*key, "ti", "s", "e", F.col(tag).alias("tag"), F.lit(own).alias("own"))
    both = side(gold, tag_gold, 1).unionByName(side(pred, tag_pred, 2)).withColumn("plain", plain)
    few = both.groupBy("own", "plain", *(F.when(~F.col("plain"), F.col(c)).alias(c) for c in (*key, "ti", "s", "e", "tag"))).agg(F.count(F.lit(1)).alias("n"))
    few = few.where("n > 0")  # always so: both readers then ask for the same columns and share one exchange
    spans = bio_to_spans(few, sparse=True, by=("own",)).groupBy(*key, "label", "s", "e").agg(F.bit_or("own").alias("own"))
    none = F.lit(0).cast("long")
    found = spans.agg(F.count_if(F.col("own") == 3).alias("tp"), F.count_if(F.col("own") != 1).alias("n_pred"),
                      F.count_if(F.col("own") != 2).alias("n_gold"), none.alias("same"), none.alias("n_tokens"))
    of = lambda own: F.when(F.count_if(F.col("own") == own) == 0, F.lit("O")).otherwise(F.max(F.when(F.col("own") == own, F.col("tag"))))
    tok = few.groupBy(*key, "ti", "plain").agg(of(1).alias("g"), of(2).alias("p"),
                                               F.coalesce(F.sum(F.when(F.col("own") == 1, F.col("n"))), none).alias("n"))
    # a token that only ``pred`` tags is among the plain ones of ``gold``
    differ = ~F.col("plain") & ~F.coalesce(F.col("g") == F.col("p"), F.lit(False))
    tokens = tok.agg(none.alias("tp"), none.alias("n_pred"), none.alias("n_gold"), (F.sum("n") - F.count_if(differ)).alias("same"), F.sum("n").alias("n_tokens"))
    one = found.unionByName(tokens).agg(*(F.sum(c).alias(c) for c in ("tp", "n_pred", "n_gold", "same", "n_tokens")))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    one = one.withColumn("p", ratio(F.col("tp"), F.col("n_pred"))).withColumn("r", ratio(F.col("tp"), F.col("n_gold")))
    f = ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))
    return one.select("tp", "n_pred", "n_gold", F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"),
                      F.round(f, 6).alias("f1"), F.round(ratio(F.col("same"), F.col("n_tokens")), 6).alias("accuracy"))


def entity_f1_ids(rows: DataFrame, gold: str, pred: str, id_col: str = "row", labels: Sequence[str] = LABELS) -> DataFrame:
    """M4 on arrays of label ids: positions whose gold id is -100 are taken out of both sides first."""
    pairs = F.filter(F.arrays_zip(F.col(gold).alias("g"), F.col(pred).alias("p")), lambda x: x["g"] != -100)
    tok = rows.select(F.col(id_col).alias("row"), F.posexplode(pairs).alias("ti", "x"))
    name = F.array(*map(F.lit, labels))
    tok = tok.select("row", "ti", F.col("ti").alias("s"), (F.col("ti") + 1).alias("e"), F.get(name, F.col("x")["g"]).alias("gold"),
                     F.get(name, F.col("x")["p"]).alias("pred"))
    return entity_f1(tok, tok, "gold", "pred")


def _words(c: Column) -> Column:
    n = normalize_ws(c)
    return F.when(n == "", F.array().cast("array<string>")).otherwise(F.split(n, " "))


def _edits(ref: list[str], hyp: list[str]) -> int:
    """Edit distance of two lists of words by bit vectors: a bit for each place of ``ref``, one step for each word of
    ``hyp``. Words are compared as they are, so any number of distinct ones will do."""
    lo = 0
    while lo < len(ref) and lo < len(hyp) and ref[lo] == hyp[lo]:
        lo += 1
    a, b = len(ref), len(hyp)
    while a > lo and b > lo and ref[a - 1] == hyp[b - 1]:
        a, b = a - 1, b - 1
    ref, hyp = ref[lo:a], hyp[lo:b]
    common = set(ref).intersection(hyp)
    if not common:
        return max(len(ref), len(hyp))
    places: dict[str, list[int]] = {}
    for i, w in enumerate(ref):
        if w in common:
            places.setdefault(w, []).append(i)
    n = len(ref)
    full, top = (1 << n) - 1, 1 << (n - 1)
    # rises and falls of the distance from one place of ``ref`` to the next
    rise, fall, edits = full, 0, n
    for w in hyp:
        same = sum(1 << i for i in places[w]) if w in common else 0
        flat = (((same & rise) + rise) ^ rise) | same | fall
        up, down = fall | (full & ~(flat | rise)), flat & rise
        if up & top:
            edits += 1
        elif down & top:
            edits -= 1
        up, down = (up << 1 | 1) & full, (down << 1) & full
        rise, fall = down | (full & ~(flat | up)), up & flat
    return edits


def word_edits(pairs: DataFrame, ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """Adds ``edits`` (word-level edit distance) and ``ref_words`` (whitespace words, as WER splits)."""
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_edits(list(x), list(y)) for x, y in zip(a, b)], dtype="int64")

    edits = F.pandas_udf(distance, "bigint")
    x = pairs.withColumn("_rw", _words(F.coalesce(ref, F.lit("")))).withColumn("_hw", _words(F.coalesce(hyp, F.lit(""))))
    return x.withColumn("edits", edits("_rw", "_hw")).withColumn("ref_words", F.size("_rw").cast("long")).drop("_rw", "_hw")


def label_text(ids: Column, vocab: Sequence[str], pad_id: int = 0, word_delimiter: str = "|") -> Column:
    """M5: the text of label ids, -100 read as padding: tokens joined without grouping, padding left out, the word
    delimiter as a blank."""
    name = F.array(*map(F.lit, vocab))
    kept = F.filter(F.transform(ids, lambda i: F.when(i == -100, F.lit(pad_id)).otherwise(i)), lambda i: i != pad_id)
    return F.trim(F.replace(F.array_join(F.transform(kept, lambda i: F.get(name, i)), ""), F.lit(word_delimiter), F.lit(" ")))


def wer(pairs: DataFrame, ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """M5: corpus WER = total word edits / total reference words."""
    x = word_edits(pairs, ref, hyp)
    return x.agg(F.sum("edits").alias("edits"), F.sum("ref_words").alias("ref_words"),
                 F.count(F.lit(1)).alias("n_pairs")).select(
        "edits", "ref_words", "n_pairs", F.round(F.col("edits") / F.greatest(F.col("ref_words"), F.lit(1)), 6).alias("wer"))


def consecutive_pairs(df: DataFrame, key: str, order: list[str], text: str, **seq_kw) -> DataFrame:
    """(previous text, text) for consecutive rows of a group, via the skew-safe ordered scan."""
    x = ordered_context(df, key, order, lags=[text], **seq_kw)
    return x.where(F.col(f"prev_{text}").isNotNull()).select(key, *order, F.col(f"prev_{text}").alias("ref"),
                                                             F.col(text).alias("hyp"))


def latency_means(log: DataFrame, backend: str, order: list[str], value: str, warmup: int = 1) -> DataFrame:
    """M6: mean per backend over runs after the first ``warmup`` runs.

    The warm-up runs are found by a row number with a limit, which Spark applies within each task first, so each sends
    ``warmup`` rows a backend; the log itself is filtered by the last of them and only its sums are exchanged.
    """
    runs = log
    if warmup > 0:
        first = F.row_number().over(Window.partitionBy(backend).orderBy(*order))
        early = log.select(backend, *order).withColumn("_n", first).where(F.col("_n") <= warmup)
        last = early.groupBy(F.col(backend).alias("_b")).agg(F.max(F.struct(*order)).alias("_last"))
        runs = log.join(last, F.col(backend).eqNullSafe(F.col("_b")), "left").where(F.struct(*order) > F.col("_last"))
    return runs.groupBy(backend).agg(F.count(F.lit(1)).alias("n_runs"), F.round(F.avg(value), 6).alias("mean"))


def speedups(means: DataFrame, backend: str, baseline: str) -> DataFrame:
    """M8 (+L11): ratio of the baseline's mean to each backend's mean (``nullif`` guards zero), the
    report (one row a backend) sorted by mean latency."""
    base = F.max(F.when(F.col(backend) == baseline, F.col("mean"))).over(Window.partitionBy())
    return means.select(backend, "mean", F.round(base / F.nullif(F.col("mean"), F.lit(0.0)), 6).alias("speedup")).orderBy("mean")


def order_statistics(df: DataFrame, value: str, ranks: Sequence[int], parts: int = 2048) -> dict[int, float]:
    """The values at the given ranks (from 0) of the sorted finite values of a column.

    Every pass cuts the range that holds a rank into ``parts`` and counts, for all ranks at once, the rows in each, with
    the least and largest value there: at most ranks x parts rows reach the driver, no task holds more. The ends of a
    range fall into different parts, so each pass narrows it; most columns need two or three.
    """
    v = F.col(value).cast("double")
    base = df.select(v.alias("v")).where(~F.isnan("v") & (F.abs("v") < F.lit(math.inf)))
    lo, hi = base.agg(F.min("v"), F.max("v")).first()
    at = {r: (lo, hi, 0) for r in ranks}  # least and largest value of the part that holds the rank, rows below it
    while open_ := sorted({x for x in at.values() if x[0] < x[1]}):
        tags = []
        for i, (lo, hi, _) in enumerate(open_):
            width = hi / 2 - lo / 2  # halves do not overflow
            part = F.floor((F.col("v") / 2 - lo / 2) / F.lit(width) * parts) if width else F.when(F.col("v") > lo, parts).otherwise(0)
            tags.append(F.when(F.col("v").between(lo, hi), F.struct(F.lit(i).alias("i"), F.least(part.cast("int"), F.lit(parts - 1)).alias("part"))))
        rows = base.select("v", F.explode(F.array(*tags)).alias("t")).where("t is not null").groupBy("t.i", "t.part").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        for r, x in at.items():
            if x in open_:
                below = x[2]
                for row in sorted((row for row in rows if row["i"] == open_.index(x)), key=lambda row: row["part"]):
                    if r < below + row["n"]:
                        at[r] = row["lo"], row["hi"], below
                        break
                    below += row["n"]
    return {r: x[0] for r, x in at.items()}


def percentiles(df: DataFrame, value: str, shares: Sequence[float]) -> list[float | None]:
    """Exact percentiles by linear interpolation; null and NaN values are left out, infinite ones lie at the ends."""
    v = F.col(value).cast("double")
    low, n, high = df.agg(F.count_if(v == -math.inf), F.count_if(~F.isnan(v) & (F.abs(v) < math.inf)),
                          F.count_if((v == math.inf) & ~F.isnan(v))).first()
    total = low + n + high
    if not total:
        return [None] * len(shares)
    places = [(total - 1) * p for p in shares]
    need = sorted({r for x in places for r in (math.floor(x), math.ceil(x))})
    found = order_statistics(df, value, [r - low for r in need if low <= r < low + n]) if n else {}
    pick = lambda r: -math.inf if r < low else math.inf if r >= low + n else found[r - low]
    out = []
    for x in places:
        a, b = pick(math.floor(x)), pick(math.ceil(x))
        out.append(a if a == b else a + (b - a) * (x - math.floor(x)))
    return out


def load_summary(log: DataFrame, ts: str, latency: str, failed: Column) -> DataFrame:
    """M9: failure %, median, p95, mean latency and requests/s over the log's time range. Percentiles are exact (linear
    interpolation), found by ``order_statistics``."""
    secs = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    median, p95 = percentiles(log, latency, [0.5, 0.95])
    return log.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(100.0 * F.count_if(failed) / F.count(F.lit(1)), 6).alias("fail_pct"),
        F.round(F.lit(median).cast("double"), 6).alias("median"),
        F.round(F.lit(p95).cast("double"), 6).alias("p95"),
        F.round(F.avg(latency), 6).alias("mean"),
        F.round(F.count(F.lit(1)) / F.nullif(F.max(secs) - F.min(secs), F.lit(0.0)), 6).alias("rps"))


def conformance(long_scores: DataFrame, metrics=("KR2.1", "KR2.2", "KR2.3", "KR2.4", "KR2.5")) -> DataFrame:
    """Violations of the result contract: call id present, exactly the five metric keys per call,
    score in 0..3, probability HIGH/LOW."""
    per_call = long_scores.groupBy("call_id").agg(
        F.count_distinct("metric").alias("n_keys"), F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("metric").isin(*metrics)).alias("bad_keys"),
        F.count_if(~F.col("score").between(0, 3)).alias("bad_scores"),
        F.count_if(~F.col("probability").isin("HIGH", "LOW")).alias("bad_probs"))
    ok_keys = (F.col("n_keys") == len(metrics)) & (F.col("n_rows") == len(metrics)) & (F.col("bad_keys") == 0)
    return per_call.agg(F.count(F.lit(1)).alias("n_calls"),
                        F.count_if(~ok_keys).alias("bad_key_sets"),
                        F.count_if(F.col("call_id").isNull() | (F.col("call_id") == "")).alias("missing_call_id"),
                        F.sum("bad_scores").alias("score_out_of_range"),
                        F.sum("bad_probs").alias("bad_probability"))
