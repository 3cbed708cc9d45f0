"""Operator 7: quality rules as a short-circuit cascade, built-in functions only.

Every rule rejects on a few figures of the text. ``estimate`` measures each rule's cost and selectivity
on a small random sample, ``order_rules`` puts the rules with the highest rejection per cost first, and
``cascade`` computes the figures of a rule only for rows that no earlier rule has rejected (each
figure stands behind a ``CASE`` guard). The order changes the work and which rule is named as the
rejecting one, never the verdict: a row is kept if no rule rejects it.

Figures (words are ``[^\\x20\\x09-\\x0D]+``):
n_words; word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``; n_upper: A-Z;
n_lines: \\n-split lines with a word; n_dup_lines: those equal to an earlier one; n_same: words equal to
the word before; n_repeat_words: words that lie in 8-word windows found twice or more in the text.
Words and windows are compared by 64-bit hashes (a collision inside one text is needed to err).

A filter over a figure would be pushed below the steps that compute it, each of them copied into the place
where it is used. Verdicts therefore pass through ``when(monotonically_increasing_id() >= 0, ...)``, always true, but not a
condition that Spark may move.

Defined results: a null text has no words and, like an empty one, all figures 0, so the word minimum
rejects it; repeated rows get equal verdicts; columns of ``docs`` are kept, the
added ones replace those of the same names.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import without

WINDOW = 8
#: partitions of the sample that ranks the rules
SAMPLE_PARTS = 8
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a SQL condition over figures; ``figures`` are those it needs."""

    name: str
    figures: tuple[str, ...]
    rejects: str


RULES: tuple[Rule, ...] = (
    Rule("few_words", ("n_words",), "n_words < 20"),
    Rule("symbols", ("n_words", "n_symbols"), "10 * n_symbols > n_words"),
    Rule("upper_case", ("word_chars", "n_upper"), "10 * n_upper > 3 * word_chars"),
    Rule("word_length", ("n_words", "word_chars"), "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), "2 * n_dup_lines > n_lines"),
    Rule("stutter", ("n_words", "n_same"), "10 * n_same > 3 * n_words"),
    Rule("repeated_windows", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 30 * n_words"),
)


def _count_of(chars: str) -> Column:
    return F.char_length("_text") - F.char_length(F.translate("_text", chars, ""))


def _window_keys() -> Column:
    n = F.size("_hash") - F.lit(WINDOW - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                     lambda i: F.xxhash64(F.slice("_hash", i, WINDOW))))


def _repeated_starts() -> Column:
    """Starts of windows whose key occurs again: in (key, start) order a neighbour has the same key."""
    near = F.filter("_pairs", lambda x, j: (x["k"] == F.get("_pairs", j - 1)["k"])
                    | (x["k"] == F.get("_pairs", j + 1)["k"]))
    return F.array_sort(F.transform(near, lambda x: x["i"]))


def _covered() -> Column:
    """Words under the union of the windows at the repeated starts."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate("_starts", start, lambda a, s: F.struct(
        (s + WINDOW).alias("end"), (a["n"] + s + WINDOW - F.greatest(a["end"], s)).alias("n")))["n"]


#: figure -> its steps in order; later steps may use earlier ones. Names with _ are working columns.
STEPS: dict[str, tuple[str, ...]] = {
    "n_words": ("_words", "n_words"),
    "word_chars": ("_words", "word_chars"),
    "n_symbols": ("n_symbols",),
    "n_upper": ("n_upper",),
    "n_lines": ("_lines", "n_lines"),
    "n_dup_lines": ("_lines", "n_dup_lines"),
    "n_same": ("_words", "_hash", "n_same"),
    "n_repeat_words": ("_words", "_hash", "_keys", "_pairs", "_starts", "n_repeat_words"),
}


def _step(name: str) -> Column:
    if name == "_words":
        return F.array_remove(F.split("_text", SPACE), "")
    if name == "n_words":
        return F.size("_words").cast("bigint")
    if name == "word_chars":
        return F.char_length(F.array_join("_words", "")).cast("bigint")
    if name == "n_symbols":
        return _count_of(SYMBOLS).cast("bigint")
    if name == "n_upper":
        return _count_of(UPPER).cast("bigint")
    if name == "_lines":
        return F.filter(F.split("_text", "\n"), lambda x: x.rlike(NOT_SPACE))
    if name == "n_lines":
        return F.size("_lines").cast("bigint")
    if name == "n_dup_lines":
        return (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")
    if name == "_hash":
        return F.transform("_words", lambda x: F.xxhash64(x))
    if name == "n_same":
        return F.size(F.filter("_hash", lambda x, i: x == F.get("_hash", i - 1))).cast("bigint")
    if name == "_keys":
        return _window_keys()
    if name == "_pairs":  # only texts with a repeated window are sorted
        return F.when(F.size(F.array_distinct("_keys")) < F.size("_keys"), F.array_sort(
            F.transform("_keys", lambda k, i: F.struct(k.alias("k"), i.alias("i")))))
    if name == "_starts":
        return F.when(F.col("_pairs").isNotNull(), _repeated_starts())
    if name == "n_repeat_words":
        return F.coalesce(_covered(), F.lit(0)).cast("bigint")
    raise KeyError(name)


def _with_figures(df: DataFrame, figures: Sequence[str], have: set[str], guard: Column | None) -> DataFrame:
    for figure in figures:
        for name in STEPS[figure]:
            if name not in have:
                have.add(name)
                value = _step(name)
                df = df.withColumn(name, value if guard is None else F.when(guard, value))
    return df


def _prepared(docs: DataFrame, text_col: str) -> DataFrame:
    """The whole input row under one name, so that no working column can clash with it."""
    return docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))


def _unpacked(df: DataFrame, docs: DataFrame, added: Sequence[str]) -> DataFrame:
    return df.select(*(F.col("_row")[c].alias(c) for c in without(docs, added)), *added)


def figures(docs: DataFrame, names: Sequence[str] = tuple(STEPS), text_col: str = "text") -> DataFrame:
    """Adds the named figures for every row."""
    return _unpacked(_with_figures(_prepared(docs, text_col), names, set(), None), docs, names)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
             sample_rows: int = 2000) -> dict[str, tuple[float, float]]:
    """(seconds a row, share rejected) of each rule alone, measured on about ``sample_rows`` rows.

    The sample, drawn at random from all partitions and dealt to a few, only ranks the rules.
    """
    every = docs.count()
    share = min(1.0, sample_rows / max(every, 1))
    sample = cut_lineage(docs.select(docs[text_col].alias("text")).sample(share, seed=7).repartition(SAMPLE_PARTS))
    rows = sample.count()
    if not rows:
        return {r.name: (1.0, 0.0) for r in rules}

    def seconds(df: DataFrame, condition: str) -> tuple[float, float]:
        began = time.perf_counter()
        n = df.agg(F.count_if(F.expr(condition)).alias("n")).first()["n"]
        return time.perf_counter() - began, n / rows

    floor = min(seconds(sample, "char_length(text) < 0")[0] for _ in range(2))
    out = {}
    for r in rules:
        t, share = min(seconds(figures(sample, r.figures), r.rejects) for _ in range(2))
        out[r.name] = (max(t - floor, 1e-3) / rows, share)
    return out


def order_rules(rules: Sequence[Rule], estimates: dict[str, tuple[float, float]]) -> list[Rule]:
    """Highest share rejected per second first; ties keep the given order."""
    return sorted(rules, key=lambda r: -estimates[r.name][1] / estimates[r.name][0])


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Adds ``rejected_by`` (the first rejecting rule in the given order, null for kept rows) and the
    figures in ``keep``, which are computed for every row."""
    df = _with_figures(_prepared(docs, text_col), keep, have := set(), None)
    df = df.withColumn("rejected_by", F.lit(None).cast("string"))
    for r in rules:
        open_ = F.col("rejected_by").isNull()
        df = _with_figures(df, r.figures, have, open_)
        df = df.withColumn("rejected_by", F.when(open_, F.when(F.expr(r.rejects), F.lit(r.name)))
                           .otherwise(F.col("rejected_by")))
    return _unpacked(df.withColumn("rejected_by", F.when(F.monotonically_increasing_id() >= 0, F.col("rejected_by"))), docs, [*keep, "rejected_by"])


def sieve(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects; each rule reads only what the ones before it have left."""
    df = _prepared(docs, text_col)
    for r in rules:
        df = _with_figures(df, r.figures, set(), None).withColumn("_stays", F.when(F.monotonically_increasing_id() >= 0, ~F.expr(r.rejects)))
        df = df.where("_stays").select("_row", "_text")
    return df.select("_row.*")


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = 2000) -> DataFrame:
    """``sieve`` in measured order."""
    return sieve(docs, order_rules(rules, estimate(docs, rules, text_col, sample_rows)), text_col)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", keep: Sequence[str] = (),
          sample_rows: int = 2000) -> DataFrame:
    """The cascade in measured order."""
    return cascade(docs, order_rules(rules, estimate(docs, rules, text_col, sample_rows)), text_col, keep)
