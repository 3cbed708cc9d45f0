"""Scoring calls that arrive whole (R1-R8 on the nested layout).

An API request or a complete-transcript payload already holds a whole call in one row. Such rows
are scored with array expressions only - no exchange, no window, no aggregate - and feed the same
cascade as the long-form scorer (``rules.score_cascade``). Here the joined agent text is built per
row, so keyword and regex triggers are tested on it directly (the long form needs boundary tails
because it never builds it).

Input: ``call_id, segments ARRAY<STRUCT<pos, speaker, text, start, end, ...>>`` sorted by
(start, end, pos), as ``sources.calls.normalize_payloads`` produces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import regex as rx
from ..functions.text import contains_any, digits_to_double, fmt_segment, py_float_str
from ..sources.lexicon import DEFAULT_LEXICON, SILENCE_EVIDENCE_TEXT
from .rules import EVIDENCE_LISTS, TRIGGER_LISTS, score_cascade


def _fmt(s: Column) -> Column:
    return fmt_segment(s["start"], s["end"], s["speaker"], s["text"])


def _has_any(pats):
    def pred(s: Column) -> Column:
        return contains_any(F.lower(s["text"]), pats)
    return pred


def nested_call_features(calls: DataFrame, lexicon: dict | None = None, role: str = "operator",
                         gap_s: float = 60.0, marker_regex: str = rx.J_SILENCE_MARKER,
                         amount_regex: str = rx.J_AMOUNT, visit_regex: str = rx.J_TECH_VISIT) -> DataFrame:
    """The per-call feature row of ``rules.call_features``, computed inside each row."""
    lex = {**DEFAULT_LEXICON, **(lexicon or {})}
    segs = F.col("segments")
    # stage the agent array and the joined agent text as columns (lambdas get no CSE)
    x = calls.select("call_id", "segments",
                     F.filter(segs, lambda s: F.lower(s["speaker"]).contains(role.lower())).alias("_agent"))
    x = x.withColumn("_j", F.lower(F.array_join(F.transform("_agent", lambda s: s["text"]), " ")))
    agent, j = F.col("_agent"), F.col("_j")

    def first_fmt(arr: Column, pred) -> Column:
        hit = F.get(F.filter(arr, pred), 0)
        return F.when(hit.isNotNull(), _fmt(hit))

    cols = [F.col("call_id")]
    cols += [contains_any(j, lex[name]).alias(f"t_{name}") for name in TRIGGER_LISTS]
    cols.append((j.rlike(amount_regex) | j.rlike(visit_regex)).alias("t_solution_regex"))
    cols += [first_fmt(agent, _has_any(lex[name])).alias(f"e_{name}") for name in EVIDENCE_LISTS]
    sol = lex["solution"] + lex.get("solution_evidence_extra", [])
    cols.append(first_fmt(agent, lambda s: contains_any(F.lower(s["text"]), sol) | s["text"].rlike(visit_regex))
                .alias("e_solution"))
    first = F.get(agent, 0)
    cols.append(F.when(first.isNotNull(), _fmt(first)).alias("first_agent_fmt"))
    cols.append(F.lower(first["text"]).alias("first_agent_lt"))
    cols.append(F.exists(agent, lambda s: contains_any(F.lower(s["text"]), lex["closing"])).alias("t_closing"))

    def marker(s: Column) -> Column:
        secs = F.regexp_extract(s["text"], marker_regex, 1)
        return (secs != "") & (digits_to_double(secs) >= gap_s)
    mk = F.get(F.filter(segs, marker), 0)
    cols.append(F.when(mk.isNotNull(), F.concat(F.lit("["), py_float_str(mk["start"]), F.lit("-"),
                                                py_float_str(mk["end"]), F.lit("] "), mk["text"])).alias("e_marker"))
    n = F.size(segs)
    pairs = F.when(n >= 2, F.zip_with(F.slice(segs, 1, F.greatest(n - 1, F.lit(1))),
                                      F.slice(segs, 2, F.greatest(n - 1, F.lit(1))),
                                      lambda a, b: F.struct(a["end"].alias("a"), b["start"].alias("b"))))
    gp = F.get(F.filter(pairs, lambda p: (p["b"] - p["a"]) >= gap_s), 0)
    cols.append(F.when(gp.isNotNull(), F.concat(F.lit("["), py_float_str(gp["a"]), F.lit("-"), py_float_str(gp["b"]),
                                                F.lit("] " + SILENCE_EVIDENCE_TEXT))).alias("e_gap"))
    cols.append((F.array_max(F.transform(segs, lambda s: s["end"]))
                 - F.array_min(F.transform(segs, lambda s: s["start"]))).alias("duration_s"))
    return x.select(*cols)


def score_nested(calls: DataFrame, lexicon: dict | None = None, role: str = "operator", gap_s: float = 60.0,
                 min_duration: float = 0.1) -> DataFrame:
    """R6-R8 on whole-call rows: same wide result as ``rules.score_calls``, with no shuffle."""
    lex = {**DEFAULT_LEXICON, **(lexicon or {})}
    return score_cascade(nested_call_features(calls, lex, role, gap_s), lex, min_duration)
