"""Transcript segments in long form (one row per segment) and per-call projections.

Canonical long layout: ``call_id STRING, pos INT, speaker STRING, text STRING, start DOUBLE, end DOUBLE``.
``pos`` is the input index; ordering is always ``(start, end, pos)`` so ties keep input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_or_broken
from .sequence import ordered_context

ORDER = ["start", "end", "pos"]


def derive_times(conversations: DataFrame, **seq_kw) -> DataFrame:
    """Timed segments for the ``conversations`` table, which has none (rule in FIXTURES):

    ``dur_ms = length(text)*60 + 500``, ``wait_ms = ((conv_id*7 + turn*13) % 90) * 1000``,
    ``end_ms`` = running sum of ``dur_ms + wait_ms`` by turn, ``start_ms = end_ms - dur_ms``.
    The running sum is a skew-safe ordered scan (a huge conversation is split into chunks).
    """
    d = conversations.select(
        "conv_id", "turn", "role", "text",
        (F.length("text") * 60 + 500).cast("bigint").alias("dur_ms"),
        ((((F.col("conv_id") * 7 + F.col("turn") * 13) % 90) * 1000).cast("bigint")).alias("wait_ms"),
    ).withColumn("step_ms", F.col("dur_ms") + F.col("wait_ms"))
    d = ordered_context(d, "conv_id", ["turn"], sums=["step_ms"], **seq_kw)
    return d.select(
        "conv_id", "turn", "role", "text",
        F.col("cum_step_ms").cast("bigint").alias("end_ms"),
        (F.col("cum_step_ms") - F.col("dur_ms")).cast("bigint").alias("start_ms"),
    )


def conversation_segments(conversations: DataFrame, numeric_id: bool = False, **seq_kw) -> DataFrame:
    """Long-form segments (seconds) from ``conversations``: ``call_id = string(conv_id)``, ``pos = turn``.

    ``numeric_id`` keeps ``call_id`` as the bigint ``conv_id``: the derived-times window is then
    already partitioned by the call key, and a scorer that casts at its output needs no re-shuffle.
    """
    t = derive_times(conversations, **seq_kw)
    cid = F.col("conv_id") if numeric_id else F.col("conv_id").cast("string")
    return t.select(
        cid.alias("call_id"),
        F.col("turn").cast("int").alias("pos"),
        F.col("role").alias("speaker"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        (F.col("start_ms") / 1000.0).alias("start"),
        (F.col("end_ms") / 1000.0).alias("end"),
    )


def segment_duration(start: Column | str = "start", end: Column | str = "end") -> Column:
    """``max(0, end - start)``."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.greatest(F.lit(0.0), e - s)


def is_agent(role: str = "operator", speaker: Column | str = "speaker") -> Column:
    """``role in speaker.lower()``."""
    sp = F.col(speaker) if isinstance(speaker, str) else speaker
    return F.lower(sp).contains(role.lower())


def call_profile(segments: DataFrame, role: str = "operator") -> DataFrame:
    """N7 + N9 + N10 per call: segment count, blank/broken count, agent count, duration
    (max end - min start) and the agent's talk time (sum of ``max(0, end - start)``)."""
    return segments.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.count_if(blank_or_broken("text")).alias("n_blank"),
        F.count_if(is_agent(role)).alias("n_agent"),
        (F.max("end") - F.min("start")).alias("duration_s"),
        F.round(F.sum(F.when(is_agent(role), segment_duration())), 6).alias("agent_talk_s"),
    )


def explode_calls(calls: DataFrame) -> DataFrame:
    """N11 nested -> long: ``calls(call_id, segments ARRAY<STRUCT>)`` to one row per segment."""
    return calls.select("call_id", F.inline("segments"))


def nest_calls(segments: DataFrame) -> DataFrame:
    """N11 long -> nested, sorted by (start, end, pos).

    Collects a whole call into one array: use only where calls are known to be bounded (an API
    payload, a sink format). The scoring operators never need it; they aggregate in long form.
    """
    s = F.struct(*[F.col(c) for c in ["start", "end", "pos", "speaker", "text"]])
    return segments.groupBy("call_id").agg(F.array_sort(F.collect_list(s)).alias("segments"))
