"""Call scoring by keyword/regex/silence rules (Q1-Q10, R1-R8), in long form.

Every rule is intra-call. Instead of collecting a call into one array (one task per call, fatal
for a call that holds a large share of the rows), the scorer

* adds per-segment context with the skew-safe ordered scan (previous segment end for silence
  gaps; the tail of the agent text said before each agent segment for phrases that cross a
  segment boundary in the joined agent text),
* reduces each call with partial aggregates (``bool_or``, ``min_by`` ... ``FILTER``, ``min``,
  ``max``) that combine map-side, so a hot call costs one row per task before the shuffle,
* evaluates the first-match-wins cascades as ``CASE`` expressions over the per-call row.

The agent text of a call (N12/N13: agent segments' texts, lower-cased, joined by one space) is never
built. A phrase in the joined agent text either lies inside one agent segment or crosses a boundary;
a crossing match of a pattern of at most ``L`` characters lies inside
``tail(L chars before the boundary) + ' ' + head(L chars after)``, which is what ``ctx`` holds. So
the keyword triggers are exact. Where the tail or the head is cut, ``ctx`` has an underscore, so that a cut
never looks like the end of a word. The regex triggers have no length limit; they are tested per segment,
on ``ctx``, and by their parts: an amount whose number ends one segment and whose unit begins the next, and a
visit whose day stands in an earlier segment than the technician (first and last place by partial
aggregates). What is left open: a line break between day and technician, which the pattern's ``.`` would
not cross, is not seen across segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import regex as rx
from ..functions.text import contains_any, digits_to_double, fmt_segment, py_float_str
from ..sources.lexicon import (DEFAULT_LEXICON, NO_AGENT_EVIDENCE, SILENCE_EVIDENCE_TEXT,
                               max_pattern_chars)
from .segments import ORDER, is_agent
from .sequence import decide_chunks, ordered_context

METRICS = ["KR2.1", "KR2.2", "KR2.3", "KR2.4", "KR2.5"]
METRIC_COLS = ["kr2_1", "kr2_2", "kr2_3", "kr2_4", "kr2_5"]

# ---------------------------------------------------------------------------------------------
# Reasoning texts attached to each outcome of the cascades.
# ---------------------------------------------------------------------------------------------
REASON = {
    "kr21_bad": "Fəal yardım zəifdir: müştəriyə çıxış yolu təqdim edilmir və ya yola vermə/PII sorğusu var.",
    "kr21_good": "Operator müştəriyə fəal kömək edir və uyğun həll/alternativ və ya konkret addım verir.",
    "kr21_weak": "Fəal kömək üçün kifayət qədər əlamət görünmür.",
    "kr22_good": "Operator tələbatı düzgün formalaşdırır və mahiyyət üzrə işləyir.",
    "kr22_partial": "Operator müəyyən dəqiqləşdirmə/yoxlama edir, amma tələbat tam formalaşmır.",
    "kr22_weak": "Tələbat formalaşdırılması zəifdir və ya görünmür.",
    "kr23_silence": "Uzun sükut/gözləmə zəngin operativliyini və nəticəyə çatdırılmasını pozur.",
    "kr23_fail": "Problemin həlli/nəticə verilmədən daxili məqamlar deyilir və ya çıxış yolu göstərilmir.",
    "kr23_paid": "Nəticə var, amma məlumat/izah minimaldır.",
    "kr23_good": "Operator nəticəni və ya həll addımlarını konkret və aydın təqdim edir.",
    "kr23_ticket": "Həll/nəticə zəifdir: yalnız ümumi qeyd (ticket) var, konkret çıxış yolu görünmür.",
    "kr23_unclear": "Həll/nəticə aydın deyil.",
    "kr24_good": "Operator problemi düzgün kanala yönləndirir və ya icra üçün konkret addım görür.",
    "kr24_partial": "Yönləndirmə/qeydiyyat qismən var (məs: ticket/ödəniş), amma tam deyil.",
    "kr24_weak": "Müraciət qeydə alınmır və ya müştəri yola verilir.",
    "kr25_bad": "Peşəkar etiket pozulub: daxili problemlər paylaşılır və/və ya CVV kimi həssas PII soruşulur.",
    "kr25_good": "Operator peşəkar davranır: salamlaşma/etiket və ya empatiya/PII qorunması var.",
    "kr25_weak": "Standart salamlaşma və etiket elementləri zəifdir və ya yoxdur.",
    "too_short": "Transkript çox qısadır (<0.1s), qiymətləndirmə mümkün deyil.",
}
# ---------------------------------------------------------------------------------------------

TRIGGER_LISTS = ["leak", "send_away", "hard_ask", "solution", "pii_warning", "empathy", "outcome_fail",
                 "paid", "ticket", "checking", "partial_registration"]
EVIDENCE_LISTS = ["kr21_bad_evidence", "outcome_fail", "paid", "ticket_evidence", "checking",
                  "partial_registration", "send_away", "kr25_bad_evidence", "kr25_good_evidence"]


def _result(score, prob: str, reason_key: str, ev: Column) -> Column:
    return F.struct(F.lit(score).cast("int").alias("score"), F.lit(prob).alias("probability"),
                    F.lit(REASON[reason_key]).alias("reasoning"), ev.alias("evidence_snippet"))


def segment_features(segments: DataFrame, lexicon: dict | None = None, role: str = "operator",
                     **seq_kw) -> DataFrame:
    """Per-segment columns the aggregation needs: agent flag, lower text, boundary context, prev end."""
    lex = lexicon or DEFAULT_LEXICON
    L = max_pattern_chars(lex) + 1
    seg = segments.select("call_id", "pos", "speaker", "text", "start", "end",
                          is_agent(role).alias("agent"), F.lower("text").alias("lt"))
    seg = seg.withColumn("number_open", F.col("agent") & F.col("lt").rlike(rx.J_AMOUNT_OPEN))
    agent_rows = ordered_context(seg.where("agent"), "call_id", ORDER, tail="lt", tail_chars=L, lags=["number_open"], **seq_kw)
    others = (seg.where(~F.col("agent")).withColumn("prev_tail", F.lit(None).cast("string"))
              .withColumn("prev_number_open", F.lit(None).cast("boolean")))
    both = agent_rows.unionByName(others)
    both = ordered_context(both, "call_id", ORDER, lags=["end"], **seq_kw)
    ctx = F.when(F.col("prev_tail").isNotNull(),
                 F.concat(F.when(F.length("prev_tail") >= L, "_").otherwise(""), F.col("prev_tail"), F.lit(" "),
                          F.substring("lt", 1, L), F.when(F.length("lt") > L, "_").otherwise("")))
    return both.withColumn("ctx", ctx)


def call_features(feats: DataFrame, lexicon: dict | None = None, gap_s: float = 60.0,
                  marker_regex: str = rx.J_SILENCE_MARKER, amount_regex: str = rx.J_AMOUNT,
                  visit_regex: str = rx.J_TECH_VISIT) -> DataFrame:
    """One row per call, all by partial aggregates (map-side combinable)."""
    lex = {**DEFAULT_LEXICON, **(lexicon or {})}
    agent = F.col("agent")
    lt, ctx = F.col("lt"), F.col("ctx")
    ordkey = F.struct(*[F.col(c) for c in ORDER])
    fmt = fmt_segment("start", "end", "speaker", "text")

    def trig(pats) -> Column:
        return agent & (contains_any(lt, pats) | F.coalesce(contains_any(ctx, pats), F.lit(False)))

    def first_fmt(pred: Column) -> Column:
        return F.min_by(F.when(pred, fmt), F.when(pred, ordkey))

    aggs = [F.bool_or(trig(lex[name])).alias(f"t_{name}") for name in TRIGGER_LISTS]
    regex_hit = (lt.rlike(amount_regex) | lt.rlike(visit_regex)
                 | F.coalesce(ctx.rlike(amount_regex) | ctx.rlike(visit_regex), F.lit(False))
                 | (F.coalesce(F.col("prev_number_open"), F.lit(False)) & lt.rlike(rx.J_AMOUNT_CLOSE)))
    day = agent & (lt.rlike(rx.J_VISIT_OPEN) | F.coalesce(ctx.rlike(rx.J_VISIT_OPEN), F.lit(False)))
    first_day = F.min(F.when(day, ordkey))
    last_visit = F.max(F.when(agent & lt.rlike(rx.J_VISIT_CLOSE), ordkey))
    aggs.append((F.bool_or(agent & regex_hit) | F.coalesce(first_day < last_visit, F.lit(False))).alias("t_solution_regex"))
    aggs += [first_fmt(agent & contains_any(lt, lex[name])).alias(f"e_{name}") for name in EVIDENCE_LISTS]
    sol_seg = (contains_any(lt, lex["solution"] + lex.get("solution_evidence_extra", []))
               | F.col("text").rlike(visit_regex))
    aggs.append(first_fmt(agent & sol_seg).alias("e_solution"))
    aggs.append(first_fmt(agent).alias("first_agent_fmt"))
    aggs.append(F.min_by(F.when(agent, lt), F.when(agent, ordkey)).alias("first_agent_lt"))
    aggs.append(F.bool_or(agent & contains_any(lt, lex["closing"])).alias("t_closing"))
    secs = F.regexp_extract(F.col("text"), marker_regex, 1)
    marker = (secs != "") & (digits_to_double(secs) >= gap_s)
    marker_ev = F.concat(F.lit("["), py_float_str("start"), F.lit("-"), py_float_str("end"), F.lit("] "),
                         F.col("text"))
    aggs.append(F.min_by(F.when(marker, marker_ev), F.when(marker, ordkey)).alias("e_marker"))
    gap = F.col("prev_end").isNotNull() & ((F.col("start") - F.col("prev_end")) >= gap_s)
    gap_ev = F.concat(F.lit("["), py_float_str("prev_end"), F.lit("-"), py_float_str("start"),
                      F.lit("] " + SILENCE_EVIDENCE_TEXT))
    aggs.append(F.min_by(F.when(gap, gap_ev), F.when(gap, ordkey)).alias("e_gap"))
    aggs.append((F.max("end") - F.min("start")).alias("duration_s"))
    return feats.groupBy("call_id").agg(*aggs)


def score_cascade(cf: DataFrame, lexicon: dict | None = None, min_duration: float = 0.1) -> DataFrame:
    """R1-R7 over per-call features: five result structs per call."""
    lex = {**DEFAULT_LEXICON, **(lexicon or {})}
    c = F.col
    fallback = F.coalesce(c("first_agent_fmt"), F.lit(NO_AGENT_EVIDENCE))
    first = F.coalesce(c("first_agent_lt"), F.lit(""))
    brand = contains_any(first, lex["brand"])
    if lex["brand_word"]:
        brand = brand | first.rlike("(?U)" + "|".join(rf"\b\Q{w}\E\b" for w in lex["brand_word"]))
    greeting = contains_any(first, lex["greeting"]) | (brand & contains_any(first, lex["invite"]))
    solution = c("t_solution") | c("t_solution_regex")

    kr21 = (F.when(c("t_leak") | c("t_send_away") | c("t_hard_ask"),
                   _result(1, "HIGH", "kr21_bad", F.coalesce(c("e_kr21_bad_evidence"), fallback)))
            .when(solution, _result(3, "HIGH", "kr21_good", F.coalesce(c("e_solution"), fallback)))
            .otherwise(_result(1, "LOW", "kr21_weak", fallback)))
    kr23 = (F.when(c("e_marker").isNotNull() | c("e_gap").isNotNull(),
                   _result(1, "HIGH", "kr23_silence", F.coalesce(c("e_marker"), c("e_gap"))))
            .when(c("t_outcome_fail"), _result(1, "HIGH", "kr23_fail", F.coalesce(c("e_outcome_fail"), fallback)))
            .when(c("t_paid"), _result(2, "HIGH", "kr23_paid", F.coalesce(c("e_paid"), fallback)))
            .when(solution, _result(3, "HIGH", "kr23_good", F.coalesce(c("e_solution"), fallback)))
            .when(c("t_ticket"), _result(1, "LOW", "kr23_ticket", F.coalesce(c("e_ticket_evidence"), fallback)))
            .otherwise(_result(1, "LOW", "kr23_unclear", fallback)))
    kr25 = (F.when(c("t_hard_ask") | c("t_leak"),
                   _result(0, "HIGH", "kr25_bad", F.coalesce(c("e_kr25_bad_evidence"), fallback)))
            .when(c("t_pii_warning") | c("t_empathy") | (greeting & c("t_closing")),
                  _result(3, "HIGH", "kr25_good", F.coalesce(c("e_kr25_good_evidence"), fallback)))
            .otherwise(_result(1, "HIGH", "kr25_weak", fallback)))
    base = cf.select("*", kr21.alias("kr2_1"), kr23.alias("kr2_3"), kr25.alias("kr2_5"))
    k1_three = c("kr2_1.score") == 3
    k1_ev = c("kr2_1.evidence_snippet")

    def hi_lo(ev: Column) -> Column:
        return F.when(ev.isNotNull(), F.lit("HIGH")).otherwise(F.lit("LOW"))

    def res(score, prob: Column, reason_key: str, ev: Column) -> Column:
        return F.struct(F.lit(score).cast("int").alias("score"), prob.alias("probability"),
                        F.lit(REASON[reason_key]).alias("reasoning"), ev.alias("evidence_snippet"))

    kr22 = (F.when(k1_three, res(3, F.lit("HIGH"), "kr22_good", k1_ev))
            .when(c("t_checking"), res(2, hi_lo(c("e_checking")), "kr22_partial", F.coalesce(c("e_checking"), k1_ev)))
            .otherwise(res(1, F.lit("HIGH"), "kr22_weak", k1_ev)))
    kr24 = (F.when(k1_three, res(3, F.lit("HIGH"), "kr24_good", k1_ev))
            .when(c("t_partial_registration"),
                  res(2, hi_lo(c("e_partial_registration")), "kr24_partial",
                      F.coalesce(c("e_partial_registration"), k1_ev)))
            .otherwise(res(1, F.lit("HIGH"), "kr24_weak", F.coalesce(c("e_send_away"), k1_ev))))
    dur = F.coalesce(c("duration_s"), F.lit(0.0))
    short = dur < min_duration
    zero = F.struct(F.lit(0).cast("int").alias("score"), F.lit("LOW").alias("probability"),
                    F.lit(REASON["too_short"]).alias("reasoning"), F.lit("").alias("evidence_snippet"))
    out = base.select(
        F.col("call_id").cast("string").alias("call_id"), dur.alias("duration_s"),
        *[F.when(short, zero).otherwise(e).alias(n)
          for n, e in [("kr2_1", c("kr2_1")), ("kr2_2", kr22), ("kr2_3", c("kr2_3")),
                       ("kr2_4", kr24), ("kr2_5", c("kr2_5"))]],
        F.lit(False).alias("llm_used"), F.lit(None).cast("string").alias("model"))
    return out


def score_calls(segments: DataFrame, lexicon: dict | None = None, role: str = "operator", gap_s: float = 60.0,
                min_duration: float = 0.1, calls: DataFrame | None = None, **seq_kw) -> DataFrame:
    """Wide result, one row per call: ``call_id, duration_s, kr2_1..kr2_5, llm_used, model``.

    ``calls`` (``call_id``) adds calls without any segment (they score as too short).
    """
    lex = {**DEFAULT_LEXICON, **(lexicon or {})}
    if "chunks" not in seq_kw:
        seq_kw["chunks"] = decide_chunks(segments, seq_kw.pop("split_min_rows", 2_000_000))
    feats = segment_features(segments, lex, role, **seq_kw)
    cf = call_features(feats, lex, gap_s)
    if calls is not None:
        cf = calls.select("call_id").distinct().join(cf, "call_id", "left")
    return score_cascade(cf, lex, min_duration)


def to_long(wide: DataFrame) -> DataFrame:
    """Unpivot the five result structs: ``call_id, metric, score, probability, reasoning, evidence_snippet``."""
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(cn).alias("r"))
                                for m, cn in zip(METRICS, METRIC_COLS)]))
    return (wide.select("call_id", stack.alias("x"))
            .select("call_id", F.col("x.metric").alias("metric"), F.col("x.r.score").alias("score"),
                    F.col("x.r.probability").alias("probability"), F.col("x.r.reasoning").alias("reasoning"),
                    F.col("x.r.evidence_snippet").alias("evidence_snippet")))


def results_json(wide: DataFrame, dataset_id: Column | None = None) -> DataFrame:
    """K4: response record ``{dataset_id?, call_id, results: {KR2.x: {...}}}`` as a JSON string column."""
    results = F.create_map(*[x for m, cn in zip(METRICS, METRIC_COLS) for x in (F.lit(m), F.col(cn))])
    body = F.struct((dataset_id if dataset_id is not None else F.lit(None).cast("string")).alias("dataset_id"),
                    F.col("call_id"), results.alias("results"))
    return wide.select("call_id", F.to_json(body).alias("json"))
