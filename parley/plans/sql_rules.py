"""DuckDB SQL text for the rule-scoring oracle, generated from the same lexicon.

Independent formulation: the agent text is joined with ``string_agg`` in (start, end, pos) order and
tested directly (no boundary context), silence gaps come from ``lag``; evidence from ordered ``first``.
"""

from __future__ import annotations

from ..operators.rules import REASON
from ..sources.lexicon import DEFAULT_LEXICON, NO_AGENT_EVIDENCE, SILENCE_EVIDENCE_TEXT

ORD = 'start, "end", pos'


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_in(expr: str, pats) -> str:
    pats = list(dict.fromkeys(p.lower() for p in pats))
    if not pats:
        return "FALSE"
    return "(" + " OR ".join(f"contains({expr}, {q(p)})" for p in pats) + ")"


FMT = "'[' || CAST(start AS VARCHAR) || '-' || CAST(\"end\" AS VARCHAR) || '] ' || speaker || ': ' || text"


def segments_sql(table: str = "conversations") -> str:
    return f"""
d AS (
  SELECT conv_id, turn, role, text,
         CAST(length(text) * 60 + 500 AS BIGINT) AS dur_ms,
         CAST(((conv_id * 7 + turn * 13) % 90) * 1000 AS BIGINT) AS wait_ms
  FROM {table}),
t AS (
  SELECT *, CAST(sum(dur_ms + wait_ms) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS end_ms FROM d),
seg AS (
  SELECT CAST(conv_id AS VARCHAR) AS call_id, CAST(turn AS INTEGER) AS pos, role AS speaker,
         coalesce(text, '') AS text,
         CAST(end_ms - dur_ms AS DOUBLE) / 1000.0 AS start, CAST(end_ms AS DOUBLE) / 1000.0 AS "end"
  FROM t)"""


def score_sql(lexicon: dict, role: str, gap_s: float = 60.0, min_duration: float = 0.1, long: bool = True) -> str:
    lex = {**DEFAULT_LEXICON, **lexicon}
    lt = "lower(text)"

    def ev(pats, extra: str = "") -> str:
        cond = any_in(lt, pats)
        if extra:
            cond = f"({cond} OR {extra})"
        return f"first({FMT} ORDER BY {ORD}) FILTER (WHERE agent AND {cond})"

    trig_lists = ["leak", "send_away", "hard_ask", "solution", "pii_warning", "empathy", "outcome_fail",
                  "paid", "ticket", "checking", "partial_registration"]
    trig_sql = ",\n    ".join(f"{any_in('j', lex[n])} AS t_{n}" for n in trig_lists)
    ev_lists = ["kr21_bad_evidence", "outcome_fail", "paid", "ticket_evidence", "checking",
                "partial_registration", "send_away", "kr25_bad_evidence", "kr25_good_evidence"]
    ev_sql = ",\n    ".join(f"{ev(lex[n])} AS e_{n}" for n in ev_lists)
    sol_ev = ev(lex["solution"] + lex.get("solution_evidence_extra", []),
                "regexp_matches(text, 'texnik\\s+gələcək|bu\\s+gün\\s+.*texnik', 'i')")
    brand_word = "|".join(lex["brand_word"])
    greeting = (f"({any_in('f', lex['greeting'])} OR (({any_in('f', lex['brand'])} OR "
                f"regexp_matches(f, '(^|[^\\pL\\pN_])({brand_word})([^\\pL\\pN_]|$)')) AND {any_in('f', lex['invite'])}))")
    fb = f"coalesce(first_agent_fmt, {q(NO_AGENT_EVIDENCE)})"
    solution = "(t_solution OR coalesce(regexp_matches(j, '\\b[0-9]+\\s*manat\\b') OR regexp_matches(j, 'texnik\\s+gələcək|bu\\s+gün\\s+.*texnik', 'i'), FALSE))"

    def r(score, prob, key, evx):
        return f"{{'score': CAST({score} AS INTEGER), 'probability': {prob}, 'reasoning': {q(REASON[key])}, 'evidence_snippet': {evx}}}"

    kr21 = f"""CASE WHEN t_leak OR t_send_away OR t_hard_ask THEN {r(1, "'HIGH'", 'kr21_bad', f'coalesce(e_kr21_bad_evidence, {fb})')}
      WHEN {solution} THEN {r(3, "'HIGH'", 'kr21_good', f'coalesce(e_solution, {fb})')}
      ELSE {r(1, "'LOW'", 'kr21_weak', fb)} END"""
    kr23 = f"""CASE WHEN e_marker IS NOT NULL OR e_gap IS NOT NULL THEN {r(1, "'HIGH'", 'kr23_silence', 'coalesce(e_marker, e_gap)')}
      WHEN t_outcome_fail THEN {r(1, "'HIGH'", 'kr23_fail', f'coalesce(e_outcome_fail, {fb})')}
      WHEN t_paid THEN {r(2, "'HIGH'", 'kr23_paid', f'coalesce(e_paid, {fb})')}
      WHEN {solution} THEN {r(3, "'HIGH'", 'kr23_good', f'coalesce(e_solution, {fb})')}
      WHEN t_ticket THEN {r(1, "'LOW'", 'kr23_ticket', f'coalesce(e_ticket_evidence, {fb})')}
      ELSE {r(1, "'LOW'", 'kr23_unclear', fb)} END"""
    kr25 = f"""CASE WHEN t_hard_ask OR t_leak THEN {r(0, "'HIGH'", 'kr25_bad', f'coalesce(e_kr25_bad_evidence, {fb})')}
      WHEN t_pii_warning OR t_empathy OR ({greeting} AND t_closing) THEN {r(3, "'HIGH'", 'kr25_good', f'coalesce(e_kr25_good_evidence, {fb})')}
      ELSE {r(1, "'HIGH'", 'kr25_weak', fb)} END"""
    kr22 = f"""CASE WHEN kr2_1.score = 3 THEN {r(3, "'HIGH'", 'kr22_good', 'kr2_1.evidence_snippet')}
      WHEN t_checking THEN {r(2, "CASE WHEN e_checking IS NULL THEN 'LOW' ELSE 'HIGH' END", 'kr22_partial', 'coalesce(e_checking, kr2_1.evidence_snippet)')}
      ELSE {r(1, "'HIGH'", 'kr22_weak', 'kr2_1.evidence_snippet')} END"""
    kr24 = f"""CASE WHEN kr2_1.score = 3 THEN {r(3, "'HIGH'", 'kr24_good', 'kr2_1.evidence_snippet')}
      WHEN t_partial_registration THEN {r(2, "CASE WHEN e_partial_registration IS NULL THEN 'LOW' ELSE 'HIGH' END", 'kr24_partial', 'coalesce(e_partial_registration, kr2_1.evidence_snippet)')}
      ELSE {r(1, "'HIGH'", 'kr24_weak', 'coalesce(e_send_away, kr2_1.evidence_snippet)')} END"""
    zero = r(0, "'LOW'", "too_short", "''")
    closing = any_in(lt, lex["closing"])
    sql = f"""
WITH {segments_sql()},
s AS (
  SELECT *, contains(lower(speaker), {q(role.lower())}) AS agent,
         lag("end") OVER (PARTITION BY call_id ORDER BY {ORD}) AS prev_end,
         regexp_extract(text, '\\[([0-9]+)\\s*saniyə\\s*sük[üu]t\\]', 1, 'i') AS secs
  FROM seg),
c AS (
  SELECT call_id,
    lower(string_agg(text, ' ' ORDER BY {ORD}) FILTER (WHERE agent)) AS j0,
    {ev_sql},
    {sol_ev} AS e_solution,
    first({FMT} ORDER BY {ORD}) FILTER (WHERE agent) AS first_agent_fmt,
    first(lower(text) ORDER BY {ORD}) FILTER (WHERE agent) AS first_agent_lt,
    coalesce(bool_or(agent AND {closing}), FALSE) AS t_closing,
    first('[' || CAST(start AS VARCHAR) || '-' || CAST("end" AS VARCHAR) || '] ' || text ORDER BY {ORD})
      FILTER (WHERE TRY_CAST(NULLIF(secs, '') AS DOUBLE) >= {gap_s}) AS e_marker,
    first('[' || CAST(prev_end AS VARCHAR) || '-' || CAST(start AS VARCHAR) || '] {SILENCE_EVIDENCE_TEXT}' ORDER BY {ORD})
      FILTER (WHERE start - prev_end >= {gap_s}) AS e_gap,
    max("end") - min(start) AS duration_s
  FROM s GROUP BY call_id),
c2 AS (
  SELECT *, coalesce(j0, '') AS j, coalesce(first_agent_lt, '') AS f FROM c),
c3 AS (
  SELECT *, {trig_sql} FROM c2),
w1 AS (
  SELECT *, {kr21} AS kr2_1, {kr23} AS kr2_3, {kr25} AS kr2_5 FROM c3),
w AS (
  SELECT call_id, coalesce(duration_s, 0.0) AS duration_s,
    CASE WHEN coalesce(duration_s, 0.0) < {min_duration} THEN {zero} ELSE kr2_1 END AS kr2_1,
    CASE WHEN coalesce(duration_s, 0.0) < {min_duration} THEN {zero} ELSE {kr22} END AS kr2_2,
    CASE WHEN coalesce(duration_s, 0.0) < {min_duration} THEN {zero} ELSE kr2_3 END AS kr2_3,
    CASE WHEN coalesce(duration_s, 0.0) < {min_duration} THEN {zero} ELSE {kr24} END AS kr2_4,
    CASE WHEN coalesce(duration_s, 0.0) < {min_duration} THEN {zero} ELSE kr2_5 END AS kr2_5
  FROM w1)"""
    if not long:
        return sql + "\nSELECT * FROM w"
    parts = []
    for m, cn in zip(["KR2.1", "KR2.2", "KR2.3", "KR2.4", "KR2.5"], ["kr2_1", "kr2_2", "kr2_3", "kr2_4", "kr2_5"]):
        parts.append(f"SELECT call_id, '{m}' AS metric, {cn}.score AS score, {cn}.probability AS probability, "
                     f"{cn}.reasoning AS reasoning, {cn}.evidence_snippet AS evidence_snippet FROM w")
    return sql + "\n" + "\nUNION ALL\n".join(parts)
