"""DuckDB oracle SQL per registered query (same tables, pre-registered as views)."""

from __future__ import annotations

from . import sql_rules
from . import sql_text as st
from ..operators.models import linear_head_weights
from ..sources.lexicon import TEST_LEXICON
from .sql_text import RE2, UW, UWS, ascii_view, count_of, has, norm_ws, q, spans_list

AGENT_ROLE = "assistant"

ORACLE: dict[str, str] = {}

ORACLE["r6_score_calls"] = sql_rules.score_sql(TEST_LEXICON, AGENT_ROLE)
ORACLE["m1_score_distribution"] = f"""
WITH sc AS ({sql_rules.score_sql(TEST_LEXICON, AGENT_ROLE)})
SELECT coalesce(metric, 'ALL') AS metric, coalesce(score, -1) AS score, count(*) AS n_calls
FROM sc GROUP BY ROLLUP (metric, score)
HAVING metric IS NOT NULL OR score IS NULL
"""

# ------------------------------------------------------------------ text scans and normalisation

ORACLE["s9_profile_documents"] = """
SELECT 'doc_id,text,lang,source,n_chars' AS columns, count(*) AS n_rows,
       arg_min(substr(text, 1, 250), doc_id) AS preview
FROM documents"""

_strip = lambda c: f"regexp_replace({c}, '^[{UWS}]+|[{UWS}]+$', '', 'g')"
ORACLE["s5_first_text_pages"] = f"""
SELECT page_id, coalesce(CASE WHEN {_strip('url')} <> '' THEN url END,
                         CASE WHEN {_strip('html')} <> '' THEN html END) AS text
FROM pages"""

ORACLE["n15_normalize_ws"] = f"SELECT doc_id, {norm_ws('text')} AS text_norm FROM documents"


def _sentences_sql(enders: str, lo: int, hi: int) -> str:
    return f"""
WITH n AS (SELECT doc_id, {norm_ws('text')} AS t FROM documents),
p AS (SELECT doc_id, string_split(regexp_replace(t, '([{enders}]) ', '\\1' || chr(1), 'g'), chr(1)) AS parts
      FROM n WHERE t <> ''),
u AS (SELECT doc_id, unnest(parts) AS sentence, generate_subscripts(parts, 1) - 1 AS sent_no FROM p)
SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, sentence FROM u
WHERE length(sentence) BETWEEN {max(lo, 1)} AND {hi}"""


ORACLE["n16_sentences"] = _sentences_sql(".!?", 25, 280)
ORACLE["n17_sentences_ellipsis"] = _sentences_sql(".!?…", 10, 240)

# ------------------------------------------------------------------ PII detection and redaction
_A = ascii_view("text")


def _explode_values(list_sql: str) -> str:
    return f"""
WITH v AS (SELECT doc_id, {list_sql} AS vals FROM documents)
SELECT doc_id, CAST(generate_subscripts(vals, 1) - 1 AS INTEGER) AS idx, unnest(vals) AS value FROM v"""


ORACLE["d1_card_numbers"] = _explode_values(f"regexp_extract_all({_A}, {q(RE2['card'])})")
ORACLE["d2_fin_codes"] = f"""
WITH x AS (SELECT doc_id, CAST({count_of('text', 'fin')} AS BIGINT) AS n_fin, {has('text', 'fin7')} AS has_fin7,
                  CAST({count_of('text', 'fin_digit_first')} AS BIGINT) AS n_fin_digit_first FROM documents)
SELECT doc_id, CAST(n_fin AS INTEGER) AS n_fin, has_fin7, CAST(n_fin_digit_first AS INTEGER) AS n_fin_digit_first
FROM x WHERE n_fin > 0 OR has_fin7 OR n_fin_digit_first > 0"""
ORACLE["d3_cvv_by_lang"] = f"""
SELECT lang, CAST(count(*) FILTER (WHERE {count_of('text', 'cvv')} > 0) AS BIGINT) AS n_docs_cvv,
       CAST(sum({count_of('text', 'cvv')}) AS BIGINT) AS n_cvv, count(*) AS n_docs
FROM documents GROUP BY lang"""
ORACLE["d4_phones"] = f"""
WITH x AS (SELECT doc_id, {count_of('text', 'phone')} AS n_phone, {count_of('text', 'phone_strict')} AS n_phone_strict
           FROM documents)
SELECT doc_id, CAST(n_phone AS INTEGER) AS n_phone, CAST(n_phone_strict AS INTEGER) AS n_phone_strict FROM x
WHERE n_phone > 0 OR n_phone_strict > 0"""
_email_vals = (f"list_transform(range(1, len(regexp_extract_all({_A}, {q(RE2['email'])})) + 1), lambda i: "
               f"substr(text, ({spans_list('text', 'email', 'E')})[i].s + 1, "
               f"({spans_list('text', 'email', 'E')})[i].e - ({spans_list('text', 'email', 'E')})[i].s))")
ORACLE["d5_emails"] = _explode_values(_email_vals)


def _looks(kinds) -> str:
    return "(" + " OR ".join(has("text", k) for k in kinds) + ")"


ORACLE["d6_looks_like_pii"] = f"""
SELECT lang, count(*) AS n_docs,
       count(*) FILTER (WHERE {_looks(['email', 'phone', 'card', 'fin7'])}) AS n_corpus_variant,
       count(*) FILTER (WHERE {_looks(['fin_digit_first', 'phone_strict', 'card'])}) AS n_explore_variant
FROM documents GROUP BY lang"""
_find = (f"list_concat(list_transform(regexp_extract_all({_A}, {q(RE2['card'])}), lambda v: {{'kind': 'card_number', 'value': v}}), "
         f"list_transform(regexp_extract_all({_A}, {q(RE2['fin'])}, 1), lambda v: {{'kind': 'fin_code', 'value': v}}), "
         f"list_transform(regexp_extract_all({_A}, {q(RE2['cvv'])}), lambda v: {{'kind': 'cvv_mention', 'value': v}}))")
ORACLE["d7_find_pii"] = f"""
WITH v AS (SELECT doc_id, {_find} AS f FROM documents),
u AS (SELECT doc_id, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS idx, unnest(f) AS x FROM v)
SELECT doc_id, idx, x.kind AS kind, x.value AS value FROM u"""
ORACLE["d8_redact"] = f"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, {q(RE2['card'])}, '[CARD_NUMBER]', 'g'),
               {q(RE2['num34'])}, '[NUM]', 'g'), '(?i)\\b([0-9][A-Z0-9]{{6,8}})\\b', '[FIN_CODE]', 'g') AS redacted
FROM documents"""
_conv_hit = "(" + " OR ".join(has("text", k) for k in ["card", "fin", "cvv"]) + ")"
ORACLE["d9_conversation_pii"] = f"""
SELECT conv_id, count(*) FILTER (WHERE {_conv_hit}) AS n_turns_pii, bool_or({_conv_hit}) AS any_pii
FROM conversations GROUP BY conv_id"""

# ------------------------------------------------------------------ tokens, BIO, spans, masking
_PIECES = f"[{UW}]+|[^{UW}{UWS}]|[{UWS}]+"
TOKENS_CTE = f"""
tp AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {q(_PIECES)}) AS pieces FROM documents),
tu AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pi FROM tp),
tw AS (SELECT doc_id, pi, piece, NOT regexp_matches(piece, {q('^[' + UWS + ']')}) AS is_tok,
              coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pi
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0
       FROM tu),
tok AS (SELECT doc_id, CAST(sum(CASE WHEN is_tok THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pi
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS INTEGER) AS ti,
               piece AS token, CAST(s0 AS INTEGER) AS s, CAST(s0 + length(piece) AS INTEGER) AS e, is_tok
        FROM tw)"""
def _entities_cte(p: str, dets: list[tuple[str, str]]) -> str:
    """Entities per document: the pieces between matches and the matches alternate, so a match begins
    where the running lengths of the earlier ones end (once per match, nothing is searched again)."""
    found = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS det, '{label}' AS label, unnest(m) AS m, unnest(g[1:len(m)]) AS g, generate_subscripts(m, 1) AS k "
        f"FROM (SELECT doc_id, regexp_extract_all(a, {q(RE2[kind])}) AS m, string_split_regex(a, {q(RE2[kind])}) AS g FROM {p}av)"
        for i, (kind, label) in enumerate(dets))
    return f"""
{p}av AS MATERIALIZED (SELECT doc_id, {ascii_view('text')} AS a FROM documents),
{p}el AS ({found}),
{p}eu AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY doc_id, det ORDER BY k) AS upto FROM {p}el),
{p}en AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY det, k) AS eo, upper(label) AS label,
                 CAST(upto - length(m) AS INTEGER) AS ns, CAST(upto AS INTEGER) AS ne FROM {p}eu)"""


ENTS_CTE = _entities_cte("", [("card", "CARD"), ("phone_strict", "PHONE"), ("fin7", "FIN")])
# tokens and entities listed once for each block of 64 characters, met in the block where the overlap begins
_PAIRS = """
{p}tb AS (SELECT t.doc_id, ti, s, e, unnest(range(s // 64, (e - 1) // 64 + 1)) AS blk FROM tok t
       WHERE is_tok AND t.doc_id IN (SELECT doc_id FROM {p}en)),
{p}nb AS (SELECT *, unnest(range(ns // 64, greatest(ne - 1, ns) // 64 + 1)) AS blk FROM {p}en),
{p}pr AS (SELECT t.doc_id, t.ti, n.eo, n.label, n.ns, n.ne FROM {p}tb t JOIN {p}nb n ON t.doc_id = n.doc_id AND t.blk = n.blk
       WHERE t.e > n.ns AND t.s < n.ne AND t.blk = greatest(t.s, n.ns) // 64)"""
TAGS_CTE = f"""{TOKENS_CTE},{ENTS_CTE},{_PAIRS.format(p="")},
pf AS (SELECT *, min(ti) OVER (PARTITION BY doc_id, eo) AS first_ti,
              row_number() OVER (PARTITION BY doc_id, ti ORDER BY ns DESC, ne DESC, eo DESC) AS rk FROM pr),
tg AS (SELECT t.doc_id, t.ti, t.token, t.s, t.e,
              coalesce(CASE WHEN p.ti = p.first_ti THEN 'B-' ELSE 'I-' END || p.label, 'O') AS tag
       FROM tok t LEFT JOIN (SELECT * FROM pf WHERE rk = 1) p ON t.doc_id = p.doc_id AND t.ti = p.ti
       WHERE t.is_tok)"""
SPANS_CTE = f"""{TAGS_CTE},
sx AS (SELECT doc_id, ti, s, e, tag, CASE WHEN tag LIKE 'B-%' OR tag LIKE 'I-%' THEN substr(tag, 3) END AS typ
       FROM tg WHERE NOT (s = 0 AND e = 0)),
sy AS (SELECT *, CASE WHEN typ IS NOT NULL AND (tag LIKE 'B-%' OR lag(typ) OVER w IS NULL OR lag(typ) OVER w <> typ)
                      THEN 1 ELSE 0 END AS st FROM sx WINDOW w AS (PARTITION BY doc_id ORDER BY ti)),
sz AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY ti ROWS UNBOUNDED PRECEDING) AS span_no FROM sy),
sp AS (SELECT doc_id, first(typ) AS label, arg_min(s, ti) AS s, arg_max(e, ti) AS e
       FROM sz WHERE typ IS NOT NULL GROUP BY doc_id, span_no)"""
MERGED_CTE = f"""{SPANS_CTE},
m1 AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e, label
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM sp),
m2 AS (SELECT *, CASE WHEN pm IS NULL OR s > pm + 1 THEN 1 ELSE 0 END AS nw FROM m1),
m3 AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY s, e, label ROWS UNBOUNDED PRECEDING) AS grp FROM m2),
mg AS (SELECT doc_id, CASE WHEN count(DISTINCT label) > 1 THEN 'PII' ELSE first(label) END AS label,
              min(s) AS s, max(e) AS e FROM m3 GROUP BY doc_id, grp)"""
MASK_CTE = f"""{MERGED_CTE},
mk1 AS (SELECT m.*, coalesce(lag(m.e) OVER (PARTITION BY m.doc_id ORDER BY m.s, m.e), 0) AS pe, d.text
        FROM mg m JOIN documents d ON m.doc_id = d.doc_id),
mk AS (SELECT doc_id, regexp_replace(string_agg(CASE WHEN s > pe THEN substr(text, pe + 1, s - pe) ELSE '' END || '****', ''
                                                ORDER BY s, e) || substr(max(text), arg_max(e, s) + 1),
                                     '\\*{{4,}}', '****', 'g') AS masked_text,
              CAST(count(*) AS INTEGER) AS n_entities
       FROM mk1 GROUP BY doc_id)"""

ORACLE["b1_tokens"] = f"WITH {TOKENS_CTE}\nSELECT doc_id, ti, token, s, e FROM tok WHERE is_tok"
ORACLE["b3_bio_tags"] = f"WITH {TAGS_CTE}\nSELECT doc_id, ti, token, tag FROM tg"
ORACLE["d13_bio_spans"] = f"WITH {SPANS_CTE}\nSELECT doc_id, label, s, e FROM sp"
ORACLE["d14_merged_spans"] = f"WITH {MERGED_CTE}\nSELECT doc_id, label, s, e FROM mg"
ORACLE["d15_masked_documents"] = f"""WITH {MASK_CTE}
SELECT d.doc_id, coalesce(mk.masked_text, d.text, '') AS masked_text, coalesce(n_entities, 0) AS n_entities
FROM documents d LEFT JOIN mk ON d.doc_id = mk.doc_id"""
ORACLE["g4_person_names"] = f"""WITH {TOKENS_CTE},
nm AS (SELECT DISTINCT list_filter(regexp_extract_all(lower(array_to_string((string_split({norm_ws('text')}, ' '))[1:3], ' ')), {q(_PIECES)}),
                                   lambda p: NOT regexp_matches(p, {q('^[' + UWS + ']')})) AS ps FROM benchmark),
n AS (SELECT ps AS name, len(ps) AS size, unnest(ps) AS token, generate_subscripts(ps, 1) - 1 AS k FROM nm WHERE len(ps) > 0),
m AS (SELECT t.doc_id, n.name, n.size, t.ti - n.k AS i FROM tok t JOIN n ON t.is_tok AND lower(t.token) = n.token
      GROUP BY t.doc_id, n.name, n.size, t.ti - n.k HAVING count(*) = n.size),
o AS (SELECT doc_id, i, max(size) AS size FROM m GROUP BY doc_id, i),
h AS (SELECT o.*, a.s, b.e FROM o JOIN tok a ON a.is_tok AND a.doc_id = o.doc_id AND a.ti = o.i
      JOIN tok b ON b.is_tok AND b.doc_id = o.doc_id AND b.ti = o.i + o.size - 1),
u AS (SELECT *, max(i + size) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM h)
SELECT doc_id, 'PERSON' AS label, s, e FROM u WHERE upto IS NULL OR i >= upto"""
_hits = "(" + " + ".join(count_of("text", k) for k in ["card", "phone_strict", "fin7", "email"]) + ")"
ORACLE["d16_cascade"] = f"""WITH {MASK_CTE},
sc AS (SELECT doc_id, text, CAST({_hits} AS DOUBLE) - 0.5 AS l1 FROM documents),
p AS (SELECT doc_id, text, exp(l1 - greatest(0.0, l1)) / (exp(0.0 - greatest(0.0, l1)) + exp(l1 - greatest(0.0, l1))) AS pr
      FROM sc)
SELECT p.doc_id, p.pr >= 0.5 AS is_unsafe, round(p.pr, 6) AS guardrail_score,
       CASE WHEN p.pr >= 0.5 THEN coalesce(mk.masked_text, p.text) ELSE p.text END AS masked_text
FROM p LEFT JOIN mk ON p.doc_id = mk.doc_id"""

# ------------------------------------------------------------------ corpus: samples, quotas, splits


def _md5(expr: str, seed: int) -> str:
    return f"md5(CAST({expr} AS VARCHAR) || '#{seed}')"


def _looks_corpus(t: str) -> str:
    return "(" + " OR ".join(st.has(t, k) for k in ["email", "phone", "card", "fin7"]) + ")"


def _sent_cte(src: str) -> str:
    return f"""
sn AS (SELECT doc_id, {st.norm_ws('text')} AS t FROM {src}),
sp_ AS (SELECT doc_id, string_split(regexp_replace(t, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM sn WHERE t <> ''),
su AS (SELECT doc_id, unnest(parts) AS sentence, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS sent_no FROM sp_),
sents AS (SELECT * FROM su WHERE length(sentence) BETWEEN 25 AND 280)"""


ORACLE["l1_non_blank_texts"] = f"""
SELECT doc_id, text FROM (SELECT doc_id, {st.norm_ws('text')} AS text FROM documents) WHERE text <> ''"""
ORACLE["l2_sample_exact"] = f"SELECT doc_id, lang FROM documents ORDER BY {_md5('doc_id', 42)} LIMIT 100"
ORACLE["l3_sentence_quota"] = f"""
WITH ld AS (SELECT d.doc_id, d.text, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
safe AS (SELECT doc_id, text FROM ld WHERE toxic = 0), {_sent_cte('safe')},
r AS (SELECT *, row_number() OVER (ORDER BY doc_id, sent_no) AS rn FROM sents)
SELECT doc_id, sent_no, sentence FROM r WHERE rn <= (SELECT count(*) FROM ld WHERE toxic = 1)"""
ORACLE["l6_split_exact"] = f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_md5('doc_id', 42)}) AS rn, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN rn <= greatest(1, floor(n * 0.1)) THEN 'validation' ELSE 'train' END AS split FROM r"""
ORACLE["l8_split_bucket"] = f"""
SELECT doc_id, CASE WHEN (('0x' || substr({_md5('doc_id', 42)}, 1, 15))::BIGINT % 10000) < 1000 THEN 'test' ELSE 'train' END AS split
FROM documents"""
ORACLE["l9_subset_overlap"] = f"""
WITH n AS (SELECT count(*) AS n FROM documents),
k AS (SELECT greatest(50, CAST(floor(n * 0.1) AS BIGINT)) AS kt, greatest(20, CAST(floor(n * 0.05) AS BIGINT)) AS ke FROM n),
tr AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {_md5('doc_id', 42)}) AS rn FROM documents)
       WHERE rn <= (SELECT kt FROM k)),
ev AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {_md5('doc_id', 123)}) AS rn FROM documents)
       WHERE rn <= (SELECT ke FROM k))
SELECT (SELECT kt FROM k) AS n_train, (SELECT ke FROM k) AS n_eval,
       (SELECT count(*) FROM ev WHERE doc_id IN (SELECT doc_id FROM tr)) AS n_overlap,
       (SELECT count(*) FROM ev WHERE doc_id NOT IN (SELECT doc_id FROM tr)) AS n_eval_disjoint"""
CORPUS_CTE = f"""
ld AS (SELECT d.doc_id, d.text, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
u AS (SELECT doc_id AS key, {st.norm_ws('text')} AS text FROM ld WHERE toxic = 1),
u2 AS (SELECT * FROM u WHERE text <> ''),
safe AS (SELECT doc_id, text FROM ld WHERE toxic = 0), {_sent_cte('safe')},
sf AS (SELECT *, row_number() OVER (ORDER BY doc_id, sent_no) AS rn FROM sents WHERE NOT {_looks_corpus('sentence')}),
sq AS (SELECT * FROM sf WHERE rn <= (SELECT count(*) FROM u2)),
bo AS (SELECT text, 1 AS label, 'u' || CAST(key AS VARCHAR) AS rid FROM u2
       UNION ALL SELECT sentence, 0, 's' || CAST(doc_id AS VARCHAR) || '_' || CAST(sent_no AS VARCHAR) FROM sq),
rr AS (SELECT *, row_number() OVER (ORDER BY {_md5('rid', 42)}) AS r, count(*) OVER () AS n FROM bo),
corpus AS (SELECT text, label, CASE WHEN r <= greatest(1, floor(n * 0.1)) THEN 'validation' ELSE 'train' END AS split FROM rr)"""
ORACLE["l5_balanced_corpus"] = f"WITH {CORPUS_CTE}\nSELECT text, label, split FROM corpus"
ORACLE["l7_validation_split"] = f"WITH {CORPUS_CTE}\nSELECT text, label, split FROM corpus WHERE split = 'validation'"
ORACLE["k2_corpus_meta"] = f"""WITH {CORPUS_CTE}
SELECT count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'validation') AS validation,
       count(*) FILTER (WHERE label = 1) AS unsafe_total_used, count(*) FILTER (WHERE label = 0) AS safe_total_used,
       CAST(0.1 AS DOUBLE) AS val_ratio, TRUE AS filter_safe_pii, 42 AS seed
FROM corpus"""

# ------------------------------------------------------------------ evaluation metrics
_P60 = sql_rules.score_sql(TEST_LEXICON, AGENT_ROLE, gap_s=60.0)
_P30 = sql_rules.score_sql(TEST_LEXICON, AGENT_ROLE, gap_s=30.0)
ORACLE["m1_rule_agreement"] = f"""
WITH p AS ({_P60}), x AS ({_P30}),
j AS (SELECT p.metric, CASE WHEN p.score = x.score THEN 1 ELSE 0 END AS ok FROM p JOIN x ON p.call_id = x.call_id AND p.metric = x.metric),
g AS (SELECT metric, sum(ok) AS correct, count(*) AS total FROM j GROUP BY ROLLUP (metric))
SELECT coalesce(metric, 'ALL') AS metric, CAST(correct AS BIGINT) AS correct, total,
       CASE WHEN metric IS NULL THEN round(correct / greatest(total, 1), 4) ELSE round(correct / greatest(total, 1), 6) END AS accuracy
FROM g"""
ORACLE["m2_mismatches"] = f"""
WITH p AS ({_P60}), x AS ({_P30})
SELECT p.call_id, p.metric, p.score, x.score AS expected, p.probability, p.evidence_snippet
FROM p JOIN x ON p.call_id = x.call_id AND p.metric = x.metric
WHERE p.score <> x.score AND p.metric = 'KR2.3' ORDER BY p.call_id, p.metric LIMIT 50"""
_HITS = "(" + " + ".join(st.count_of("d.text", k) for k in ["card", "phone_strict", "fin7", "email"]) + ")"
ORACLE["m3_guardrail_macro_f1"] = f"""
WITH pr AS (SELECT l.toxic AS y, CASE WHEN {_HITS} >= 1 THEN 1 ELSE 0 END AS p
            FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
cm AS (SELECT y, p, count(*) AS n FROM pr GROUP BY y, p),
cl AS (SELECT y AS c FROM cm UNION SELECT p FROM cm),
per AS (SELECT c, coalesce((SELECT sum(n) FROM cm WHERE y = c AND p = c), 0) AS tp,
               coalesce((SELECT sum(n) FROM cm WHERE y = c), 0) AS nt, coalesce((SELECT sum(n) FROM cm WHERE p = c), 0) AS np
        FROM cl)
SELECT round(sum(tp) / greatest(sum(nt), 1), 6) AS accuracy,
       round(avg(CASE WHEN nt + np > 0 THEN 2 * tp / (nt + np) ELSE 0.0 END), 6) AS macro_f1, count(*) AS n_classes
FROM per"""
ORACLE["m6_latency_means"] = """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS run_no FROM events)
SELECT event_type, count(*) AS n_runs, round(avg(value), 6) AS mean FROM r WHERE run_no > 1 GROUP BY event_type"""
ORACLE["m8_speedups"] = f"""
WITH m AS ({ORACLE["m6_latency_means"]})
SELECT event_type, mean, round((SELECT mean FROM m WHERE event_type = 'click') / nullif(mean, 0.0), 6) AS speedup FROM m"""
ORACLE["m9_load_summary"] = """
SELECT count(*) AS n, round(100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS fail_pct,
       round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95,
       round(avg(value), 6) AS mean, round(count(*) / nullif(epoch(max(ts)) - epoch(min(ts)), 0.0), 6) AS rps
FROM events"""
ORACLE["m11_conformance"] = f"""
WITH s AS ({sql_rules.score_sql(TEST_LEXICON, AGENT_ROLE)}),
pc AS (SELECT call_id, count(DISTINCT metric) AS n_keys, count(*) AS n_rows,
              count(*) FILTER (WHERE metric NOT IN ('KR2.1','KR2.2','KR2.3','KR2.4','KR2.5')) AS bad_keys,
              count(*) FILTER (WHERE NOT (score BETWEEN 0 AND 3)) AS bad_scores,
              count(*) FILTER (WHERE probability NOT IN ('HIGH', 'LOW')) AS bad_probs
       FROM s GROUP BY call_id)
SELECT count(*) AS n_calls, count(*) FILTER (WHERE NOT (n_keys = 5 AND n_rows = 5 AND bad_keys = 0)) AS bad_key_sets,
       count(*) FILTER (WHERE call_id IS NULL OR call_id = '') AS missing_call_id,
       CAST(sum(bad_scores) AS BIGINT) AS score_out_of_range, CAST(sum(bad_probs) AS BIGINT) AS bad_probability
FROM pc"""

# ------------------------------------------------------------------ raw payload ingestion
ORACLE["s6_payload_scores"] = ORACLE["r6_score_calls"]
_FAULTS = f"{sql_rules.segments_sql()}, f AS (SELECT CAST(call_id AS BIGINT) AS conv_id, CAST(pos AS BIGINT) AS turn, seg.*, " \
          "CAST((CAST(call_id AS BIGINT) + pos) % 14 AS INTEGER) AS fault FROM seg)"
ORACLE["n1_payload_rejects"] = f"""WITH {_FAULTS}
SELECT conv_id, turn, CASE WHEN fault = 0 THEN 'payload is not an object' WHEN fault <= 3 THEN 'Missing or invalid call_id'
                           ELSE 'Missing or invalid segments list' END AS reason
FROM f WHERE fault <= 5"""
_SPEAKER = """CASE fault WHEN 11 THEN '[''a'', 1, None, {''k'': "it''s"}]' WHEN 12 THEN 'True' ELSE speaker END"""
ORACLE["n3_broken_segments"] = f"""WITH {_FAULTS},
g AS (SELECT *, CASE WHEN fault IN (11, 12) THEN '' ELSE text END AS tx FROM f WHERE fault > 5)
SELECT conv_id, turn, fault, call_id, CAST(CASE WHEN fault = 6 THEN 3 ELSE 0 END AS INTEGER) AS n_dropped,
       CAST(CASE WHEN regexp_replace(tx, '^[{st.UWS}]+|[{st.UWS}]+$', '', 'g') IN ('', '.', '..', '...') THEN 1 ELSE 0 END AS INTEGER) AS n_blank,
       CAST(CASE WHEN fault = 6 THEN 1 ELSE 0 END AS INTEGER) AS pos, {_SPEAKER} AS speaker, tx AS text,
       CASE WHEN fault IN (8, 9, 10) THEN 0.0 ELSE start END AS start, CASE WHEN fault IN (8, 9, 10) THEN 0.0 ELSE "end" END AS "end",
       regexp_replace(tx, '^[{st.UWS}]+|[{st.UWS}]+$', '', 'g') IN ('', '.', '..', '...') AS blank
FROM g"""
ORACLE["n7_call_profile"] = f"""
WITH {sql_rules.segments_sql()}
SELECT call_id, count(*) AS n_segments,
       count(*) FILTER (WHERE regexp_replace(text, '^[{st.UWS}]+|[{st.UWS}]+$', '', 'g') IN ('', '.', '..', '...')) AS n_blank,
       count(*) FILTER (WHERE contains(lower(speaker), 'assistant')) AS n_agent,
       max("end") - min(start) AS duration_s,
       round(sum(CASE WHEN contains(lower(speaker), 'assistant') THEN greatest(0.0, "end" - start) END), 6) AS agent_talk_s
FROM seg GROUP BY call_id"""

ORACLE["t3_silence_sessions"] = """
WITH e AS (SELECT user_id, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR us - p >= 60000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us) AS k FROM e)
SELECT user_id, min(us) AS first_us, max(us) AS last_us, count(*) AS n_events, min(us) - min(p) FILTER (WHERE us - p >= 60000000) AS silence_us
FROM g GROUP BY user_id, k"""
ORACLE["t4_health_windows"] = """
WITH w AS (SELECT CAST(floor(epoch_us(ts) / 900000000) AS BIGINT) * 900 - 900 * i AS start_s, event_type, value
           FROM events, range(4) r(i))
SELECT start_s, count(*) AS n, round(100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS fail_pct, round(avg(value), 6) AS mean
FROM w GROUP BY start_s"""

# ------------------------------------------------------------------ models and decoding

_W = linear_head_weights(64, 2)
_w0 = "[" + ", ".join(repr(float(x)) for x in _W[0]) + "]::DOUBLE[]"
_w1 = "[" + ", ".join(repr(float(x)) for x in _W[1]) + "]::DOUBLE[]"
_HEAD = f"""
h AS (SELECT vec_id, list_dot_product(CAST(embedding AS DOUBLE[]), {_w0}) AS l0,
             list_dot_product(CAST(embedding AS DOUBLE[]), {_w1}) AS l1 FROM embeddings),
p AS (SELECT vec_id, exp(l1 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) AS pr FROM h)"""
ORACLE["d10_linear_head_softmax"] = f"WITH {_HEAD}\nSELECT vec_id, round(pr, 6) AS p_unsafe, pr >= 0.5 AS is_unsafe FROM p"
ORACLE["g3_batch_predict"] = f"WITH {_HEAD}\nSELECT vec_id, round(pr, 6) AS p_unsafe FROM p"
_LABELS = "['O', 'B-FIN', 'I-FIN', 'B-CARD', 'I-CARD', 'B-PHONE', 'I-PHONE', 'B-PERSON', 'I-PERSON']"
ORACLE["d12_token_labels"] = f"""
WITH t AS (SELECT vec_id, r - 1 AS t, embedding[(r - 1) * 9 + 1:(r - 1) * 9 + 9] AS sc FROM embeddings, range(1, 9) AS g(r))
SELECT vec_id, CAST(t AS INTEGER) AS t, coalesce(({_LABELS})[list_position(sc, list_max(sc))], 'O') AS tag FROM t"""
ORACLE["g5_ctc_decode"] = """
WITH f AS (SELECT vec_id, r - 1 AS fr, embedding[(r - 1) * 8 + 1:(r - 1) * 8 + 8] AS sc FROM embeddings, range(1, 9) AS g(r)),
a AS (SELECT vec_id, fr, list_position(sc, list_max(sc)) - 1 AS id FROM f),
b AS (SELECT *, lag(id) OVER (PARTITION BY vec_id ORDER BY fr) AS pid FROM a)
SELECT e.vec_id, coalesce(string_agg(CASE WHEN b.id <> 0 AND (b.pid IS NULL OR b.pid <> b.id)
                                      THEN (['_', 'a', ' ', 'b', 'c', 'd', 'e', 'f'])[b.id + 1] END, '' ORDER BY b.fr), '') AS text
FROM embeddings e JOIN b ON e.vec_id = b.vec_id GROUP BY e.vec_id"""

# ------------------------------------------------------------------ LLM answers as tables
_LLM_CTE = f"""
sc AS ({sql_rules.score_sql(TEST_LEXICON, AGENT_ROLE)}),
{sql_rules.segments_sql()},
ft AS (SELECT call_id, string_agg(speaker || ': ' || text, ' ' ORDER BY start, "end", pos) AS full_text FROM seg GROUP BY call_id),
so AS (SELECT *, speaker || ': ' || text AS piece, row_number() OVER (PARTITION BY call_id ORDER BY start, "end", pos) AS n FROM seg),
qq AS (SELECT call_id, first(piece ORDER BY n) FILTER (WHERE contains(lower(speaker), 'assistant')) AS quote,
              right(max(piece) FILTER (WHERE n = 1), 30) || ' ' || left(max(piece) FILTER (WHERE n = 2), 30) AS across FROM so GROUP BY call_id),
an AS (SELECT sc.call_id, sc.metric, sc.score, sc.probability, sc.reasoning, sc.evidence_snippet,
              CASE WHEN CAST(sc.call_id AS BIGINT) % 7 = 0 AND sc.metric = 'KR2.2' THEN 4
                   WHEN CAST(sc.call_id AS BIGINT) % 11 = 0 AND sc.metric = 'KR2.5' THEN 2 ELSE sc.score END AS a_score,
              regexp_replace(CASE WHEN CAST(sc.call_id AS BIGINT) % 5 = 0 AND sc.metric = 'KR2.3' THEN sc.evidence_snippet
                                  WHEN CAST(sc.call_id AS BIGINT) % 4 = 1 AND sc.metric = 'KR2.4' THEN coalesce(qq.across, '')
                                  WHEN CAST(sc.call_id AS BIGINT) % 13 = 3 AND sc.metric = 'KR2.1' THEN qq.quote || ' never said'
                                  ELSE coalesce(qq.quote, '') END, '^[{st.UWS}]+|[{st.UWS}]+$', '', 'g') AS ev
       FROM sc LEFT JOIN qq ON sc.call_id = qq.call_id),
vv AS (SELECT an.call_id, bool_and(a_score BETWEEN 0 AND 3 AND (ev = '' OR contains(ft.full_text, ev))) AS valid
       FROM an JOIN ft ON an.call_id = ft.call_id GROUP BY an.call_id)"""
ORACLE["r11_llm_validation"] = f"WITH {_LLM_CTE}\nSELECT call_id, valid FROM vv"
ORACLE["r12_llm_merge"] = f"""WITH {_LLM_CTE}
SELECT an.call_id, an.metric,
       CASE WHEN vv.valid THEN CAST(an.a_score AS INTEGER) ELSE an.score END AS score,
       an.probability,
       CASE WHEN vv.valid THEN 'LLM qiymətləndirməsi' ELSE an.reasoning END AS reasoning,
       CASE WHEN vv.valid THEN an.ev ELSE an.evidence_snippet END AS evidence_snippet,
       coalesce(vv.valid, FALSE) AS llm_used
FROM an LEFT JOIN vv ON an.call_id = vv.call_id"""
ORACLE["b4_spans_to_bio_rows"] = f"""WITH {TAGS_CTE}
SELECT tg.doc_id AS row_id, count(*) AS n_tokens, count(*) FILTER (WHERE tag <> 'O') AS n_tagged,
       coalesce(string_agg(tag, ' ' ORDER BY ti) FILTER (WHERE tag <> 'O'), '') AS tag_seq
FROM tg GROUP BY tg.doc_id
UNION ALL SELECT doc_id, 0, 0, '' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM tg)"""

_EXPLORE = "(" + " OR ".join(st.has("sentence", k) for k in ["fin_digit_first", "phone_strict", "card"]) + ")"
ORACLE["l12_explore_candidates"] = f"""
WITH n AS (SELECT doc_id, {st.norm_ws('text')} AS t FROM documents),
p AS (SELECT doc_id, string_split(regexp_replace(t, '([.!?…]) ', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM n WHERE t <> ''),
u AS (SELECT doc_id, unnest(parts) AS sentence, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS sent_no FROM p),
s AS (SELECT * FROM u WHERE length(sentence) BETWEEN 10 AND 240),
f AS (SELECT * FROM s WHERE {_EXPLORE} ORDER BY doc_id, sent_no LIMIT 5)
SELECT CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS INTEGER) AS sent_no, CAST(NULL AS VARCHAR) AS sentence,
       count(*) AS n_sentences, count(*) FILTER (WHERE {_EXPLORE}) AS n_flagged FROM s
UNION ALL
SELECT doc_id, sent_no, sentence, NULL, NULL FROM f"""

ORACLE["k4_results_json"] = ORACLE["r6_score_calls"]


def _tags_cte(p: str, dets: list[tuple[str, str]]) -> str:
    return f"""{_entities_cte(p, dets)},{_PAIRS.format(p=p)},
{p}pf AS (SELECT *, min(ti) OVER (PARTITION BY doc_id, eo) AS first_ti,
                 row_number() OVER (PARTITION BY doc_id, ti ORDER BY ns DESC, ne DESC, eo DESC) AS rk FROM {p}pr),
{p}tg AS (SELECT t.doc_id, t.ti, t.s, t.e,
                 coalesce(CASE WHEN q.ti = q.first_ti THEN 'B-' ELSE 'I-' END || q.label, 'O') AS tag
          FROM tok t LEFT JOIN (SELECT * FROM {p}pf WHERE rk = 1) q ON t.doc_id = q.doc_id AND t.ti = q.ti
          WHERE t.is_tok),
{p}sx AS (SELECT doc_id, ti, s, e, tag, CASE WHEN tag LIKE 'B-%' OR tag LIKE 'I-%' THEN substr(tag, 3) END AS typ
          FROM {p}tg WHERE NOT (s = 0 AND e = 0)),
{p}sy AS (SELECT *, CASE WHEN typ IS NOT NULL AND (tag LIKE 'B-%' OR lag(typ) OVER w IS NULL OR lag(typ) OVER w <> typ)
                         THEN 1 ELSE 0 END AS st FROM {p}sx WINDOW w AS (PARTITION BY doc_id ORDER BY ti)),
{p}sz AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY ti ROWS UNBOUNDED PRECEDING) AS span_no FROM {p}sy),
{p}sp AS (SELECT doc_id, first(typ) AS label, arg_min(s, ti) AS s, arg_max(e, ti) AS e
          FROM {p}sz WHERE typ IS NOT NULL GROUP BY doc_id, span_no)"""


ORACLE["m4_entity_f1"] = f"""WITH {TOKENS_CTE},
{_tags_cte('g_', [('card', 'CARD'), ('phone_strict', 'PHONE'), ('fin7', 'FIN')])},
{_tags_cte('a_', [('card', 'CARD'), ('phone', 'PHONE'), ('fin', 'FIN')])},
c AS (SELECT (SELECT count(*) FROM g_sp JOIN a_sp ON g_sp.doc_id = a_sp.doc_id AND g_sp.label = a_sp.label
                                     AND g_sp.s = a_sp.s AND g_sp.e = a_sp.e) AS tp,
             (SELECT count(*) FROM a_sp) AS n_pred, (SELECT count(*) FROM g_sp) AS n_gold,
             (SELECT avg(CASE WHEN g.tag = a.tag THEN 1.0 ELSE 0.0 END) FROM g_tg g JOIN a_tg a
                     ON g.doc_id = a.doc_id AND g.ti = a.ti) AS acc),
m AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS p,
             CASE WHEN n_gold > 0 THEN tp / n_gold ELSE 0.0 END AS r FROM c)
SELECT tp, n_pred, n_gold, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1, round(acc, 6) AS accuracy FROM m"""

ORACLE["m4_entity_f1_ids"] = ORACLE["m4_entity_f1"]

# word edits row by row of the distance table: a list step for each word of one side, folded over the other
ORACLE["m5_wer_turns"] = f"""
WITH w AS (SELECT conv_id, turn, string_split({norm_ws('text')}, ' ') AS ws, {norm_ws('text')} AS t FROM conversations),
l AS (SELECT conv_id, turn, CASE WHEN t = '' THEN [] ELSE ws END AS h,
             lag(CASE WHEN t = '' THEN [] ELSE ws END) OVER (PARTITION BY conv_id ORDER BY turn) AS r,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM w),
p AS (SELECT r, h FROM l WHERE k > 1),
e AS (SELECT len(r) AS n, list_reduce(range(1, len(r) + 1), lambda prev, i:
        list_reduce(range(1, len(h) + 1), lambda cur, j: list_append(cur,
            least(cur[j] + 1, prev[j + 1] + 1, prev[j] + CASE WHEN r[i] = h[j] THEN 0 ELSE 1 END)), [CAST(i AS BIGINT)]),
        range(0, len(h) + 1))[-1] AS d FROM p)
SELECT CAST(sum(d) AS BIGINT) AS edits, CAST(sum(n) AS BIGINT) AS ref_words, count(*) AS n_pairs,
       round(sum(d) / greatest(sum(n), 1), 6) AS wer FROM e"""

_REDACT_SQL = ("regexp_replace(regexp_replace(regexp_replace(text, " + q(RE2['card']) + ", '[CARD_NUMBER]', 'g'), "
               + q(RE2['num34']) + ", '[NUM]', 'g'), '(?i)\\b([0-9][A-Z0-9]{6,8})\\b', '[FIN_CODE]', 'g')")
ORACLE["r9_llm_requests"] = f"""
WITH {sql_rules.segments_sql()}
SELECT call_id, count(*) AS n_segments, CAST(sum(length({_REDACT_SQL})) AS INTEGER) AS redacted_chars,
       sum("end" - start) AS talk_s, TRUE AS templated
FROM seg GROUP BY call_id"""

ORACLE["b11_align_labels"] = f"""WITH {TAGS_CTE},
t AS (SELECT tg.*, greatest(CAST(ceil(length(token) / 4.0) AS INTEGER), 1) AS np
      FROM tg),
c AS (SELECT *, coalesce(sum(np) OVER (PARTITION BY doc_id ORDER BY ti ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS before, sum(np) OVER (PARTITION BY doc_id) AS total FROM t),
p AS (SELECT doc_id, 1 + before + j AS i,
             CASE WHEN j = 0 THEN tag WHEN tag LIKE 'B-%' THEN 'I-' || substr(tag, 3) ELSE tag END AS lab
      FROM (SELECT *, unnest(range(np)) AS j FROM c)),
lab AS (SELECT doc_id, CAST(i AS INTEGER) AS i, CAST(list_position({_LABELS}, lab) - 1 AS INTEGER) AS label_id FROM p
        UNION ALL SELECT DISTINCT doc_id, 0, -100 FROM c
        UNION ALL SELECT DISTINCT doc_id, CAST(total + 1 AS INTEGER), -100 FROM c
        UNION ALL SELECT doc_id, unnest([0, 1]), -100 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM tg))
SELECT doc_id AS row_id, i, label_id FROM lab"""





ORACLE["r6n_score_whole_calls"] = ORACLE["r6_score_calls"]
