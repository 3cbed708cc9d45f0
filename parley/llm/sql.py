"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_filter(rules: list[tuple[str, str]], spam_words: list[str]) -> str:
    table = ", ".join(f"('{r}', '{r.split('/')[0]}', '{r[len(r.split('/')[0]):]}', '{v}')" for r, v in rules)
    words = "|".join(spam_words)
    return f"""
WITH u AS (SELECT DISTINCT coalesce(url, '') AS url FROM pages),
p AS (SELECT url, translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule, rule_host, rule_path, verdict) AS (VALUES {table}),
f AS (SELECT p.url, r.rule, r.verdict,
             row_number() OVER (PARTITION BY p.url ORDER BY length(r.rule) DESC, length(r.rule_host) DESC) AS rk
      FROM p JOIN r ON p.host <> '' AND (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)),
s AS (SELECT p.*, f.rule, f.verdict, nullif(regexp_extract(p.host,
             '(?:^|[.])((?:[^.]*-)?(?:{words})(?:-[^.]*)?(?:[.].*)?)$', 1), '') AS spam_host
      FROM p LEFT JOIN f ON p.url = f.url AND f.rk = 1)
SELECT pages.page_id, s.host, s.path, s.rule,
       CASE WHEN s.rule IS NOT NULL THEN s.verdict WHEN s.spam_host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, s.spam_host
FROM pages JOIN s ON coalesce(pages.url, '') = s.url"""


QUALITY = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents),
w AS (SELECT row, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
f AS (SELECT row, doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM w),
k AS (SELECT row, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
v AS (SELECT row, i, x = lag(x) OVER o AS same, lead(x, 7) OVER o IS NOT NULL AS whole,
             concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o, lead(x, 5) OVER o,
                       lead(x, 6) OVER o, lead(x, 7) OVER o) AS part
      FROM k WINDOW o AS (PARTITION BY row ORDER BY i)),
h AS (SELECT row, i, count(*) OVER (PARTITION BY row, part) AS n FROM v WHERE whole),
c AS (SELECT row, i, coalesce(lead(i) OVER (PARTITION BY row ORDER BY i) - i, 8) AS gap FROM h WHERE n > 1),
g AS (SELECT row, CAST(sum(least(gap, 8)) AS BIGINT) AS n_repeat_words FROM c GROUP BY row),
e AS (SELECT row, count(*) FILTER (WHERE same) AS n_same FROM v GROUP BY row),
a AS (SELECT f.*, coalesce(g.n_repeat_words, 0) AS n_repeat_words, coalesce(e.n_same, 0) AS n_same
      FROM f LEFT JOIN g ON f.row = g.row LEFT JOIN e ON f.row = e.row),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_upper > 3 * word_chars OR word_chars < 2 * n_words
            OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines OR 10 * n_same > 3 * n_words) AS kept
FROM b"""


_WORDS_LOWER = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

RESAMPLE = f"""
WITH crc AS (SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
             FROM range(256) r(i)),
d AS (SELECT doc_id, row_number() OVER () AS row, {_WORDS_LOWER} AS ws FROM documents),
b AS (SELECT unnest({_WORDS_LOWER}) AS w FROM benchmark),
u AS (SELECT row, unnest(ws) AS w FROM d),
v AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM u UNION SELECT w FROM b)),
k AS (SELECT w, xor(list_reduce(list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
                                lambda c, x: xor(t[CAST((xor(c, x) & 255) + 1 AS BIGINT)], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
      FROM v, crc),
s AS (SELECT bucket, count(*) AS n FROM u JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN k USING (w) GROUP BY bucket),
a AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
g AS (SELECT s.bucket, floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (s_all + 10000) AS DOUBLE)
                                      / CAST((s.n + 1) * (t_all + 10000) AS DOUBLE))) AS gain
      FROM s LEFT JOIN t ON s.bucket = t.bucket, a),
w AS (SELECT row, CAST(sum(gain) AS BIGINT) AS weight FROM u JOIN k USING (w) JOIN g USING (bucket) GROUP BY row),
x AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
             CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w ON d.row = w.row),
y AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             10 * count(*) FILTER (WHERE n_features >= 20) OVER () // 100 AS drawn FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM z"""


FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, doc_id > min(doc_id) OVER (PARTITION BY t) AS copy FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
              regexp_matches(t, '[#$%&*|]'), coalesce(copy, false)] AS f
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY part, f),
i(x, ch) AS (VALUES (1, 'A'), (2, 'B'), (3, 'C'), (4, 'D'), (5, 'E')),
o AS (SELECT concat(a.ch, b.ch, c.ch, d.ch, e.ch) AS filter_order, [a.x, b.x, c.x, d.x, e.x] AS xs
      FROM i a, i b, i c, i d, i e
      WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step, xs[step] AS x, xs[:step - 1] AS before FROM o, range(1, 6) r(step)),
g AS (SELECT part, filter_order, step, x, n, good, toxic, f, f[x] AS fails, len(list_filter(before, lambda y: f[y])) > 0 AS gone FROM s, c),
r AS (SELECT part, filter_order, step, x, sum(n) FILTER (WHERE NOT fails AND NOT gone) AS kept, sum(n) FILTER (WHERE fails AND NOT gone) AS removed,
             sum(n) FILTER (WHERE fails AND gone) AS redundant,
             sum(n) FILTER (WHERE fails AND len(list_filter(f, lambda y: y)) = 1) AS unique_fails,
             sum(good) FILTER (WHERE fails AND NOT gone) AS good_lost, sum(toxic) FILTER (WHERE fails AND NOT gone) AS toxic_lost
      FROM g GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, x), 0) AS BIGINT) AS shapley
FROM r"""


LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT row, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key FROM l),
s AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10),
j AS (SELECT k.*, s.key IS NOT NULL AS gone FROM k LEFT JOIN s ON k.key = s.key),
g AS (SELECT row, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
             sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM j GROUP BY row)
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM d JOIN g USING (row)"""
