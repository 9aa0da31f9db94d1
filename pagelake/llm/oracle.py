"""SQL counterparts, for DuckDB, of the training-data queries that SQL can express."""

from __future__ import annotations

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# Windows per row and repeats of them, then spans of covered words.
op2 = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), win AS (
  SELECT doc_id, i, list_slice(ws, i, i + 34) AS k
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM w WHERE len(ws) >= 35)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1
), word AS (
  SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM w
), last AS (
  SELECT word.doc_id, word.word, word.p, max(rep.i) OVER (PARTITION BY word.doc_id ORDER BY word.p) AS begun
  FROM word LEFT JOIN rep ON rep.doc_id = word.doc_id AND rep.i = word.p
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM last WHERE begun IS NULL OR p - begun > 34 GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

op3 = f"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS p
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
  SELECT doc_id, line, p, translate(trim(line, {SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), hot AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), j AS (
  SELECT k.*, top IS NOT NULL AND top <> doc_id AS gone FROM k LEFT JOIN hot USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

# One period of the schedule by recursion, slot by slot.
op5 = """
WITH RECURSIVE n AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), share AS (
  SELECT source, greatest(1, round(sqrt(n) * 1000 / (SELECT sum(sqrt(n)) FROM n)))::BIGINT AS share FROM n
), parts AS (
  SELECT list(source ORDER BY source) AS sources, list(share ORDER BY source) AS shares, sum(share)::BIGINT AS period FROM share
), edf AS (
  SELECT -1::BIGINT AS slot, NULL::BIGINT AS pick, list_transform(shares, lambda s: 0::BIGINT) AS done, shares, sources, period FROM parts
  UNION ALL
  SELECT slot + 1, p, list_transform(done, lambda d, i: d + (i = p)::BIGINT), shares, sources, period
  FROM (SELECT *, list_sort(list_filter(list_transform(shares, lambda s, i:
          CASE WHEN done[i] < s AND done[i] * period // s <= slot + 1
          THEN ((done[i] + 1) * period + s - 1) // s * 1000000 + i END), lambda x: x IS NOT NULL))[1] % 1000000 AS p
        FROM edf WHERE slot + 1 < period)
), plan AS (
  SELECT sources[pick] AS source, shares[pick] AS share, period, slot, done[pick] - 1 AS nth FROM edf WHERE slot >= 0
), r AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS rank FROM documents
)
SELECT doc_id, source, rank // 64 AS block, (rank // 64 // share) * period + slot AS mix_slot,
       ((rank // 64 // share) * period + slot) * 64 + rank % 64 AS mix_order
FROM r JOIN (SELECT DISTINCT source, share, period FROM plan) USING (source) JOIN plan USING (source, share, period)
WHERE nth = (rank // 64) % share
"""

op10 = f"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '~') AS lang, coalesce(source, '~') AS source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), l AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT line) AS d
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) WHERE trim(line, {SPACE}) <> '' GROUP BY doc_id
), win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM t WHERE len(ws) >= 3)
), r AS (
  SELECT doc_id, sum(least(3, coalesce(nxt - i, 3))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM win WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT t.doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(l.n - l.d, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(l.n, 0) AS n_lines
  FROM t LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         1000 * n_symbols // greatest(word_chars, 1) AS s, 1000 * n_dup_lines // greatest(n_lines, 1) AS d FROM m
), v AS (
  SELECT lang, source, 20 AS least, 's' AS measure, s AS v FROM f UNION ALL SELECT lang, source, 500, 'd', d FROM f
), b AS (
  SELECT lang, source, least, measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket FROM v
), every AS (
  SELECT 0 AS level, lang, source, measure, least, bucket FROM b
  UNION ALL SELECT 1, lang, NULL, measure, least, bucket FROM b UNION ALL SELECT 2, NULL, NULL, measure, least, bucket FROM b
), fence AS (
  SELECT level, lang, source, measure, count(*) AS docs,
         greatest(any_value(least), quantile_disc(bucket, 0.5) + 6 * (quantile_disc(bucket, 0.5) - quantile_disc(bucket, 0.25))) AS fence
  FROM every GROUP BY level, lang, source, measure
), cut AS (
  SELECT c.lang, c.source, c.measure, CASE WHEN c.docs >= 50 THEN c.fence WHEN l.docs >= 50 THEN l.fence ELSE a.fence END AS fence
  FROM fence c JOIN fence l ON l.level = 1 AND l.lang = c.lang AND l.measure = c.measure JOIN fence a ON a.level = 2 AND a.measure = c.measure
  WHERE c.level = 0
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND s <= cs.fence AND d <= cd.fence AS kept
FROM f JOIN cut cs ON cs.lang = f.lang AND cs.source = f.source AND cs.measure = 's'
       JOIN cut cd ON cd.lang = f.lang AND cd.source = f.source AND cd.measure = 'd'
"""

UNIT = "[A-Za-z]+|[^A-Za-z]"

op11 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), h AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
         ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

# Formatted lengths: the text with one backslash more per control string, and what the template adds to each role.
op12 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?(?:INST|ROLE)\]|<\\*</?SYS>>')) AS hits,
         len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?(?:INST|ROLE)\]|<\\*</?SYS>>')) AS role_hits FROM c
), m AS (
  SELECT *, length(text) + hits + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 5 WHEN 'system' THEN 22
         ELSE 21 + length(role) + role_hits END AS chars FROM e
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

op13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT r, lang, source, term, count(*) AS n FROM (
    SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
  ) GROUP BY ALL
), kept AS (
  SELECT lang, term FROM t GROUP BY ALL HAVING count(*) >= 30
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), k AS (
  SELECT g.lang, g.source, kept.term, coalesce(n, 0)::HUGEINT AS n, v FROM g JOIN kept USING (lang) JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM t GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source AND s.term = kept.term
), p AS (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 5 * v) AS p FROM k
), l AS (
  SELECT lang, term, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang)::HUGEINT + 5 * v) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n, any_value(v) AS v FROM k GROUP BY lang, term)
), f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT a.lang, a.source AS s, b.source AS o, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  ) x ON x.lang = a.lang AND x.s = a.source AND x.o = b.source
  UNION ALL
  SELECT p.lang, source, 'term', term, p - q FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f) WHERE part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op2_substring_dedup": op2, "op3_line_dedup": op3, "op5_source_mixing": op5, "op10_quality_rules": op10,
    "op11_fill_in_middle": op11, "op12_chat_format": op12, "op13_divergence_audit": op13,
}
