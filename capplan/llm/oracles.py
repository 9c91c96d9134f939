"""DuckDB counterparts of the queries that SQL can express, written from the rules alone."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH raw AS (SELECT doc_id, string_split(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), chr(10)) AS ls FROM documents),
     line AS (SELECT doc_id, i - 1 AS i, list_sort(list_distinct(regexp_extract_all(ls[i], '{_BLANK}'))) AS s
              FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM raw)),
     l AS (SELECT doc_id, i, s FROM line WHERE len(s) > 0),
     sets AS (SELECT s, len(s) AS n, min((doc_id, i)) AS first, row_number() OVER () AS k FROM l GROUP BY s),
     word AS (SELECT k, n, unnest(s) AS t FROM sets),
     freq AS (SELECT t, count(*) AS f FROM word GROUP BY t),
     ranked AS (SELECT k, n, t, row_number() OVER (PARTITION BY k ORDER BY f, t) AS r FROM word JOIN freq USING (t)),
     prefix AS (SELECT k, n, t FROM ranked WHERE r <= n - ceil(0.8 * n - 1e-9) + 1),
     cand AS (SELECT DISTINCT a.k AS a, b.k AS b FROM prefix a JOIN prefix b ON a.t = b.t AND a.k <> b.k
              AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
     late AS (SELECT DISTINCT b FROM (SELECT b, x.n AS xn, y.n AS yn, len(list_intersect(x.s, y.s)) AS c
              FROM cand JOIN sets x ON x.k = a JOIN sets y ON y.k = b WHERE x.first < y.first) WHERE 100 * c >= 80 * (xn + yn - c)),
     gone AS (SELECT l.doc_id, l.i FROM l JOIN sets USING (s) LEFT JOIN late ON late.b = sets.k
              WHERE late.b IS NOT NULL OR (l.doc_id, l.i) <> sets.first),
     per AS (SELECT doc_id, count(*) AS c, string_agg(i::VARCHAR, ',' ORDER BY i) AS r FROM gone GROUP BY 1),
     n AS (SELECT doc_id, count(*) AS c FROM l GROUP BY 1)
SELECT documents.doc_id, coalesce(n.c, 0)::BIGINT AS n_lines, coalesce(per.c, 0)::BIGINT AS n_removed, coalesce(r, '') AS removed
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN per USING (doc_id)
"""

OP3 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, encode(coalesce(html, '')) AS raw FROM pages),
     d AS (SELECT page_id, octet_length(raw)::BIGINT AS payload_bytes, sha1(raw) AS hex, max(page_id) OVER (PARTITION BY html) AS r FROM p),
     b AS (SELECT *, array_to_string(list_transform(range(40), lambda i: lpad(bin(instr('0123456789abcdef', hex[i + 1]) - 1), 4, '0')), '') AS bits FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 +
         list_sum(list_transform(range(5), lambda k: bits[5 * i + k + 1]::INT * (16 >> k)))::INT]), '') AS payload_digest,
       CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> r THEN r END AS refers_to
FROM b
"""

OP5 = rf"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
     iw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
     pat AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_aggregate(w[i:i + 12], 'string_agg', ' ') AS p
             FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT n FROM pat),
     win AS (SELECT doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS p
             FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
     hit AS (SELECT win.doc_id, win.i, win.n, pat.item_id FROM win JOIN pat USING (n, p)),
     word AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY 1),
     item AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s
              FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(s, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""

OP6 = rf"""
WITH RECURSIVE
     w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_BLANK}') AS w FROM documents),
     sh AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
                     WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
     size AS (SELECT doc_id, len(s)::BIGINT AS n FROM sh),
     token AS (SELECT doc_id, unnest(s) AS t FROM sh),
     pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM token a JOIN token b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
     link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
     edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
     reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT doc_id, n AS n_shingles, min(reach.b) AS component_id FROM size JOIN reach ON reach.a = doc_id GROUP BY 1, 2
"""

OP8 = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) t(i))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
     w AS (SELECT doc_id, regexp_extract_all(text, '{_BLANK}') AS w FROM d),
     word AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
     win AS (SELECT doc_id, i, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS p,
                    count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS n FROM word),
     twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, p) AS c FROM win WHERE n = 8) WHERE c > 1),
     rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY 1),
     split AS (SELECT doc_id, host, string_split(text, chr(10)) AS ls FROM d),
     raw AS (SELECT doc_id, host, i, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM split)),
     line AS (SELECT doc_id, host, i, line, len(regexp_extract_all(line, '{_BLANK}')) AS words,
                     array_to_string(regexp_extract_all(lower(line), '{_BLANK}'), ' ') AS h
              FROM raw WHERE regexp_matches(line, '{_BLANK}')),
     dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM line GROUP BY 1),
     whole AS (SELECT doc_id, string_agg(h, chr(10) ORDER BY i) AS norm FROM line GROUP BY 1),
     held AS (SELECT host, h, count(DISTINCT norm) AS n FROM line JOIN whole USING (doc_id) GROUP BY 1, 2),
     hosts AS (SELECT host, count(*) AS docs FROM d GROUP BY 1),
     boiler AS (SELECT host, h FROM held JOIN hosts USING (host) WHERE n >= 10 AND n >= 0.005 * docs),
     gone AS (SELECT doc_id, sum(words) AS n FROM line JOIN boiler USING (host, h) GROUP BY 1),
     m AS (SELECT doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
                  len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
                  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0) AS lost
           FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - lost >= 0.3 * n_words AS kept
FROM m
"""

OP11 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
     win AS (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS s FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS i FROM d)),
     late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY s) AS f FROM win) WHERE (doc_id, i) <> f),
     isle AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM (
                SELECT doc_id, i, CASE WHEN i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) > 100 THEN 1 ELSE 0 END AS fresh FROM late)),
     span AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM isle GROUP BY doc_id, k),
     edge AS (SELECT doc_id, s, e FROM span UNION ALL SELECT doc_id, n, n FROM d),
     piece AS (SELECT doc_id, s, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s, e) AS b FROM edge),
     kept AS (SELECT doc_id, string_agg(substr(x, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) AS y FROM piece JOIN d USING (doc_id) GROUP BY 1),
     c AS (SELECT doc_id, count(*) AS spans, sum(e - s) AS gone FROM span GROUP BY 1)
SELECT d.doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(y)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN c USING (doc_id)
"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
     tok AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d),
     kept AS (SELECT lang, t FROM tok GROUP BY 1, 2 HAVING count(DISTINCT k) >= 3),
     v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
     g AS (SELECT DISTINCT lang, source FROM d),
     cnt AS (SELECT lang, source, t, count(*) AS c FROM tok JOIN kept USING (lang, t) GROUP BY 1, 2, 3),
     n AS (SELECT lang, source, sum(c) AS n FROM cnt GROUP BY 1, 2),
     lc AS (SELECT lang, t, sum(c) AS c FROM cnt GROUP BY 1, 2),
     ln AS (SELECT lang, sum(c) AS n FROM lc GROUP BY 1),
     p AS (SELECT g.lang, g.source, kept.t, coalesce(c, 0) AS c,
                  (1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)::HUGEINT) // (coalesce(n.n, 0) + v.v)::HUGEINT)::HUGEINT AS p
           FROM g JOIN kept ON kept.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
           LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.t = kept.t),
     q AS (SELECT lc.lang, lc.t, (1 + (1000000000::HUGEINT * (c + 1)::HUGEINT) // (ln.n + v.v)::HUGEINT)::HUGEINT AS q
           FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
     sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY 1, 2, 3),
     pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
     terms AS (SELECT lang, source, t AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, t) WHERE c > 0 AND p > q),
     every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 200
"""

#: U+00C0 to U+00FF, and as many signs of one byte each that no word has, as DuckDB's distance works on bytes.
_ACCENTED = "".join(chr(c) for c in range(0xC0, 0x100))
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if c not in _LOWER + "'")[:64]

OP13 = rf"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
     run AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                    '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY 1, 2),
     raw AS (SELECT w, n, flatten(list_transform(string_split(doc_id || ':' || w, ''),
                    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + (ord(c)::BIGINT >> 6), 128 + (ord(c)::BIGINT & 63)] END)) AS b FROM run),
     hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
                FROM raw, crc),
     word AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM hashed),
     words AS (SELECT word, sum(n)::BIGINT AS n, translate(word, '{_ACCENTED}', '{_SIGNS}') AS plain
               FROM word WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
     sig AS (SELECT DISTINCT plain, unnest(list_append(list_transform(range(1, length(plain) + 1), lambda i: substr(plain, 1, i - 1) || substr(plain, i + 1)), plain)) AS s FROM words),
     cand AS (SELECT DISTINCT a.plain AS a, b.plain AS b FROM sig a JOIN sig b ON a.s = b.s AND a.plain <> b.plain),
     near AS (SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM cand JOIN words x ON x.plain = a JOIN words y ON y.plain = b WHERE levenshtein(a, b) = 1),
     best AS (SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY 1, 2),
     judged AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * words.n THEN other END AS form,
                       CASE WHEN other_n >= 10 * words.n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
     chain AS (SELECT j.*, f1.form AS f2, f2.form AS f3, f3.form AS f4, f4.form AS f5, f5.form AS f6
               FROM judged j LEFT JOIN judged f1 ON f1.word = j.form LEFT JOIN judged f2 ON f2.word = f1.form LEFT JOIN judged f3 ON f3.word = f2.form
               LEFT JOIN judged f4 ON f4.word = f3.form LEFT JOIN judged f5 ON f5.word = f4.form)
SELECT word, form, coalesce(f6, f5, f4, f3, f2, form, word) AS root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM chain
"""

ORACLES: dict[str, str] = {
    "op2_line_dedup": OP2, "op3_warc": OP3, "op5_decontamination": OP5, "op6_ngram_jaccard_join": OP6, "op8_chat_formatting": OP8, "op9_quality_rules": OP9,
    "op11_suffix_dedup": OP11, "op12_source_audit": OP12, "op13_spelling_variants": OP13,
}
