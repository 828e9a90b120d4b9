"""DuckDB SQL for the registered queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(table: str, key: str, text: str, pattern: str) -> str:
    return (f"SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM "
            f"(SELECT {key}, regexp_extract_all(coalesce({text}, ''), {pattern}) AS w FROM {table})")


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_minhash_neardup"] = f"""
WITH RECURSIVE w AS ({_words('documents', 'doc_id', _LOWER.format('text'), _WORD)}),
g AS (SELECT doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS k FROM w),
s AS (SELECT DISTINCT doc_id, k FROM g WHERE i <= greatest(n - 3, 1)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * both_n >= 80 * (x.n + y.n - both_n)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, least(min(b), a) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, coalesce(m.component_id, d.doc_id)::BIGINT AS component_id,
       coalesce(m.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)"""

ORACLE_SQL["op3_rule_ledger"] = f"""
WITH w AS ({_words('documents', 'doc_id', 'text', _WORD)}),
g AS (SELECT doc_id, i, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c, word AS a FROM w
      WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM k, range(3) t(j) WHERE n > 1 GROUP BY ALL),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
      WHERE regexp_matches(line, {_WORD}) GROUP BY ALL),
t AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars,
             count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\\x00-\\x7F]')) AS n_alpha FROM w GROUP BY ALL),
f AS (SELECT d.doc_id, coalesce(t.n_words, 0) AS n_words, coalesce(t.word_chars, 0) AS word_chars, coalesce(t.n_alpha, 0) AS n_alpha,
        length(regexp_replace(coalesce(d.text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        length(regexp_replace(coalesce(d.text, ''), '[^A-Z]', '', 'g')) AS n_upper,
        length(regexp_replace(coalesce(d.text, ''), '[^A-Za-z]', '', 'g')) AS n_letters,
        coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (word_chars < 2 * n_words)::BIGINT
        + 8 * (word_chars > 15 * n_words)::BIGINT + 16 * (4 * n_symbols > n_words)::BIGINT + 32 * (10 * n_dup_lines > 3 * n_lines)::BIGINT
        + 64 * (10 * n_alpha < 6 * n_words)::BIGINT + 128 * (10 * n_upper > 6 * n_letters AND n_letters > 0)::BIGINT
        + 256 * (n_words > 100000)::BIGINT AS fail_bits FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       (fail_bits & (1 + 2 + 16 + 32 + 64 + 128)) = 0 AND bit_count((fail_bits & 12)::INTEGER) <= 1 AS kept, fail_bits
FROM b"""

ORACLE_SQL["op7_substring_dedup"] = f"""
WITH w AS ({_words('documents', 'doc_id', 'text', _WORD)}),
g AS (SELECT doc_id, i, word, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS k FROM w),
m AS (SELECT k, min(doc_id) AS least FROM g WHERE i <= n - 12 GROUP BY k),
f AS (SELECT g.doc_id, i, word, coalesce(i <= n - 12 AND m.least < g.doc_id, false) AS repeated FROM g LEFT JOIN m USING (k)),
r AS (SELECT doc_id, i, word, max(repeated::INTEGER) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM f),
a AS (SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM r GROUP BY ALL)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN a USING (doc_id)"""

ORACLE_SQL["op10_decontaminate"] = f"""
WITH dw AS ({_words('documents', 'doc_id', _LOWER.format('text'), _ALNUM)}),
iw AS ({_words('benchmark', 'item_id', _LOWER.format('text'), _ALNUM)}),
qs AS (SELECT DISTINCT least(n, 10) AS q FROM iw),
ig AS (SELECT item_id, least(n, 10) AS q, i, n, string_agg(word, ' ') OVER (PARTITION BY item_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS k FROM iw),
ik AS (SELECT DISTINCT item_id, q, k FROM ig WHERE i <= n - q + 1),
dg AS (SELECT doc_id, q, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id, q ORDER BY i ROWS BETWEEN CURRENT ROW AND (q - 1) FOLLOWING) AS k FROM dw, qs),
h AS (SELECT doc_id, dg.i, dg.q, item_id FROM dg JOIN ik USING (q, k) WHERE i <= n - q + 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM h, range(10) t(j) WHERE j < q GROUP BY ALL),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY ALL),
t AS (SELECT doc_id, count(*) AS n_words FROM dw GROUP BY ALL)
SELECT d.doc_id, coalesce(t.n_words, 0)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(it.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN it USING (doc_id)"""

ORACLE_SQL["op1_preference_chat"] = r"""
WITH c AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL),
la AS (SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last FROM c GROUP BY 1),
cut AS (SELECT conv_id, turn, role, text, CASE WHEN role = 'assistant' AND turn = last THEN
          array_to_string(string_split(text, ' ')[1:greatest(ceil(len(string_split(text, ' ')) / 2.0)::INTEGER, 1)], ' ') ELSE text END AS half
        FROM c JOIN la USING (conv_id)),
f AS (SELECT conv_id, arg_min(ROW(role, text), turn) AS opening, coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END), 0) AS score
      FROM c GROUP BY 1),
b AS (SELECT opening, arg_max(conv_id, ROW(score, -conv_id)) AS best FROM f GROUP BY 1 HAVING count(*) > 1),
p AS (SELECT best AS a, conv_id AS b FROM f JOIN b USING (opening) WHERE conv_id <> best),
t AS (SELECT conv_id AS a, NULL::BIGINT AS b, 'chosen' AS side, turn, role, text FROM cut
      UNION ALL SELECT conv_id, NULL, 'rejected', turn, role, half FROM cut
      UNION ALL SELECT a, b, 'chosen', turn, role, text FROM p JOIN c ON conv_id = a
      UNION ALL SELECT a, b, 'rejected', turn, role, text FROM p JOIN c ON conv_id = b),
n AS (SELECT *, row_number() OVER (PARTITION BY a, b, side ORDER BY turn, role, text) AS i,
        '<|' || replace(coalesce(role, 'unknown'), '<|', '< |') || '|>' || chr(10) AS head,
        replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS body FROM t),
x AS (SELECT n1.a, n1.b, n1.i, n1.role IS NOT DISTINCT FROM n2.role AND n1.text IS NOT DISTINCT FROM n2.text AS same
      FROM n n1 JOIN n n2 ON n1.a = n2.a AND n1.b IS NOT DISTINCT FROM n2.b AND n1.i = n2.i AND n1.side = 'chosen' AND n2.side = 'rejected'),
k AS (SELECT a, b, coalesce(min(i) FILTER (NOT same) - 1, max(i)) AS n_common FROM x GROUP BY ALL),
m AS (SELECT n.*, n_common, sum(length(head) + length(body)) FILTER (i > n_common) OVER (PARTITION BY n.a, n.b, side ORDER BY i) AS stop
      FROM n JOIN k ON n.a = k.a AND n.b IS NOT DISTINCT FROM k.b),
r AS (SELECT a, b, n_common,
        coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 'chosen' AND i <= n_common), '') AS prompt,
        coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 'chosen' AND i > n_common), '') AS chosen,
        coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 'rejected' AND i > n_common), '') AS rejected,
        coalesce(string_agg((stop - length(body))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY i) FILTER (side = 'chosen' AND i > n_common AND role = 'assistant'), '') AS chosen_mask,
        coalesce(string_agg((stop - length(body))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY i) FILTER (side = 'rejected' AND i > n_common AND role = 'assistant'), '') AS rejected_mask
      FROM m GROUP BY a, b, n_common)
SELECT a AS chosen_id, b AS rejected_id, n_common::BIGINT AS n_common, prompt, chosen, rejected, chosen_mask, rejected_mask,
       chosen_mask <> '' AND rejected_mask <> '' AND chosen <> rejected AS usable FROM r"""

ORACLE_SQL["op11_target_resample"] = f"""
WITH t AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
           FROM range(256) x(i)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), {_ALNUM}) AS w FROM documents),
b AS (SELECT regexp_extract_all(coalesce({_LOWER.format('text')}, ''), {_ALNUM}) AS w FROM benchmark),
u AS (SELECT r, unnest(w) AS a, unnest(list_append(w[2:], NULL)) AS b FROM d),
v AS (SELECT unnest(w) AS a, unnest(list_append(w[2:], NULL)) AS b FROM b),
df AS (SELECT r, a AS f FROM u UNION ALL SELECT r, a || ' ' || b FROM u WHERE b IS NOT NULL),
bf AS (SELECT a AS f FROM v UNION ALL SELECT a || ' ' || b FROM v WHERE b IS NOT NULL),
x AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
k AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
        lambda c, y: xor(crc[(xor(c, y) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM x, t),
s AS (SELECT bucket, count(*) AS n FROM df JOIN k USING (f) GROUP BY 1),
q AS (SELECT bucket, count(*) AS n FROM bf JOIN k USING (f) GROUP BY 1),
z AS (SELECT (SELECT count(*) FROM df) + 10000 AS s_all, (SELECT count(*) FROM bf) + 10000 AS t_all),
g AS (SELECT x.bucket, floor(1000 * ln(((coalesce(q.n, 0) + 1)::DOUBLE * s_all) / ((coalesce(s.n, 0) + 1)::DOUBLE * t_all)))::BIGINT AS gain
      FROM range(10000) x(bucket) LEFT JOIN s USING (bucket) LEFT JOIN q USING (bucket), z),
m AS (SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN k USING (f) JOIN g USING (bucket) GROUP BY r),
o AS (SELECT d.r, doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN m USING (r)),
e AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank, count(*) OVER () AS n FROM o WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score::BIGINT AS score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM o LEFT JOIN e USING (r)"""

ORACLE_SQL["op12_phrase_tiles"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, {_LOWER.format('text')} AS t FROM documents),
p AS (SELECT r, lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d WHERE t IS NOT NULL),
q AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
w AS (SELECT p, lang, unnest(w) AS a, unnest(list_append(w[2:], NULL)) AS b, unnest(list_concat(w[3:], [NULL, NULL])[1:len(w)]) AS c FROM q WHERE len(w) > 0),
f1 AS (SELECT lang, a, count(*) AS n FROM w GROUP BY ALL),
f2 AS (SELECT lang, a, b, count(*) AS n FROM w WHERE b IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, a, b, c, count(*) AS n FROM w WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
s2 AS (SELECT x.lang, x.a || ' ' || x.b AS phrase, x.n AS a, u.n AS l, v.n AS r, 1000000 * x.n::HUGEINT * x.n // (u.n::HUGEINT * v.n) AS score
       FROM f2 x JOIN f1 u ON u.lang = x.lang AND u.a = x.a JOIN f1 v ON v.lang = x.lang AND v.a = x.b
       WHERE x.n >= 10 AND NOT EXISTS (SELECT 1 FROM f3 y WHERE y.lang = x.lang AND y.a = x.a AND y.b = x.b AND 100 * y.n >= 50 * x.n)
         AND NOT EXISTS (SELECT 1 FROM f3 y WHERE y.lang = x.lang AND y.b = x.a AND y.c = x.b AND 100 * y.n >= 50 * x.n)),
k3 AS (SELECT x.*, 1 AS k, u.n AS l, v.n AS r FROM f3 x JOIN f1 u ON u.lang = x.lang AND u.a = x.a JOIN f2 v ON v.lang = x.lang AND v.a = x.b AND v.b = x.c
       UNION ALL SELECT x.*, 2, u.n, v.n FROM f3 x JOIN f2 u ON u.lang = x.lang AND u.a = x.a AND u.b = x.b JOIN f1 v ON v.lang = x.lang AND v.a = x.c),
s3 AS (SELECT lang, a || ' ' || b || ' ' || c AS phrase, n AS a, l, r, 1000000 * n::HUGEINT * n // (l::HUGEINT * r) AS score FROM k3
       QUALIFY row_number() OVER (PARTITION BY lang, a, b, c ORDER BY score, k) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM (SELECT * FROM s2 UNION ALL SELECT * FROM s3))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM z JOIN (SELECT lang, sum(n) AS n FROM f1 GROUP BY 1) USING (lang) WHERE rank <= 2000"""
