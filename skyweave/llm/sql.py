"""SQL twins, for DuckDB on the same tables, of the operators that SQL can express."""

REPEATED_BYTES = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
n AS (SELECT r, doc_id, x, CAST(length(x) // 2 AS BIGINT) AS n FROM d),
a AS (SELECT r, doc_id, n, x, unnest(range((n + 255) // 256)) AS k FROM n),
e AS (SELECT r, doc_id, n, k, substr(x, 512 * k + 1, 610) AS x FROM a),
p AS (SELECT r, doc_id, n, k, x, unnest(range(least(256, n - 256 * k))) AS j FROM e),
w AS (SELECT r, doc_id, 256 * k + j AS i, substr(x, 2 * j + 1, 2) AS b, CASE WHEN 256 * k + j <= n - 50 THEN substr(x, 2 * j + 1, 100) END AS s FROM p),
f AS (SELECT s, min(doc_id) AS first FROM w WHERE s IS NOT NULL GROUP BY s),
m AS (SELECT w.r, w.i, w.b, f.first IS NOT NULL AND (w.doc_id IS NULL OR f.first < w.doc_id) AS hit FROM w LEFT JOIN f USING (s)),
c AS (SELECT r, i, b, max(CAST(hit AS INT)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone FROM m),
g AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), FALSE) AS begins FROM c),
k AS (SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
      coalesce(string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM g GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM n LEFT JOIN k USING (r)
"""

QUOTATION_THREADS = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
       coalesce(turn, -4611686018427387904) AS seq FROM conversations),
c AS (SELECT *, CASE WHEN conv_id IS NULL THEN '?' || r ELSE CAST(conv_id AS VARCHAR) END AS conv FROM t),
l AS (SELECT r, conv, seq, unnest(string_split_regex(text, '\r?\n')) AS line, generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS k FROM c),
q AS (SELECT r, conv, seq, k, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]+', '', 'g')) AS level,
      regexp_replace(line, '^(?:[ \t]*>)+ ?', '') AS body FROM l),
z AS (SELECT *, trim(regexp_replace(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS n,
      level = 0 AND regexp_matches(body, 'wrote:[ \t]*$') AND coalesce(lead(level) OVER (PARTITION BY r ORDER BY k), 0) > 0 AS intro FROM q),
o AS (SELECT r, max(level) AS quote_levels, coalesce(trim(string_agg(body, chr(10) ORDER BY k) FILTER (WHERE level = 0 AND NOT intro), chr(32) || chr(9) || chr(10) || chr(13)), '') AS content FROM z GROUP BY r),
met AS (SELECT a.conv, a.seq, b.seq AS parent, a.n FROM (SELECT DISTINCT conv, seq, n FROM z WHERE level = 1 AND n <> '') a
        JOIN (SELECT DISTINCT conv, seq, n FROM z WHERE level = 0 AND NOT intro AND n <> '') b ON a.conv = b.conv AND a.n = b.n AND b.seq < a.seq),
votes AS (SELECT conv, seq, parent, count(*) AS n_linked FROM met GROUP BY ALL),
best AS (SELECT conv, seq, parent, n_linked FROM votes QUALIFY row_number() OVER (PARTITION BY conv, seq ORDER BY n_linked DESC, parent DESC) = 1),
path AS (SELECT DISTINCT c.conv, c.seq, [c.seq] AS path FROM c LEFT JOIN best b ON c.conv = b.conv AND c.seq = b.seq WHERE b.seq IS NULL
         UNION ALL SELECT b.conv, b.seq, list_append(p.path, b.seq) FROM best b JOIN path p ON p.conv = b.conv AND p.seq = b.parent)
SELECT c.conv_id, c.turn, row_number() OVER (PARTITION BY c.conv ORDER BY p.path, c.role, o.content) - 1 AS position, b.parent AS reply_to,
       CAST(len(p.path) - 1 AS BIGINT) AS depth, CAST(coalesce(b.n_linked, 0) AS BIGINT) AS n_linked, CAST(o.quote_levels AS BIGINT) AS quote_levels,
       c.role, o.content, '<|' || c.role || '|>' || chr(10) || o.content || chr(10) AS formatted
FROM c JOIN o USING (r) JOIN path p ON p.conv = c.conv AND p.seq = c.seq LEFT JOIN best b ON b.conv = c.conv AND b.seq = c.seq
"""

PREFIX_TRIE = """
WITH own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
       FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM own),
crc AS (SELECT c, xor(4294967295, list_reduce(list_transform(string_split(s, ''), lambda x: CAST(ascii(x) AS BIGINT)),
       lambda acc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(acc, b)),
       4294967295::BIGINT)) % 6 AS h FROM ids),
heads AS (SELECT crc.c, o.pos, o.role, o.text FROM crc JOIN own o ON o.c = crc.c - crc.c % 100 AND o.pos <= crc.h),
m AS (SELECT crc.c, crc.h, count(heads.pos) AS m FROM crc LEFT JOIN heads USING (c) GROUP BY ALL),
turns AS (SELECT c, pos AS d, role, text FROM heads UNION ALL
          SELECT o.c, o.pos - m.h + m.m, o.role, o.text FROM own o JOIN m ON o.c = m.c AND o.pos > m.h),
p AS (SELECT c, d, length(text) AS chars, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY d) AS path FROM turns
      UNION ALL SELECT c, 0, 0, '' FROM ids),
q AS (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY d) AS above, d = max(d) OVER (PARTITION BY c) AS ends FROM p),
n AS (SELECT d, path, any_value(above) AS above, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS worth,
      sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM q GROUP BY d, path),
k AS (SELECT d - 1 AS d, above AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (d, path)),
sums AS (SELECT q.d, q.path, sum(CAST(f.n_children = 0 AS INT)) AS n_leaves, sum(f.worth) AS saved_tokens FROM f JOIN q ON q.c = f.c AND q.d <= f.d GROUP BY ALL)
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, a.c AS parent_conv_id, f.n_convs, CAST(f.n_children AS BIGINT) AS n_children,
       CAST(sums.n_leaves AS BIGINT) AS n_leaves, CAST(sums.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN sums USING (d, path) LEFT JOIN n a ON a.d = f.d - 1 AND a.path = f.above
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d),
k AS (SELECT lang, t, count(*) AS n FROM w GROUP BY lang, t HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, t, count(*) AS n FROM w SEMI JOIN k USING (lang, t) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT o.lang, o.source, coalesce(v.v, 0) AS v, coalesce(s.n, 0) AS n, v.n AS n_lang FROM (SELECT DISTINCT lang, source FROM d) o
      LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source)),
p AS (SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p,
      1 + CAST(1000000000 AS HUGEINT) * (k.n + 1) // (g.n_lang + g.v) AS q FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, t)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', t, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
