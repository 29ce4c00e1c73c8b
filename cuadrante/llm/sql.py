"""Reference SQL (DuckDB) of the queries that SQL can express."""

EXACT_DEDUP = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)
"""

WARC = """
WITH t AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
             CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS orig FROM t)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN orig = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN orig <> page_id THEN orig END AS refers_to FROM s
"""

HOST_RULES = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, list_slice(words, i, i + 7) AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM t)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, sum(least(8, i - coalesce(prev, -8))) AS n FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (SELECT t.doc_id, t.source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM t LEFT JOIN dup ON dup.doc_id = t.doc_id LEFT JOIN rep ON rep.doc_id = t.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS k FROM b WHERE source IS NOT NULL GROUP BY source),
g AS (SELECT sum(n) AS n, sum(k) / sum(n) AS m, count(*) AS hosts, sum(n * n) AS n2 FROM h),
s AS (SELECT sum(h.n * pow(h.k / h.n - g.m, 2)) AS s FROM h, g),
e AS (SELECT g.m, CASE WHEN g.n - g.n2 / g.n > 0 THEN (s.s - (g.hosts - 1) * g.m * (1 - g.m)) / (g.n - g.n2 / g.n) END AS excess FROM g, s),
p AS (SELECT m, CASE WHEN excess > 0 THEN greatest(m * (1 - m) / excess - 1, 0) END AS strength FROM e),
v AS (SELECT h.source, CASE WHEN p.strength IS NULL THEN p.m ELSE (h.k + p.strength * p.m) / (h.n + p.strength) END AS rate FROM h, p)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(v.rate <= 0.5, true) AS kept
FROM b LEFT JOIN v ON v.source = b.source
"""

NEAR_DEDUP = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, list_slice(words, i, i + 4) AS s FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM reach r JOIN edge e ON e.x = r.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM documents d JOIN comp ON comp.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

LINE_DEDUP = """
WITH t AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM t),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
shared AS (SELECT bare FROM k WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 10),
m AS (SELECT k.*, shared.bare IS NOT NULL AS gone FROM k LEFT JOIN shared ON shared.bare = k.bare)
SELECT doc_id, count(*) FILTER (bare <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_sha256
FROM m GROUP BY doc_id
"""

INFILL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS d FROM documents),
h AS (SELECT doc_id, text, length(text) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

PHRASES = r"""
WITH t AS (SELECT doc_id, coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
g AS (SELECT lang, k, words[i : i + k - 1] AS p FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, range(1, 4) AS r(k) WHERE len(words) >= k)),
f AS (SELECT lang, k, p, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cuts AS (SELECT c.lang, c.k, c.p, c.a, x.a AS l, y.a AS r, x.k AS cut, (1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a))::BIGINT AS score
         FROM f c, range(1, 3) AS z(j) JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : j] JOIN f y ON y.lang = c.lang AND y.p = c.p[j + 1 :] WHERE c.k > 1 AND c.a >= 10 AND j < c.k),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
part AS (SELECT lang, p[1 : 2] AS p, a FROM low WHERE k = 3 UNION ALL SELECT lang, p[2 : 3], a FROM low WHERE k = 3),
kept AS (SELECT low.* FROM low WHERE k = 3 OR NOT EXISTS (SELECT 1 FROM part WHERE part.lang = low.lang AND part.p = low.p AND 100 * part.a >= 50 * low.a)),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, score FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
