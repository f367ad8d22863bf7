"""The results that SQL can express, as DuckDB SQL over the same tables."""

OP1 = r"""
WITH RECURSIVE texts AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS ws FROM documents),
grams AS (
 SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS g
 FROM texts, UNNEST(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS s FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * s >= 80 * (p.n + q.n - s)),
sides AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x AS doc_id, y AS other FROM sides UNION SELECT r.doc_id, b.y FROM reach r JOIN sides b ON r.other = b.x)
SELECT d.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles,
 least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id"""

OP5 = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM texts, UNNEST(range(1, len(ws) - 11)) AS t(i)),
firsts AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM windows JOIN firsts USING (g), range(0, 13) AS r(j) WHERE least < doc_id),
words AS (SELECT doc_id, p, ws[p] AS w FROM texts, UNNEST(range(1, len(ws) + 1)) AS t(p)),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
 sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)"""

OP7 = """
WITH vectors AS (
 SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scores AS (
 SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
  CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
 FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20"""

# The checksum is not built in: its table comes from the polynomial, a letter beyond 127 is two bytes.
OP13 = r"""
WITH RECURSIVE runs AS (
 SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
 FROM documents),
counted AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY 1, 2),
crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
 FROM range(256) AS r(i)),
summed AS (
 SELECT run, times, doc_id, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
  string_split(doc_id || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [195, ord(x) - 64] END))),
  lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)]))) AS h
 FROM counted, crc),
typed AS (
 SELECT CASE WHEN doc_id IS NOT NULL AND h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
  ELSE run END AS word, times FROM summed),
vocabulary AS (
 SELECT word, CAST(sum(times) AS BIGINT) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM vocabulary, UNNEST(range(1, length(word) + 1)) AS u(i)),
near AS (
 SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
 UNION SELECT a.word, v.word, v.n FROM cuts a JOIN vocabulary v ON v.word = a.rest
 UNION SELECT v.word, a.word, a.n FROM cuts a JOIN vocabulary v ON v.word = a.rest),
best AS (SELECT word, count(*) AS n_near, max(n) AS most, arg_min(other, (-n, other)) AS other FROM near GROUP BY word),
found AS (
 SELECT v.word, CASE WHEN most >= 2 * v.n THEN other END AS form, v.n, coalesce(n_near, 0) AS n_near,
  CASE WHEN most >= 2 * v.n THEN most END AS form_n FROM vocabulary v LEFT JOIN best USING (word)),
path AS (
 SELECT word, word AS at FROM found UNION ALL SELECT p.word, f.form FROM path p JOIN found f ON f.word = p.at WHERE f.form IS NOT NULL),
ends AS (SELECT p.word, p.at AS root FROM path p JOIN found f ON f.word = p.at WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM found f JOIN ends e USING (word)"""
