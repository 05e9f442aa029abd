"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from .quality_rules import _UPPER, Limits

#: Words are runs of bytes other than space and 0x09-0x0D.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_L = Limits()

#: One character in place of each of U+00C0 to U+00FF, as DuckDB's levenshtein counts bytes.
_ACCENTS = "".join(map(chr, range(0xC0, 0x100)))
_STAND_INS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).islower() and chr(c) not in "'")[:64]


def _rounds(n: int) -> str:
    """CTEs of ``n`` rounds of assignment and means; c0 holds the first centroids, c<n> the last."""
    out = []
    for i in range(n):
        out.append(f"""
a{i} AS (SELECT v.x, arg_min(c.cluster, (list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster)) AS cluster
  FROM v CROSS JOIN c{i} c GROUP BY v.row, v.x),
m{i} AS (SELECT cluster, place, sum(part)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(x) AS part, unnest(range(64)) AS place FROM a{i}) GROUP BY ALL),
c{i + 1} AS (SELECT c.cluster, coalesce(any_value(m.x), c.x) AS x FROM c{i} c
  LEFT JOIN (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS x FROM m{i} GROUP BY cluster) m USING (cluster) GROUP BY c.cluster, c.x)""")
    return ",".join(out)

ORACLE: dict[str, str] = {
    "op2_substring_dedup": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
starts AS (
  SELECT doc_id, place, array_to_string(words[place:place + 49], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS place FROM docs WHERE len(words) >= 50)
),
firsts AS (SELECT w, min(doc_id) AS first FROM starts GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 50)) AS place
  FROM starts JOIN firsts USING (w) WHERE doc_id > first
),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
kept AS (
  SELECT e.doc_id, count(*) FILTER (WHERE g.place IS NOT NULL) AS n_removed,
    coalesce(string_agg(e.word, ' ' ORDER BY e.place) FILTER (WHERE g.place IS NULL), '') AS body
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.place = e.place GROUP BY e.doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
""",
    "op9_quality_rules": f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, place, array_to_string(words[place:place + 4], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS place FROM docs WHERE len(words) >= 5)
),
again AS (SELECT doc_id, place FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(place, place + 5)) AS place FROM again) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
),
base AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(l.n, 0) AS n_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    length(text) - length(replace(text, '!', '')) AS bangs,
    length(text) - length(regexp_replace(text, '[{_UPPER}]', '', 'g')) AS uppers
  FROM docs d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {_L.min_words} OR 100 * n_repeat_words > {_L.repeat_percent} * n_words AS base_failed,
  NOT (n_words < {_L.min_words} OR 100 * n_repeat_words > {_L.repeat_percent} * n_words)
    AND n_symbols <= {_L.symbols_per_word}::DOUBLE * n_words AND bangs <= {_L.bangs_per_word}::DOUBLE * n_words
    AND uppers <= {_L.upper_share}::DOUBLE * word_chars AND n_dup_lines <= {_L.dup_line_share}::DOUBLE * n_lines
    AND word_chars >= {_L.word_chars[0]}::DOUBLE * n_words AND word_chars <= {_L.word_chars[1]}::DOUBLE * n_words AS kept
FROM base
""",
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
),
good AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE list_count(e) = len(e)),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.norm > 0 AND b.norm > 0 AND isfinite(a.norm) AND isfinite(b.norm) AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links,
  r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = e.vec_id
""",
    "op10_suffix_dedup": """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
starts AS (
  SELECT doc_id, place, substr(hx, 2 * place + 1, 100) AS w
  FROM (SELECT doc_id, hx, unnest(range(0, length(hx) // 2 - 49)) AS place FROM docs WHERE length(hx) >= 100)
),
firsts AS (SELECT w, min(doc_id) AS first FROM starts GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, place FROM starts JOIN firsts USING (w) WHERE doc_id > first),
runs AS (
  SELECT doc_id, min(place) AS lo, max(place) + 50 AS hi
  FROM (SELECT *, sum(CASE WHEN place <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY place) AS run
    FROM (SELECT *, coalesce(lag(place) OVER (PARTITION BY doc_id ORDER BY place), -100) AS before FROM hits))
  GROUP BY doc_id, run
),
edges AS (
  SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS since, row_number() OVER (PARTITION BY doc_id ORDER BY lo DESC) AS back FROM runs
),
kept AS (
  SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans,
    string_agg(substr(hx, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) || max(CASE WHEN back = 1 THEN substr(hx, 2 * hi + 1) END) AS body
  FROM edges JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, (length(hx) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(body, hx))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
""",
    "op11_centroid_clustering": f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(e, lambda z: floor(64 * z)::BIGINT) AS x
  FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
  WHERE len(e) = 64 AND list_count(e) = 64 AND list_count(list_filter(e, lambda z: abs(z) < 2097152)) = 64
),
c0 AS (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS cluster, x
  FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT 16)
),{_rounds(3)},
met AS (SELECT v.row, v.vec_id, c.cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance FROM v CROSS JOIN c3 c),
last AS (SELECT vec_id, cluster, distance FROM met QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM last JOIN c3 c USING (cluster)
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
),
found AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
crcs AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)
),
hashed AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN NULL ELSE xor(4294967295, list_reduce(
    flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda z: CASE WHEN unicode(z) < 128 THEN [unicode(z)::BIGINT] ELSE [192 + (unicode(z) >> 6)::BIGINT, 128 + (unicode(z) & 63)::BIGINT] END)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) END AS h
  FROM found, crcs
),
results AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
coded AS (SELECT word, n, length(word) AS size, translate(word, '{_ACCENTS}', '{_STAND_INS}') AS code FROM words),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM coded a JOIN coded b ON b.size BETWEEN a.size - 1 AND a.size + 1 WHERE levenshtein(a.code, b.code) = 1),
best AS (
  SELECT word, count(*) AS n_near, (list(other ORDER BY other_n DESC, other))[1] AS form, max(other_n) AS form_n FROM near GROUP BY word
),
forms AS (
  SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
),
walk AS (SELECT word, word AS at FROM forms UNION SELECT w.word, f.form FROM walk w JOIN forms f ON f.word = w.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w ON w.word = f.word JOIN forms g ON g.word = w.at AND g.form IS NULL
""",
}
