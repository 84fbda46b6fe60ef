"""SQL over the given tables for the operators that SQL can express."""

OP1_JACCARD_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""

OP3_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_page THEN first_page END AS refers_to
FROM f
"""

OP6_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, 2 * source_size AS cap,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS k FROM w
), l AS (
  SELECT k,
    (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM s)
      - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
      / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS level,
    cap / weight AS ratio
  FROM o
), level AS (
  SELECT min_by(level, k) AS level FROM l WHERE ratio > level OR level = 0
), t AS (
  SELECT w.*, CASE WHEN cap <= weight * level THEN cap::DOUBLE ELSE weight * level END AS target FROM w, level
), p AS (
  SELECT *, floor(target + 0.5)::BIGINT // greatest(source_size, 1) AS whole,
    floor(target + 0.5)::BIGINT % greatest(source_size, 1) AS extra
  FROM t
), c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY digest, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM d
)
SELECT c.doc_id, c.size, p.source_size, p.target,
  (p.whole * c.size + greatest(0, least(c.size, p.extra - c.before)))::BIGINT AS taken
FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source
"""

OP8_HAMMING_SEARCH = """
WITH c AS (
  SELECT vec_id, list_transform(embedding, lambda x: (x > 0)::INT) AS bits FROM embeddings WHERE embedding IS NOT NULL
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(generate_series(1, 64), lambda i: (q.bits[i] <> c.bits[i])::INT))::INT AS distance
  FROM c q JOIN c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank FROM p
)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""

OP12_DECONTAMINATE = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM benchmark
), w AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n,
    unnest(list_transform(generate_series(1, len(ws) - least(len(ws), 10) + 1),
      lambda i: array_to_string(ws[i:i + least(len(ws), 10) - 1], ' '))) AS win
  FROM b WHERE len(ws) > 0
), n AS (
  SELECT DISTINCT n FROM w
), p AS (
  SELECT doc, n.n, unnest(generate_series(1, len(ws) - n.n + 1)) AS pos, ws FROM d, n WHERE len(ws) >= n.n
), h AS (
  SELECT p.doc, p.pos, p.n, w.item_id FROM p JOIN w ON w.n = p.n AND w.win = array_to_string(p.ws[p.pos:p.pos + p.n - 1], ' ')
), k AS (
  SELECT doc, count(DISTINCT place) AS n_hit FROM (SELECT doc, unnest(generate_series(pos, pos + n - 1)) AS place FROM h) GROUP BY doc
), i AS (
  SELECT doc, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT doc, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY doc
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(k.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.items, '')) AS items_sha256, coalesce(k.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc) LEFT JOIN i USING (doc)
"""

# The checksum by halves of bytes: the remainder of each of sixteen halves by the reversed polynomial.
_POLYNOMIAL = 0xEDB88320


def _remainder(half: int) -> int:
    for _ in range(4):
        half = half >> 1 ^ _POLYNOMIAL * (half & 1)
    return half


OP11_SPELLING = rf"""
WITH RECURSIVE r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), x AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS hex
  FROM r WHERE length(run) >= 7 GROUP BY ALL
), b AS (
  SELECT run, n, list_transform(generate_series(0, length(hex) - 1),
    lambda k: (instr('0123456789ABCDEF', hex[k + 2 - 2 * (k % 2)]) - 1)::BIGINT) AS halves
  FROM x
), c AS (
  SELECT run, n, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, halves), lambda crc, half:
    xor(list_extract({[_remainder(k) for k in range(16)]}::BIGINT[], xor(crc, half) % 16 + 1), crc // 16))) AS h
  FROM b
), w AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2)
    ELSE run END AS word
  FROM c
), v AS (
  SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), i AS (
  SELECT word, n, unnest(generate_series(1, length(word))) AS k FROM v
), d AS (
  SELECT word, n, k, substring(word, 1, k - 1) || substring(word, k + 1) AS rest FROM i
), p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = d.rest
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.rest
), o AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM p
), f AS (
  SELECT v.word, v.n, coalesce(o.n_near, 0)::BIGINT AS n_near, CASE WHEN o.near_n >= 10 * v.n THEN o.near END AS form,
    CASE WHEN o.near_n >= 10 * v.n THEN o.near_n END AS form_n
  FROM v LEFT JOIN o ON o.word = v.word AND o.k = 1
), t(word, root) AS (
  SELECT word, word FROM f WHERE form IS NULL
  UNION ALL
  SELECT f.word, t.root FROM f JOIN t ON f.form = t.word
)
SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM f JOIN t USING (word)
"""

OP13_TREAP_SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id, unnest(list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM documents
), t AS (
  SELECT doc, doc_id, term, count(*) AS tf FROM d GROUP BY ALL
), n AS (
  SELECT doc, sum(tf)::BIGINT AS n FROM t GROUP BY doc
), s AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n
), f AS (
  SELECT term, count(*) AS df FROM t GROUP BY term
), b AS (
  SELECT item_id, unnest(list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), w AS (
  SELECT item_id, term, count(*) * floor(1000 * ln((2 * s.docs + 2) / (2 * f.df + 1)))::BIGINT AS w
  FROM b JOIN f USING (term), s GROUP BY item_id, term, s.docs, f.df
), r AS (
  SELECT w.item_id, t.doc, t.doc_id, sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (100 - 25 + (25 * n.n * s.docs) // s.terms))))::BIGINT AS score
  FROM w JOIN t USING (term) JOIN n USING (doc), s GROUP BY w.item_id, t.doc, t.doc_id
), k AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM r WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""

SQL = {
    "op8_hamming_search": OP8_HAMMING_SEARCH,
    "op6_mixing": OP6_MIXING,
    "op1_jaccard_join": OP1_JACCARD_JOIN,
    "op3_warc": OP3_WARC,
    "op11_spelling": OP11_SPELLING,
    "op12_decontaminate": OP12_DECONTAMINATE,
    "op13_treap_search": OP13_TREAP_SEARCH,
}
