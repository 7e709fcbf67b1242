"""DuckDB SQL for those of the queries that SQL can express on whole tables."""

from __future__ import annotations

OP4 = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages
), p AS (
  SELECT page_id,
    translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(rhost, rpath, action) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), hit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(action, length(rhost || rpath)) AS action
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT p.page_id, host, path, rule,
  coalesce(action, CASE WHEN regexp_matches(host, 'casino|free-bets|cheap-pills|porn|malware')
                        THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN hit USING (page_id)
"""

OP2 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id,
    list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), g AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), h AS (
  SELECT r, i, n, item_id
  FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT d.r, d.w, s.n, unnest(range(1, len(d.w) - s.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) s WHERE len(d.w) >= s.n)
       ) JOIN g USING (win, n)
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM h) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

OP3 = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, e,
    label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0 AS ok
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
), links AS (
  SELECT a.r AS x, b.r AS y, b.vec_id AS other FROM (SELECT * FROM v WHERE ok) a JOIN (SELECT * FROM v WHERE ok) b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.93
), reach AS (
  SELECT r AS x, r AS y FROM v
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), component AS (
  SELECT reach.x AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.y GROUP BY reach.x
), n AS (SELECT x AS r, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN component USING (r) LEFT JOIN n USING (r)
"""

OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS p
  FROM g JOIN (SELECT win FROM g GROUP BY win HAVING count(*) > 1) USING (win)
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), size AS (
  SELECT count(*) FILTER (len(words) > 0) AS docs, CAST(sum(len(words)) AS BIGINT) AS total FROM d
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), p AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d) SEMI JOIN q USING (term) GROUP BY r, term
), f AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, size GROUP BY term
), part AS (
  SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(words) * docs) // total))) AS adds
  FROM p JOIN f USING (term) JOIN d USING (r), size
), s AS (
  SELECT item_id, doc_id, r, CAST(sum(adds) AS BIGINT) AS score FROM part JOIN q USING (term) GROUP BY ALL HAVING sum(adds) > 0
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score
FROM s QUALIFY rank <= 50
"""

OP12 = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
), runs AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w
    FROM documents) WHERE length(w) >= 7 GROUP BY doc_id, w
), h AS (
  SELECT w, n, xor(4294967295, list_reduce(
    list_transform(range(1, length(x), 2), lambda i: 16 * (strpos('0123456789ABCDEF', x[i]) - 1) + strpos('0123456789ABCDEF', x[i + 1]) - 1),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS h
  FROM (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM runs), crc
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN w[1:(h % length(w))] || w[(h % length(w)) + 2:] ELSE w END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, n, i, word[1:i - 1] AS p, word[i + 1:] AS s FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), near AS (
  SELECT DISTINCT word, other, other_n FROM (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.p = b.p AND a.s = b.s AND a.word <> b.word
    UNION ALL SELECT a.word, v.word, v.n FROM cut a JOIN v ON a.p || a.s = v.word
    UNION ALL SELECT v.word, a.word, a.n FROM cut a JOIN v ON a.p || a.s = v.word)
), f AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS form, max(other_n) AS form_n FROM near GROUP BY word
), formed AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
         CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM v LEFT JOIN f USING (word)
), chain AS (
  SELECT word, word AS tail FROM formed
  UNION ALL SELECT c.word, g.form FROM chain c JOIN formed g ON g.word = c.tail WHERE g.form IS NOT NULL
)
SELECT word, formed.form, tail AS root, n, n_near, form_n
FROM formed JOIN (SELECT c.word, c.tail FROM chain c JOIN formed g ON g.word = c.tail WHERE g.form IS NULL) USING (word)
"""

# Bytes as pairs of hex digits; windows of 50 bytes, their smallest document, and what lies between the removed spans.
OP9 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM d, unnest(range(0, length(h) // 2 - 49)) AS u(i) WHERE length(h) >= 100
), m AS (
  SELECT g, min(doc_id) AS least FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)
), hit AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM w JOIN m USING (g) WHERE least < doc_id
), numbered AS (
  SELECT r, i, count(*) FILTER (p IS NULL OR i > p + 50) OVER (PARTITION BY r ORDER BY i) AS k FROM hit
), spans AS (
  SELECT r, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY r, k
), pieces AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM spans
  UNION ALL SELECT r, max(b), 1000000000 FROM spans GROUP BY r
), kept AS (
  SELECT r, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k FROM pieces JOIN d USING (r) GROUP BY r
), removed AS (
  SELECT r, sum(b - a) AS n, count(*) AS spans FROM spans GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)
"""

ORACLE: dict[str, str] = {
    "op2_decontamination": OP2,
    "op3_vectors": OP3,
    "op4_url_filter": OP4,
    "op6_substrings": OP6,
    "op9_suffixes": OP9,
    "op11_lexical": OP11,
    "op12_spelling": OP12,
}
