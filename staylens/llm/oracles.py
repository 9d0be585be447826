"""DuckDB SQL for the operators' queries that SQL can express; the rest is
tested against brute force in tests/llm."""

from __future__ import annotations

from staylens.llm import blob_ledger

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT k FROM windows
), grams AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k)
), hits AS (
  SELECT g.doc_id, g.k, g.i, x.item FROM grams g JOIN windows x ON x.k = g.k AND x.gram = g.gram
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

#: Smallest node that can be reached, by following links from every node.
_REACH = """
reach(node, root) AS (
  SELECT DISTINCT a, a FROM links
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node WHERE r.root < l.b
), comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
"""

_OP4 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), {_REACH}
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(root, d.doc_id) AS component_id, coalesce(root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN comp ON node = d.doc_id
"""

_OP5 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
         CASE WHEN contains(lower(coalesce(text, '')), 'license') THEN 'license' WHEN contains(coalesce(text, ''), '@') THEN 'contact'
              WHEN length(coalesce(text, '')) < 1000 THEN 'note' WHEN length(text) < 4000 THEN 'article' ELSE 'long read' END AS topic,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r]+')) AS n_tokens
  FROM documents
), cells AS (
  SELECT source, lang, topic, sum(n_tokens) AS t FROM docs GROUP BY ALL
), total AS (SELECT sum(t) AS total FROM cells),
ms AS (SELECT source, pow(sum(t), 0.7) AS v FROM cells WHERE t > 0 GROUP BY 1),
ml AS (SELECT lang, pow(sum(t), 0.7) AS v FROM cells WHERE t > 0 GROUP BY 1),
mt AS (SELECT topic, pow(sum(t), 0.7) AS v FROM cells WHERE t > 0 GROUP BY 1),
goal AS (
  SELECT c.*, total * ms.v / (SELECT sum(v) FROM ms) AS gs, total * ml.v / (SELECT sum(v) FROM ml) AS gl, total * mt.v / (SELECT sum(v) FROM mt) AS gt
  FROM cells c JOIN ms USING (source) JOIN ml USING (lang) JOIN mt USING (topic), total WHERE t > 0
), raked AS (
  SELECT source, lang, topic, t, gs, gl, gt, CAST(t AS DOUBLE) AS w, 0 AS n FROM goal
  UNION ALL
  SELECT source, lang, topic, t, gs, gl, gt, w * gt / sum(w) OVER (PARTITION BY topic), n + 1 FROM (
    SELECT * REPLACE (w * gl / sum(w) OVER (PARTITION BY lang) AS w) FROM (
      SELECT * REPLACE (w * gs / sum(w) OVER (PARTITION BY source) AS w) FROM raked WHERE n < 60))
), weights AS (
  SELECT c.source, c.lang, c.topic, coalesce(w / c.t, 1.0) AS weight
  FROM cells c LEFT JOIN (SELECT * FROM raked WHERE n = 60) r ON r.source = c.source AND r.lang = c.lang AND r.topic = c.topic
)
SELECT doc_id, source, lang, topic, CAST(n_tokens AS BIGINT) AS n_tokens, round(weight, 6) AS weight, round(weight / top, 6) AS probability,
       CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':20240229'), 1, 12)) AS BIGINT) / 281474976710656.0 < weight / top AS kept
FROM docs JOIN weights USING (source, lang, topic), (SELECT max(weight) AS top FROM weights)
"""

_CANONICAL = r"""
regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), ':(80|443)$', ''), '^www\.', '') ||
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '^[^/?]*', ''), '([?&])(utm_[a-z]+|ref)=[^&]*', '\1', 'g'), '&+', '&', 'g'), '\?&', '?', 'g'), '[?&/]+$', '')
"""

_OP8 = rf"""
WITH p AS (
  SELECT page_id, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u, md5(coalesce(html, '')) AS digest,
         page_id * 3600 AS t1, (page_id + 1 + page_id * 7919 % 50) * 3600 + 1800 AS t2
  FROM pages
), q AS (
  SELECT *, {_CANONICAL} AS url_key, substr(digest, 1, 12) AS etag FROM p
), asked AS (
  SELECT a.page_id * 2 + 1 AS record_id, a.url_key, a.t2, a.digest, CASE WHEN a.page_id % 7 = 3 THEN 'x' || a.etag ELSE a.etag END AS etag,
         (SELECT max({{'t': b.t1, 'id': b.page_id * 2, 'digest': b.digest, 'etag': b.etag}}) FROM q b
          WHERE b.url_key = a.url_key AND b.page_id % 11 <> 5 AND (b.t1 < a.t2 OR b.t1 = a.t2 AND b.page_id * 2 < a.page_id * 2 + 1)) AS r
  FROM q a
)
SELECT record_id, url_key, r.id AS target_id,
       CASE WHEN r IS NULL THEN 'orphan' WHEN etag <> r.etag THEN 'mismatch' ELSE 'resolved' END AS status,
       CASE WHEN etag = r.etag THEN r.digest END AS payload_digest,
       CASE WHEN etag = r.etag THEN '{{"content-type":"text/html","date":"' || t2 || '","etag":"' || etag || '"}}' END AS headers
FROM asked
"""

_OP10 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), n AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l FROM v WHERE list_dot_product(e, e) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.vec_id <> y.vec_id WHERE list_dot_product(x.e, y.e) / (x.l * y.l) >= 0.95
), {_REACH}
SELECT e.vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, coalesce(root, e.vec_id) AS component_id, coalesce(root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS k FROM links GROUP BY a) ON a = e.vec_id LEFT JOIN comp ON node = e.vec_id
"""

_OP11 = rf"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS d, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), sizes AS (
  SELECT d, doc_id, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes
), postings AS (
  SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM words) GROUP BY ALL
), wanted AS (
  SELECT i, t, count(*) AS q FROM (
    SELECT i, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT *, row_number() OVER () AS i FROM benchmark)) GROUP BY ALL
), weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS v
  FROM (SELECT t, count(*) AS df FROM postings WHERE t IN (SELECT t FROM wanted) GROUP BY t), corpus
), scored AS (
  SELECT i, d, CAST(sum(q * v * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (t) JOIN postings USING (t) JOIN sizes USING (d), corpus GROUP BY ALL
), ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS r FROM scored JOIN sizes USING (d) WHERE score > 0
)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked JOIN (SELECT *, row_number() OVER () AS i FROM benchmark) USING (i) WHERE r <= 20
"""


#: The reflected CRC-32 step, eight bits a byte.
_CRC = "list_reduce(range(8), lambda v, k: xor(v // 2, v % 2 * 3988292384), {0})"

_OP12 = f"""
WITH turns AS (
  SELECT conv_id AS c, octet_length(encode(coalesce(text, ''))) AS b, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 5 AS first,
         xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, x: {_CRC.format("xor(a, x)")}, 4294967295), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT convs.c, 0 AS part, pos, k, b FROM convs JOIN turns ON turns.c = convs.first AND pos <= h
  UNION ALL
  SELECT convs.c, 1, pos, k, b FROM convs JOIN turns ON turns.c = convs.c AND pos > h
), placed AS (
  SELECT c, k, b, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d FROM rebuilt
), paths AS (
  SELECT c, d, b, string_agg(k, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM placed
  UNION ALL
  SELECT c, 0, 0, '' FROM convs
), members AS (
  SELECT *, d = max(d) OVER (PARTITION BY c) AS ends FROM paths
), nodes AS (
  SELECT path, d, any_value(b) AS b, min(c) AS conv_id, count(*) AS n, bool_and(ends) AS leaf,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, d
), subtree AS (
  SELECT left(path, 64 * a) AS path, count(*) FILTER (leaf) AS leaves, sum((n - 1) * b) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM nodes) GROUP BY 1
), children AS (
  SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
)
SELECT u.conv_id, CAST(u.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(u.n AS BIGINT) AS n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, u.ends_sha256
FROM nodes u JOIN subtree USING (path) LEFT JOIN children USING (path) LEFT JOIN nodes p ON u.d > 0 AND p.path = left(u.path, 64 * (u.d - 1))
"""


def _secrets(rules) -> str:
    found = []
    for rank, r in enumerate(rules):
        p = r.pattern.replace("'", "''")
        found.append(f"""
  SELECT d, {rank} AS rank, '{r.kind}' AS kind, i, len(m) AS size, len(g) AS counted, {r.min_chars} AS least,
         sum(len(x) + len(m)) OVER (PARTITION BY d ORDER BY i) AS e
  FROM (SELECT d, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gs) AS g, unnest(xs[1 : len(ms)]) AS x
        FROM (SELECT d, regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', {r.group}) AS gs, string_split_regex(t, '{p}') AS xs FROM texts))""")
    base = f"FILTER (rank < {len(blob_ledger.BASE_RULES)})"
    counts = ", ".join(f"CAST(coalesce(count(s) FILTER (rank = {k}), 0) AS BIGINT) AS n_{r.kind}" for k, r in enumerate(blob_ledger.BASE_RULES))
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({" UNION ALL".join(found)}
), spans AS (
  SELECT d, rank, e - size AS s, kind || ':' || CAST(e - size AS BIGINT) || ':' || CAST(e AS BIGINT) AS span FROM found WHERE counted >= least
)
SELECT doc_id, {counts}, sha256(coalesce(string_agg(span, ',' ORDER BY s, rank) {base}, '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY s, rank), '') AS spans
FROM texts LEFT JOIN spans USING (d) GROUP BY d, doc_id
"""


ORACLE: dict[str, str] = {
    "op1_decontamination": _OP1,
    "op4_minhash": _OP4,
    "op5_mixture": _OP5,
    "op8_revisits": _OP8,
    "op10_embedding_dedup": _OP10,
    "op11_lexical_search": _OP11,
    "op12_prefix_trie": _OP12,
    "op13_secret_scan": _secrets(blob_ledger.RULES),
}
