"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH d AS (
  SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
c AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * source_size AS cap FROM r),
f AS (
  SELECT *, (sum(cap) OVER o - cap)::DOUBLE AS caps, (sum(w) OVER o - w)::DOUBLE AS ws,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget, (sum(w) OVER ())::DOUBLE AS total_w
  FROM c WINDOW o AS (ORDER BY cap::DOUBLE / w::DOUBLE, rk ROWS UNBOUNDED PRECEDING)),
l AS (SELECT max((budget - caps) / (total_w - ws)) AS v FROM f),
t AS (SELECT source, source_size, w, budget, least(cap::DOUBLE, w::DOUBLE * (SELECT v FROM l)) AS target FROM f),
q AS (
  SELECT d.doc_id, d.k, d.size, t.source, t.source_size, t.w, t.budget, t.target,
         row_number() OVER (ORDER BY d.k, d.doc_id, d.size, t.source) AS rid,
         (sum(d.size) OVER (PARTITION BY t.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT q.*, pass, pos + pass * source_size AS start, (pos + pass * source_size + size)::DOUBLE / w::DOUBLE AS finish
  FROM q, (VALUES (0), (1)) AS two(pass) WHERE size > 0),
e AS (SELECT *, start + size = 2 * source_size AS is_last FROM p),
x AS (
  SELECT *, coalesce(sum(CASE WHEN is_last THEN 2 * source_size END) OVER o, 0)::DOUBLE AS gone,
         ((SELECT sum(w) FROM t) - coalesce(sum(CASE WHEN is_last THEN w END) OVER o, 0))::DOUBLE AS busy
  FROM e WINDOW o AS (ORDER BY finish, source NULLS LAST, pass, k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, gone + finish * busy AS spent FROM x),
y AS (SELECT (budget - gone) / busy AS v FROM z WHERE spent > budget
      ORDER BY finish, source NULLS LAST, pass, k, doc_id, size LIMIT 1),
g AS (
  SELECT rid, sum(CASE WHEN spent <= budget THEN size
                       ELSE least(size, greatest(0, floor(w * (SELECT v FROM y) - start + 0.5)::BIGINT)) END)::BIGINT AS taken
  FROM z GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN g USING (rid)
"""

def _dot(a: str, b: str) -> str:
    """Sum of products in component order, in double precision."""
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE), "
            "lambda x, y: x + y)")


USABLE = """
v AS (
  SELECT vec_id, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""

NEAREST = f"""
WITH {USABLE},
w AS (SELECT *, sqrt({_dot('e', 'e')}) AS n FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {_dot('q.e', 'c.e')} / (q.n * c.n) AS score
      FROM w q JOIN w c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= 5
"""

LINKED = f"""
WITH RECURSIVE {USABLE},
w AS (SELECT *, sqrt({_dot('e', 'e')}) AS n FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM w a JOIN w b ON a.vec_id <> b.vec_id
      WHERE {_dot('a.e', 'b.e')} / (a.n * b.n) >= 0.95),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(component_id, vec_id)) AS component_id,
       vec_id <= coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN k ON vec_id = k.a
"""

CHATS = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place FROM t),
w AS (SELECT conv_id, list([role, text] ORDER BY place) AS turns FROM p GROUP BY conv_id),
s AS (SELECT min(conv_id) AS conv_id, turns FROM w GROUP BY turns),
x AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM w)),
m AS (SELECT conv_id FROM s WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.turns = s.turns))
SELECT conv_id, (place // 256)::BIGINT AS segment, count(*) AS n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS text
FROM p SEMI JOIN m USING (conv_id) GROUP BY conv_id, place // 256
"""

LINES = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
o AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM d),
l AS (SELECT doc_id, ls[i] AS line, i - 1 AS pos FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM o)),
k AS (SELECT doc_id, pos, list_sort(list_distinct(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+'))) AS ts FROM l),
f AS (SELECT doc_id, pos, ts, row_number() OVER (PARTITION BY ts ORDER BY doc_id, pos) AS nth FROM k WHERE len(ts) > 0),
c AS (SELECT row_number() OVER (ORDER BY doc_id, pos) AS cid, doc_id, pos, ts FROM f WHERE nth = 1),
u AS (SELECT cid, len(ts) AS n, unnest(ts) AS t FROM c),
df AS (SELECT t, count(*) AS m FROM u GROUP BY t),
r AS (SELECT cid, n, u.t, row_number() OVER (PARTITION BY cid ORDER BY m, u.t) AS i FROM u JOIN df ON u.t = df.t),
px AS (SELECT * FROM r WHERE i <= n - (n * 80 + 99) // 100 + 1),
cand AS (SELECT DISTINCT a.cid AS a, b.cid AS b FROM px a JOIN px b ON a.t = b.t AND a.cid < b.cid
         AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80),
near AS (
  SELECT DISTINCT y.doc_id, y.pos FROM cand JOIN c x ON x.cid = cand.a JOIN c y ON y.cid = cand.b
  WHERE len(list_intersect(x.ts, y.ts)) * 180 >= 80 * (len(x.ts) + len(y.ts))),
gone AS (SELECT doc_id, pos FROM f WHERE nth > 1 UNION SELECT doc_id, pos FROM near),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS text FROM l ANTI JOIN gone
  ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id),
g AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(string_split(documents.text, chr(10))), 0)::BIGINT AS n_lines,
       coalesce(g.n, 0)::BIGINT AS n_removed,
       CASE WHEN documents.text IS NOT NULL THEN md5(coalesce(kept.text, '')) END AS text_md5
FROM documents LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

def _item_words(table: str, key: str) -> str:
    return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}")


PASSAGES = f"""
WITH d AS ({_item_words('documents', 'doc_id')}),
b AS ({_item_words('benchmark', 'item_id')}),
k AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS x
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
o AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS x
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM k) WHERE len(w) >= k)),
h AS (SELECT o.doc_id, o.i, o.k, k.item_id FROM o JOIN k ON o.k = k.k AND o.x = k.x),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) WHERE item IS NOT NULL GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

TRIE = """
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda x, n: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
              ORDER BY i) AS tab FROM range(256) AS t(i)),
o AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
           lambda x, b: xor(x >> 8, tab[(xor(x, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM o, crc),
r AS (
  SELECT h.conv_id, coalesce(o.turns[1:h.h], []) || coalesce(h.turns[h.h + 1:], []) AS turns
  FROM h LEFT JOIN o ON o.conv_id = h.conv_id - h.conv_id % 5),
v AS (SELECT conv_id, d AS depth, turns[1:d] AS prefix, d = len(turns) AS is_end FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256,
         CASE WHEN depth > 0 THEN (count(*) - 1) * strlen(prefix[depth].text) ELSE 0 END AS saved
  FROM v GROUP BY depth, prefix),
w AS (SELECT v.conv_id, v.depth, n.conv_id AS node FROM v JOIN n ON n.depth = v.depth AND n.prefix = v.prefix),
k AS (SELECT w.node, w.depth, count(*) AS n_children FROM n JOIN w ON w.conv_id = n.conv_id AND w.depth = n.depth - 1 GROUP BY ALL),
m AS (SELECT n.conv_id, n.depth, n.saved, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.node = n.conv_id AND k.depth = n.depth),
s AS (
  SELECT w.node, w.depth, sum(m.saved) AS saved, count(*) FILTER (m.n_children = 0) AS n_leaves
  FROM m JOIN w ON w.conv_id = m.conv_id AND w.depth <= m.depth GROUP BY w.node, w.depth)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.node AS parent_conv_id, n.n_convs, m.n_children, s.n_leaves,
       s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN m ON m.conv_id = n.conv_id AND m.depth = n.depth JOIN s ON s.node = n.conv_id AND s.depth = n.depth
LEFT JOIN w p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
"""

GROUPS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS x
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op10_ngram_join": GROUPS,
    "op12_fingerprint_trie": TRIE,
    "op11_wu_manber_leaks": PASSAGES,
    "op1_pq_near_dedup": LINKED,
    "op5_line_dedup": LINES,
    "op6_weighted_fair_mix": MIX,
    "op7_snapshot_collapse": CHATS,
    "op8_balanced_postings": NEAREST,
}
