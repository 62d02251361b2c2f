"""SQL (DuckDB) for the queries that it can express, written from the definitions alone."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Smallest id that is reachable, from edges e(x, y) with x < y.
_REACH = """ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(id, c) AS (SELECT x, x FROM ways UNION SELECT ways.x, r.c FROM r JOIN ways ON ways.y = r.id),
comp AS (SELECT id, min(c) AS c FROM r GROUP BY id)"""

NEAR_TEXTS = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w) q),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
{_REACH}
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, w.doc_id) AS component_id, coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.id = w.doc_id"""

NEAR_VECTORS = f"""WITH RECURSIVE u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS l FROM embeddings WHERE len(embedding) > 0),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v) AND a.l > 0 AND b.l > 0 AND list_dot_product(a.v, b.v) / (a.l * b.l) >= 0.9),
{_REACH}, k AS (SELECT x, count(*) AS n FROM ways GROUP BY x)
SELECT vec_id, coalesce(k.n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN k ON k.x = vec_id LEFT JOIN comp ON comp.id = vec_id"""


def _spans(kind: int, pattern: str, keep: str = "true") -> str:
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""SELECT doc_id, {kind} AS kind, start, start + length(m) AS stop FROM (SELECT doc_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
  CAST(coalesce(list_sum(list_transform(gs[1:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0) AS BIGINT))) AS start
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {quoted}) AS ms, string_split_regex(coalesce(text, ''), {quoted}) AS gs FROM documents) q) s WHERE {keep.format(quoted)}"""


def secrets(rules: dict[str, str], base: list[str]) -> str:
    """All rules by plain scans of every text."""
    keep = {"assign": "length(regexp_extract(m, {}, 2)) >= 6"}
    parts = " UNION ALL ".join(_spans(i, p, keep.get(n, "true")) for i, (n, p) in enumerate(rules.items()))
    names = "[" + ", ".join(f"'{n}'" for n in rules) + "]"
    said = f"{names}[kind + 1] || ':' || start || ':' || stop"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{n}" for i, n in enumerate(base))
    return f"""WITH s AS ({parts}) SELECT d.doc_id, {counts}, sha256(coalesce(string_agg({said}, ',' ORDER BY start, kind) FILTER (WHERE kind < {len(base)}), '')) AS base_sha256,
  coalesce(string_agg({said}, ',' ORDER BY start, kind), '') AS spans FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""


COLLOCATIONS = f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3], lambda d: list_transform(range(1, len(ws) - d + 2), lambda i: ws[i:i + d - 1])))) AS g FROM w),
f AS (SELECT lang, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE len(g) >= 2 AND f >= 10),
h AS (SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, f, array_to_string(unnest([g[1:2], g[2:3]]), ' ') AS phrase FROM c WHERE len(g) = 3) GROUP BY ALL),
k AS (SELECT c.lang, c.phrase, c.g, c.f AS a FROM c LEFT JOIN h USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * c.f),
t AS (SELECT *, unnest(range(1, len(g))) AS k FROM k),
s AS (SELECT t.lang, t.phrase, t.a, t.k, x.f AS l, y.f AS r, (1000000::HUGEINT * t.a * t.a // (x.f::HUGEINT * y.f))::BIGINT AS score FROM t
  JOIN f x ON x.lang = t.lang AND x.phrase = array_to_string(t.g[1:t.k], ' ') JOIN f y ON y.lang = t.lang AND y.phrase = array_to_string(t.g[t.k + 1:], ' ')),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT m.lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM m) m JOIN n USING (lang) WHERE rank <= 2000"""


#: CRC-32 of a decimal id c, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [256 + ascii(ch), 0, 0, 0, 0, 0, 0, 0, 0]))),
  lambda x, y: CASE WHEN y >= 256 THEN xor(x, y - 256) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""

PREFIX_TRIE = f"""WITH o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(said)) AS i, said, bytes
  FROM (SELECT conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said, strlen(coalesce(text, '')) AS bytes FROM conversations WHERE conv_id IS NOT NULL)),
h AS (SELECT c, c - c % 5 AS b, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM o)),
m AS (SELECT h.c, h.b, h.h, count(o.c) AS m FROM h LEFT JOIN o ON o.c = h.b AND o.i <= h.h GROUP BY ALL),
x AS (SELECT m.c, o.i AS d, said, bytes FROM m JOIN o ON o.c = m.b AND o.i <= m.h UNION ALL SELECT m.c, m.m + o.i - m.h, said, bytes FROM m JOIN o ON o.c = m.c AND o.i > m.h),
z AS (SELECT c, d, bytes, array_agg(sha256(said)) OVER (PARTITION BY c ORDER BY d) AS key FROM x UNION ALL SELECT c, 0, 0, [] FROM h),
g AS (SELECT d AS depth, key, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM z GROUP BY d, key),
e AS (SELECT key, sha256(string_agg(c, ',' ORDER BY c)) AS ends FROM (SELECT c, arg_max(key, d) AS key FROM z GROUP BY c) GROUP BY key),
k AS (SELECT key[1:depth - 1] AS key, count(*) AS n FROM g WHERE depth > 0 GROUP BY 1),
a AS (SELECT key[1:k] AS key, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT g.key, unnest(range(0, depth + 1)) AS k, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * bytes AS saved FROM g LEFT JOIN k ON k.key = g.key) GROUP BY 1)
SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, coalesce(k.n, 0) AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM g LEFT JOIN g p ON g.depth > 0 AND p.key = g.key[1:g.depth - 1] LEFT JOIN k ON k.key = g.key LEFT JOIN e ON e.key = g.key JOIN a ON a.key = g.key"""
