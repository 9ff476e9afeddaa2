"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import linkgraph

SQL: dict[str, str] = {}

SQL["op3_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    substr(md5(concat_ws('|', 'mix', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 12) AS hash FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM sizes),
-- sources reach their cap in the order of cap / weight
steps AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM ranked),
-- and taking one out raises the level of the rest until it is right
level AS (SELECT max((total - held) / (weights - gone)) AS level FROM steps),
goal AS (
  SELECT source, source_size, least(cap, weight * level) AS target FROM ranked, level),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM goal),
sums AS (
  SELECT source, hash, words, sum(words) OVER (PARTITION BY source ORDER BY hash) AS upto
  FROM (SELECT source, hash, sum(size) AS words FROM docs GROUP BY source, hash)),
edge AS (
  SELECT p.source, min(s.hash) AS below, arg_min(p.target - p.passes * p.source_size - s.upto + s.words, s.hash) AS missing, arg_min(s.words, s.hash) AS words
  FROM passes p JOIN sums s ON s.source IS NOT DISTINCT FROM p.source
  WHERE s.upto > p.target - p.passes * p.source_size GROUP BY p.source)
SELECT d.doc_id, d.size, p.source_size, p.target,
  (d.size * (p.passes + CASE WHEN d.hash < e.below OR (d.hash = e.below AND e.missing * 2 >= e.words) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN edge e ON d.source IS NOT DISTINCT FROM e.source
"""


def link_graph_sql(rules=linkgraph.RULES, damping: float = linkgraph.DAMPING, rounds: int = linkgraph.ROUNDS, majority: float = 0.5,
                   least: float = linkgraph.LEAST) -> str:
    """Rules, seeds, and what each round of propagation adds."""
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in longest]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits) + " END"
    lower = f"'{linkgraph.UPPER}', '{linkgraph.LOWER}'"
    href = linkgraph.HREF.replace("'", "''").replace('\\"', '"')
    return rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, html, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), {lower}), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT page_id, html, host, path, {rule} AS rule, {verdict} AS ruled FROM parts),
links AS (
  SELECT DISTINCT page_id, host AS src, translate(regexp_extract(link, '^[^/]*//([^/?#]*)', 1), {lower}) AS dst
  FROM (SELECT page_id, host, unnest(regexp_extract_all(html, '{href}', 1)) AS link FROM ruled)),
edges AS (SELECT src, dst, count(*) AS links FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
ways AS (SELECT 'trust' AS kind, src AS node, dst AS target, links FROM edges UNION ALL SELECT 'distrust', dst, src, links FROM edges),
flow AS (SELECT kind, node, target, links / sum(links) OVER (PARTITION BY kind, node) AS share FROM ways),
counts AS (SELECT host, count(*) AS n, count(*) FILTER (ruled = 'allow') AS good, count(*) FILTER (ruled = 'block') AS bad
  FROM ruled WHERE host <> '' GROUP BY host),
seeds AS (
  SELECT 'trust' AS kind, host AS node, good AS weight FROM counts WHERE good > 0 AND good >= {majority} * n
  UNION ALL SELECT 'distrust', host, bad FROM counts WHERE bad > 0 AND bad >= {majority} * n),
s0 AS (SELECT kind, node, {1 - damping} * weight / sum(weight) OVER (PARTITION BY kind) AS score FROM seeds),
added AS (
  SELECT 0 AS round, kind, node, score FROM s0
  UNION ALL
  SELECT a.round + 1, f.kind, f.target, sum(a.score * f.share) * {damping} FROM added a JOIN flow f ON f.kind = a.kind AND f.node = a.node
  WHERE a.round < {rounds} GROUP BY a.round, f.kind, f.target),
scores AS (
  SELECT node, sum(score) FILTER (kind = 'trust') AS trust, sum(score) FILTER (kind = 'distrust') AS distrust FROM added GROUP BY node),
hosts AS (SELECT count(*) AS n FROM (SELECT host FROM counts UNION SELECT src FROM edges UNION SELECT dst FROM edges))
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) AND distrust * n >= {least} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled CROSS JOIN hosts LEFT JOIN scores ON host = node
"""


SQL["op8_link_graph"] = link_graph_sql()

SQL["op4_vantage_points"] = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
QUALIFY rank <= 20
"""

SQL["op11_spanning_tree"] = """
WITH usable AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM usable a JOIN usable c ON a.id % 100 = 0 AND c.id <> a.id AND len(a.v) = len(c.v)),
positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

SQL["op13_iceberg_audit"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT i, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
-- every group and every kept term of its language
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 2 * v) AS p
  FROM cells JOIN sizes USING (lang)),
wholes AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM cells GROUP BY lang, term),
of_lang AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang)::HUGEINT + 2 * v) AS q FROM wholes JOIN sizes USING (lang)),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(g.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source),
terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM shares s JOIN of_lang l ON l.lang = s.lang AND l.term = s.term WHERE s.n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 10
"""
