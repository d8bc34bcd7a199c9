"""DuckDB SQL for the queries that SQL can express."""

_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL = {
    "op2_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_TRIM}), {_AZ}) AS key FROM l),
hot AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, hot.key IS NOT NULL AND k.doc_id IS DISTINCT FROM hot.keeper AS gone FROM k LEFT JOIN hot ON k.key = hot.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id
""",
    "op5_source_mix": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM s),
r AS (SELECT *, cap::DOUBLE / w AS ratio, sum(source_size) OVER () AS total, sum(w) OVER () AS weights FROM w),
v AS (SELECT *, row_number() OVER o AS rank,
       (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
       / (weights - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
       FROM r WINDOW o AS (ORDER BY ratio, source NULLS LAST)),
c AS (SELECT *, level >= ratio AS capped, count(*) FILTER (WHERE level >= ratio) OVER () AS k FROM v),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE w * max(CASE WHEN rank = k + 1 THEN level END) OVER () END AS target FROM c),
m AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS m FROM t),
b AS (SELECT source, h, sum(size)::BIGINT AS size FROM d GROUP BY source, h),
q AS (SELECT b.source, b.h, b.size, sum(b.size) OVER (PARTITION BY b.source ORDER BY b.h) AS cum, m.target - m.m * m.source_size AS rest
      FROM b JOIN m ON b.source IS NOT DISTINCT FROM m.source),
x AS (SELECT source, h, (cum <= rest OR (cum - size <= rest AND cum - rest < rest - (cum - size)))::BIGINT AS extra FROM q)
SELECT d.doc_id, d.size, m.source_size, m.target, (d.size * (m.m + x.extra))::BIGINT AS taken
FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
""",
    "op8_pivot_search": """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id AS id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT uid, id, len(v) AS dim, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
p AS (SELECT a.uid, a.id AS query_id, b.id AS vec_id, sum(a.x * b.x)::BIGINT AS score
      FROM e a JOIN e b ON a.i = b.i AND a.dim = b.dim AND a.uid <> b.uid WHERE a.id % 100 = 0 GROUP BY a.uid, a.id, b.uid, b.id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op12_hard_negatives": """
WITH r AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
       list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
       WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT row_number() OVER () AS uid, id, label, v FROM r),
e AS (SELECT uid, id, label, len(v) AS dim, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM u),
s AS (SELECT a.uid, a.id AS anchor_id, b.uid AS other, b.id, a.label = b.label AS same, sum(a.x * b.x)::BIGINT AS score
      FROM e a JOIN e b ON a.i = b.i AND a.dim = b.dim AND a.uid <> b.uid WHERE a.id % 100 = 0 GROUP BY a.uid, a.id, b.uid, b.id, a.label = b.label),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, id) AS nth FROM s WHERE same) WHERE nth <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.uid, p.other ORDER BY s.score DESC, s.id)::INTEGER AS rank
      FROM p JOIN s ON p.uid = s.uid AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
}
