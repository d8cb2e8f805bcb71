"""The corpus queries in DuckDB's SQL, where it can express them."""

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

OP6 = rf"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""

#: From links p (a, b), both ways, over ids of table t: each id's smallest reachable id.
REACH = """
reach AS (SELECT {id} AS id, {id} AS x FROM {t} UNION SELECT reach.id, p.b FROM reach JOIN p ON p.a = reach.x),
low AS (SELECT id, min(x) AS component_id FROM reach GROUP BY id)
"""

OP4 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
{REACH.format(id="vec_id", t="embeddings")}
SELECT vec_id, (SELECT count(*) FROM p WHERE p.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN low ON low.id = vec_id
"""

OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) END AS sh FROM d),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
{REACH.format(id="doc_id", t="documents")}
SELECT doc_id, len(sh) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN low ON low.id = doc_id
"""

#: Windows of 200 bytes, as hexadecimal digits, that occur twice; their union is removed.
OP2 = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS r_no, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r_no, unnest(range(0, greatest(0, len(h) // 2 - 199))) AS pos FROM d),
k AS (SELECT r_no, pos, md5(substr(h, 2 * pos + 1, 400)) AS key FROM w JOIN d USING (r_no)),
r AS (SELECT r_no, pos FROM k QUALIFY count(*) OVER (PARTITION BY key) > 1),
e AS (SELECT r_no, pos, pos - lag(pos) OVER (PARTITION BY r_no ORDER BY pos) <= 200 AS goes_on FROM r),
g AS (SELECT r_no, pos, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY r_no ORDER BY pos) AS run FROM e),
s AS (SELECT r_no, min(pos) AS a, max(pos) + 200 AS z FROM g GROUP BY r_no, run),
b AS (SELECT r_no, a, z, coalesce(lag(z) OVER (PARTITION BY r_no ORDER BY a), 0) AS before FROM s),
p AS (SELECT r_no, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM b JOIN d USING (r_no) GROUP BY r_no)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN p USING (r_no)
"""

#: What a mix aims at, which has one answer; which documents are taken to come near it has many.
MIX_TARGETS = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 2.0::DOUBLE * source_size AS most FROM s),
o AS (SELECT *, most / weight AS ratio, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS k FROM w),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
m AS (SELECT min_by(level, k) AS level FROM l WHERE level <= ratio)
SELECT doc_id, size, source_size, round(CASE WHEN ratio <= m.level THEN most ELSE coalesce(m.level * weight, most) END, 6) AS target
FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source CROSS JOIN m
"""

#: The add-half unigram beside the byte model. crc32 is reckoned bit by bit.
LM_BASE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w,
  xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
      lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda i: 0::BIGINT), lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END))) % 5 = 1 AS held_out FROM documents),
t AS (SELECT row_number() OVER (ORDER BY doc_id, w) AS r_no, doc_id, held_out, w FROM d),
u AS (SELECT r_no, held_out, unnest(w) AS x FROM t),
c AS (SELECT x, count(*) AS c FROM u WHERE NOT held_out GROUP BY x),
q AS (SELECT (SELECT count(*) FROM t WHERE NOT held_out) AS stops, (SELECT coalesce(sum(c), 0) FROM c) AS words, (SELECT count(*) FROM c) AS kinds),
k AS (SELECT stops, words + stops AS n, kinds + CASE WHEN stops > 0 THEN 1 ELSE 0 END AS v FROM q),
s AS (SELECT r_no, count(*) AS words, count(c.c) AS known, sum(log10((coalesce(c.c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (v + 1)))) AS score FROM u LEFT JOIN c USING (x) CROSS JOIN k GROUP BY r_no)
SELECT doc_id, held_out, CAST(coalesce(words, 0) + 1 AS BIGINT) AS n_tokens, CAST(coalesce(known, 0) + CASE WHEN stops > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_known, CAST(n AS BIGINT) AS train_tokens,
       round(coalesce(score, 0) + log10((stops + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (v + 1))), 6) AS base_score FROM t LEFT JOIN s USING (r_no) CROSS JOIN k
"""

ORACLE = {"op2_repeated_bytes": OP2, "mix_targets": MIX_TARGETS, "lm_base_scores": LM_BASE, "op4_vector_near_dedup": OP4, "op6_exact_dedup": OP6, "op8_minmax_near_dedup": OP8}
