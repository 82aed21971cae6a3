"""DuckDB SQL of the registered queries that SQL can express, from their definitions."""

from __future__ import annotations

import corpus_pipeline

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_MIX = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         md5('d0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents),
s0 AS (SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS si FROM s0),
s2 AS (SELECT *, CASE (si - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s1),
s3 AS (SELECT *, row_number() OVER (ORDER BY source_size * (10 // w), si) AS place, sum(source_size) OVER () AS total, sum(w) OVER () AS heavy FROM s2),
s4 AS (SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cut_before,
         coalesce(sum(w) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before FROM s3),
s5 AS (SELECT *, (3 * total - 2 * cut_before) * w > 4 * source_size * (heavy - w_before) AS capped FROM s4),
s6 AS (SELECT *, sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END) OVER () AS cut, sum(CASE WHEN capped THEN 0 ELSE w END) OVER () AS w_left FROM s5),
s7 AS (SELECT *, CASE WHEN capped THEN (2 * source_size)::DOUBLE ELSE greatest((w * (3 * total - 2 * cut))::DOUBLE / (2 * w_left)::DOUBLE, 0) END AS target FROM s6),
s AS (SELECT *, floor(target + 0.5)::BIGINT // greatest(source_size, 1) AS whole, floor(target + 0.5)::BIGINT - floor(target + 0.5)::BIGINT // greatest(source_size, 1) * greatest(source_size, 1) AS extra,
        ceil(n / 256.0)::BIGINT AS blocks FROM s7),
p AS (SELECT d.*, s.si, s.source_size, s.target, s.whole, s.extra, ('0x' || substr(h, 1, 15))::BIGINT % s.blocks AS block FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
b AS (SELECT si, block, sum(size) AS words, any_value(whole) AS whole, any_value(extra) AS extra FROM p GROUP BY si, block),
b1 AS (SELECT *, sum(words) OVER (PARTITION BY si ORDER BY md5('b0:' || block), block) - words AS before FROM b),
q AS (SELECT p.*, b1.before, b1.words, b1.before < p.extra AND b1.before + b1.words > p.extra AS is_cut,
        sum(size) OVER (PARTITION BY p.si, p.block ORDER BY h ROWS UNBOUNDED PRECEDING) AS got FROM p JOIN b1 USING (si, block)),
r AS (SELECT *, CASE WHEN is_cut THEN greatest(0, least(size, extra - before - got + size)) WHEN before < extra AND words > 0 THEN size ELSE 0 END AS more,
        CASE WHEN is_cut THEN greatest(0, least(size, extra - before - got + size)) > 0 ELSE before < extra AND words > 0 END AS again FROM q)
SELECT doc_id, size, source_size, target, (whole * size + more)::BIGINT AS taken, (whole + again::INT)::INT AS passes FROM r
"""

_NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS item FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
c AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.least AS component_id, d.doc_id = m.least AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS least FROM c GROUP BY a) m USING (doc_id)
"""

_LM = f"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM documents),
t AS (SELECT doc_id, CASE WHEN i = 1 THEN '' ELSE words[i - 1] END AS v, words[i] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)),
c AS (SELECT w, count(*) AS c FROM t GROUP BY w UNION ALL SELECT '', count(DISTINCT doc_id) FROM t),
own AS (SELECT doc_id, v, w, count(*) AS k FROM t GROUP BY ALL),
b AS (SELECT v, w, sum(k) AS k FROM own GROUP BY ALL),
x AS (SELECT own.doc_id, own.k, b.k - own.k AS o, cv.c AS cv, cw.c AS cw, (SELECT count(*) FROM t) AS n FROM own JOIN b USING (v, w) JOIN c cv ON cv.w = own.v JOIN c cw ON cw.w = own.w),
s AS (SELECT doc_id, sum(k) AS n_words, sum(CASE WHEN o > 0 THEN 0 ELSE k END) AS n_backoff, sum(k * CASE WHEN o > 0 THEN ln(o / cv) ELSE ln(0.4 * cw / n) END) AS s FROM x GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff, round(s / n_words, 6) AS score FROM documents LEFT JOIN s USING (doc_id)
"""

_WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS most FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> most THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> most THEN most END AS refers_to
FROM m
"""

_TOP_K = """
WITH v AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings),
e AS (SELECT vec_id, i, floor(64 * x::DOUBLE)::BIGINT AS c FROM v),
s AS (SELECT q.vec_id AS query_id, d.vec_id, sum(q.c * d.c)::BIGINT AS score FROM e q JOIN e d ON q.i = d.i AND q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0 GROUP BY 1, 2),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

#: The alignment folded to its period, from the last turn to the first: no table of lengths as in the operator.
_TURNS = r"""
WITH RECURSIVE bytes AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
c AS (SELECT k.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda ch: ord(ch)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind FROM k, bytes),
m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE kind <> 0),
f AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM m),
r AS (SELECT conv_id, turn, role, text, left(role, 1) AS r, CASE WHEN blank THEN 'b' WHEN again THEN 'd' WHEN cut THEN 't' ELSE 'f' END AS code,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again) AS pos, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again) AS follows FROM f),
n AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (code = 'b') AS blank, count(*) FILTER (code = 'd') AS duplicate, count(*) FILTER (code = 't') AS truncated,
  count(*) FILTER (follows IS NOT NULL AND r || follows NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS turns FROM r GROUP BY conv_id),
-- next: u nothing or begins with u, a begins with a, v begins with u, s an s comes first; after so many insertions a state goes on from another
go(state, inserts, source) AS (VALUES ('u', 0, 'u'), ('u', 1, 'a'), ('a', 0, 'a'), ('a', 1, 'u'), ('v', 0, 'v'), ('v', 1, 'a'), ('v', 2, 'u'), ('s', 0, 's')),
eat(source, after, letter) AS (VALUES ('u', 'a', 'u'), ('a', 'u', 'a'), ('v', 'a', 'u'), ('s', 'v', 's')),
best AS (
  SELECT conv_id, turns AS i, state, least.c AS cost, least.a AS audit FROM (SELECT conv_id, turns, unnest(['u', 'a', 'v']) AS state, unnest([{'c': 0, 'a': ''}, {'c': 3, 'a': 'I'}, {'c': 6, 'a': 'II'}]) AS least FROM n)
  UNION ALL
  SELECT conv_id, i, state, least.c, least.a FROM (
    SELECT o.conv_id, o.i, go.state, min({'c': 3 * go.inserts + o.cost, 'a': repeat('I', go.inserts) || o.audit}) AS least FROM go JOIN (
      SELECT b.conv_id, b.i - 1 AS i, b.state AS source, 4 + b.cost AS cost, 'D' || b.audit AS audit FROM best b WHERE b.i > 0
      UNION ALL
      SELECT b.conv_id, b.i - 1, eat.source, (CASE WHEN r.r = eat.letter THEN 0 ELSE 3 END) + (CASE r.code WHEN 't' THEN 3 ELSE 0 END) + b.cost, (CASE WHEN r.r = eat.letter THEN 'K' ELSE 'R' END) || b.audit
      FROM best b JOIN eat ON eat.after = b.state JOIN r ON r.conv_id = b.conv_id AND r.pos = b.i WHERE r.code IN ('t', 'f') AND (eat.source <> 's' OR r.r = 's')
    ) o ON o.source = go.source GROUP BY o.conv_id, o.i, go.state)
),
won AS (SELECT conv_id, least.c AS cost, least.a AS audit FROM (SELECT conv_id, min({'c': cost, 'a': audit}) AS least FROM best WHERE i = 0 AND state IN ('u', 's') GROUP BY conv_id)),
e AS (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS j FROM won),
e1 AS (SELECT conv_id, j, audit[j] AS edit, len(replace(audit[1:j], 'I', '')) AS pos, len(replace(audit[1:j], 'D', '')) - len(replace(audit, 'D', '')) % 2 AS made FROM e),
e2 AS (SELECT e1.conv_id, j, CASE edit WHEN 'K' THEN r.role ELSE CASE WHEN made % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE edit WHEN 'I' THEN '' ELSE r.text END AS line FROM e1 LEFT JOIN r ON r.conv_id = e1.conv_id AND r.pos = e1.pos WHERE edit <> 'D'),
p AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS whole FROM e2 GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN n USING (conv_id) LEFT JOIN won USING (conv_id) LEFT JOIN p USING (conv_id)
"""

_HARD = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    found = {
        "op1_mix_sources": _MIX,
        "op2_near_duplicates": _NEAR,
        "op5_lm_score": _LM,
        "op8_warc": _WARC,
        "op10_exact_top_k": _TOP_K,
        "op11_turn_repair": _TURNS,
        "op12_hard_negatives": _HARD,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {k: v for k, v in found.items() if v}
