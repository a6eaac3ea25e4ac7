"""DuckDB twins of the operator queries that SQL can express.

The others are tested against brute force or the tokenizers' own libraries
in tests/llm.
"""

OP3 = """
WITH RECURSIVE sizes AS (
  SELECT source, count(*) AS n, sqrt(count(*)) AS w FROM documents GROUP BY source),
rates AS (
  SELECT source, w * (SELECT sum(n) FROM sizes)::DOUBLE / (SELECT sum(w) FROM sizes) / n AS rate FROM sizes),
pmf(source, rate, k, logp) AS (
  SELECT source, rate, 0, -rate FROM rates
  UNION ALL
  SELECT source, rate, k + 1, logp + ln(rate) - ln(k + 1) FROM pmf WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
cdf AS (
  SELECT source, k, sum(exp(logp)) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
draws AS (
  SELECT doc_id, source, ('0x' || substr(md5('42:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
copies AS (
  SELECT d.doc_id, count(*) AS copies FROM draws d JOIN cdf ON cdf.source = d.source AND cdf.c <= d.u GROUP BY d.doc_id),
rows_ AS (
  SELECT doc_id, unnest(range(1, copies + 1))::INTEGER AS copy FROM copies)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, r.copy,
       md5('42:' || d.doc_id || ':' || r.copy) AS shuffle_key
FROM rows_ r JOIN documents d USING (doc_id)
"""

OP9 = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, a.r, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP4 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.9),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
comp AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(comp.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(comp.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN comp ON comp.a = e.vec_id
"""

OP5 = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (
  SELECT doc_id, unnest(regexp_extract_all(h, '..')) AS b, unnest(range(n)) AS i FROM d),
w AS (
  SELECT doc_id, i, b, CASE WHEN count(*) OVER f = 50 THEN string_agg(b, '') OVER f END AS s FROM p
  WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
first_ AS (
  SELECT s, min(doc_id) AS doc FROM w WHERE s IS NOT NULL GROUP BY s),
hit AS (
  SELECT w.doc_id, w.i, w.b, f.doc < w.doc_id AS hit FROM w LEFT JOIN first_ f ON f.s = w.s),
gone AS (
  SELECT *, coalesce(max(CASE WHEN hit THEN i END) OVER (PARTITION BY doc_id ORDER BY i) >= i - 49, false) AS gone FROM hit),
edge AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM gone),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
         coalesce(string_agg(b, '' ORDER BY i) FILTER (NOT gone), '') AS kept FROM edge GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP8 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM words),
win AS (
  SELECT doc_id, pos, w, string_agg(w, ' ') OVER f AS s, count(*) OVER f AS n FROM w
  WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
rep AS (
  SELECT *, n = 35 AND count(*) OVER (PARTITION BY s, n) > 1 AS repeats FROM win),
gone AS (
  SELECT *, coalesce(max(CASE WHEN repeats THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos) >= pos - 34, false) AS gone
  FROM rep),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(w, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       row_number() OVER w = 1 AS kept, s AS text_sha256
FROM d WINDOW w AS (PARTITION BY s ORDER BY n DESC, doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op3_mixing": OP3, "op4_embeddings": OP4, "op5_suffixes": OP5, "op8_substring": OP8, "op9_topk": OP9,
                              "op11_exact": OP11}
