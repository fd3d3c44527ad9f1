"""Registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.llm import (conversations, fim, fm_index, hnsw, license_automata, line_dedup, minhash, mixing, ngram_trie,
                          pii, quality, toxicity, url_templates)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op3_hnsw_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_ngram_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.language_scores(spark, _table(spark, sf_dir, "documents"), order=3)


def op5_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_automata.scan_licenses(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.with_kept_text(docs, min_chars=40, min_docs=5).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("_kept_text"), 256).alias("kept_sha256"))


def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_templates.judge_urls(_table(spark, sf_dir, "pages"))
    return out.withColumn("purity", F.round("purity", 6))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixture(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3.0)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.contamination(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                  window=10)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"), seed=42)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(_table(spark, sf_dir, "conversations"), damage=True)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                             "n_repeat_words", "base_failed", "kept")


QUERIES = {f.__name__: f for f in (
    op1_personal_data, op2_minhash_near_dedup, op3_hnsw_near_dedup, op4_ngram_trie_scores,
    op5_license_templates, op6_line_dedup, op7_url_templates, op8_source_mixing, op9_benchmark_decontamination, op10_toxicity,
    op11_fill_in_middle, op12_conversation_repair, op13_quality_rules,
)}

ORACLE: dict[str, str] = {
    "op6_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), hot AS (
  SELECT key, max(doc_id) AS keeper
  FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5
), marked AS (
  SELECT k.*, h.keeper IS NOT NULL AND h.keeper IS DISTINCT FROM k.doc_id AS gone
  FROM keyed k LEFT JOIN hot h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op7_url_templates": r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), ruled AS (
  SELECT host, path, count(*) AS n,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts GROUP BY host, path
), urls AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS given,
         list_filter(string_split(path, '/'), lambda x: x <> '') AS segs
  FROM ruled
), exploded AS (
  SELECT host, path, segs, unnest(segs) AS seg, generate_subscripts(segs, 1) - 1 AS pos FROM urls
), nodes AS (
  SELECT host, path, pos, seg, regexp_replace(seg, '[0-9]+', '0', 'g') AS shape,
         array_to_string(list_transform(segs[1:pos], lambda x: regexp_replace(x, '[0-9]+', '0', 'g')), '/') AS above
  FROM exploded
), shapes AS (
  SELECT host, pos, above, shape, count(DISTINCT seg) AS kinds, count(*) AS n FROM nodes GROUP BY ALL
), places AS (
  SELECT host, pos, above, count(*) AS kinds, sum(n) AS n FROM shapes GROUP BY ALL
), anywhere AS (
  SELECT pos, above, shape, sum(kinds) AS kinds FROM shapes GROUP BY ALL
), named AS (
  SELECT x.host, x.path, x.pos,
         CASE WHEN p.kinds >= 8 AND p.kinds > 0.5 * p.n THEN '*'
              WHEN a.kinds > 1 AND contains(x.shape, '0') THEN regexp_replace(x.seg, '[0-9]+', '*', 'g')
              ELSE x.seg END AS part
  FROM nodes x JOIN places p USING (host, pos, above) JOIN anywhere a USING (pos, above, shape)
), judged AS (
  SELECT u.host, u.path, u.n, u.rule, u.given, '/' || coalesce(string_agg(m.part, '/' ORDER BY m.pos), '') AS template
  FROM urls u LEFT JOIN named m ON u.host = m.host AND u.path = m.path
  GROUP BY u.host, u.path, u.n, u.rule, u.given
), own AS (
  SELECT host, template, sum(CASE WHEN given IS NOT NULL THEN n ELSE 0 END)::DOUBLE AS n,
         sum(CASE WHEN given = 'block' THEN n ELSE 0 END)::DOUBLE AS b
  FROM judged GROUP BY host, template
), shared AS (
  SELECT template, (sum(b) + 4.0::DOUBLE * (SELECT (sum(b) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) FROM own))
                   / (sum(n) + 4.0::DOUBLE) AS p
  FROM own GROUP BY template
), purity AS (
  SELECT host, template,
         CASE WHEN n = 0 OR abs(b / nullif(n, 0) - p) / sqrt(p * (1 - p) / nullif(n, 0) + 1e-9::DOUBLE) < 2.0::DOUBLE THEN p
              ELSE (b + 4.0::DOUBLE * p) / (n + 4.0::DOUBLE) END AS purity
  FROM own JOIN shared USING (template)
)
SELECT r.page_id, r.host, r.path, j.rule,
       coalesce(j.given, CASE WHEN y.purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       j.template, round(y.purity, 6) AS purity
FROM parts r JOIN judged j USING (host, path) JOIN purity y USING (host, template)""",
    "op8_source_mixing": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w
  FROM docs GROUP BY source
), level AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - (sum(3.0::DOUBLE * source_size) OVER o) + 3.0::DOUBLE * source_size)
            / (sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS lvl
  FROM sources
  WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, (SELECT max(lvl) FROM level) * w) AS target FROM level
), favoured AS (
  SELECT d.*, t.source_size, t.target, length(bin(d.size))::BIGINT AS fav
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), classes AS (
  SELECT source, fav, any_value(target) AS target, sum(size)::BIGINT AS words FROM favoured GROUP BY source, fav
), levels AS (
  SELECT *, (target - 3.0::DOUBLE * coalesce(sum(words) OVER (PARTITION BY source ORDER BY fav DESC
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / nullif((sum(fav * words) OVER (PARTITION BY source ORDER BY fav DESC
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE, 0) AS lvl
  FROM classes
), rates AS (
  SELECT source, fav, words, target, coalesce(least(3.0::DOUBLE, max(lvl) OVER (PARTITION BY source) * fav), 0) AS rate FROM levels
), rests AS (
  SELECT *, target - (sum(floor(rate)::BIGINT * words) OVER (PARTITION BY source))::DOUBLE AS rest FROM rates
), odds AS (
  SELECT f.*, r.rest, floor(r.rate) AS whole, r.rate - floor(r.rate) AS p,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE)
         / 4503599627370496.0::DOUBLE AS u
  FROM favoured f JOIN rests r ON f.source IS NOT DISTINCT FROM r.source AND f.fav = r.fav
), ranked AS (
  SELECT *, CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END AS rank FROM odds
), summed AS (
  SELECT *, CASE WHEN p > 0 THEN sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER
                 (PARTITION BY source ORDER BY rank NULLS LAST, doc_id) END AS upto
  FROM ranked
), taken AS (
  SELECT *, upto <= rest OR (upto - size < rest AND 2 * upto - size < 2 * rest) AS more FROM summed
), last AS (
  SELECT source, max(rank) FILTER (WHERE more) AS cut FROM taken GROUP BY source
)
SELECT t.doc_id, t.size, t.source_size, t.target,
       ((t.whole + CASE WHEN t.rank <= l.cut THEN 1 ELSE 0 END) * t.size)::BIGINT AS taken
FROM taken t JOIN last l ON t.source IS NOT DISTINCT FROM l.source""",
    "op9_benchmark_decontamination": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS win
  FROM iw, LATERAL (SELECT unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p) WHERE len(ws) > 0
), ks AS (
  SELECT DISTINCT k FROM win
), dw AS (
  SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS win
  FROM w, ks, LATERAL (SELECT unnest(range(1, len(ws) - k + 2)) AS p) WHERE len(ws) >= k
), occ AS (
  SELECT doc_id, p, k, item_id FROM dw JOIN win USING (k, win)
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM occ, LATERAL (SELECT unnest(range(p, p + k)) AS q) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM occ) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_fill_in_middle": r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS toks
  FROM documents
), drawn AS (
  SELECT *, len(toks) AS n, ('0x' || h[1:8])::BIGINT % (len(toks) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(toks) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT *, array_to_string(toks[1:least(c1, c2)], '') AS p,
         array_to_string(toks[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(toks[greatest(c1, c2) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts""",
    "op12_conversation_repair": r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         (coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS k
  FROM conversations
), summed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(k, ''),
                  lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT)
                                  ELSE c >> 1 END), 4294967295::BIGINT) % 20 AS kind
  FROM keyed
), hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM summed WHERE kind <> 0
), ordered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn
  FROM hurt
), rows_ AS (
  SELECT *, role[1:1] AS r, lag(role[1:1]) OVER (PARTITION BY c ORDER BY rn) AS pr,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY rn) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault
  FROM ordered
), walk AS (
  SELECT DISTINCT c, 0::BIGINT AS rn, {'c': 0, 't': ''} AS z, {'c': 1000000000, 't': ''} AS s,
         {'c': 3, 't': 'I'} AS u, {'c': 6, 't': 'II'} AS a
  FROM rows_
  UNION ALL
  SELECT c, rn, z, s, list_min([u, {'c': z.c + 3, 't': z.t || 'I'}, {'c': s.c + 3, 't': s.t || 'I'},
                                {'c': a.c + 3, 't': a.t || 'I'}]) AS u,
         list_min([a, {'c': u.c + 3, 't': u.t || 'I'}, {'c': z.c + 6, 't': z.t || 'II'},
                   {'c': s.c + 6, 't': s.t || 'II'}]) AS a
  FROM (
    SELECT w.c, x.rn, {'c': w.z.c + 4, 't': w.z.t || 'D'} AS z,
           list_min([{'c': w.s.c + 4, 't': w.s.t || 'D'}] || CASE WHEN x.must OR x.r <> 's' THEN [] ELSE
                    [{'c': w.z.c + x.late, 't': w.z.t || 'K'}] END) AS s,
           list_min([{'c': w.u.c + 4, 't': w.u.t || 'D'}] || CASE WHEN x.must THEN [] WHEN x.r = 'u' THEN
                    [{'c': w.z.c + x.late, 't': w.z.t || 'K'}, {'c': w.s.c + x.late, 't': w.s.t || 'K'},
                     {'c': w.a.c + x.late, 't': w.a.t || 'K'}] ELSE
                    [{'c': w.z.c + x.late + 3, 't': w.z.t || 'R'}, {'c': w.s.c + x.late + 3, 't': w.s.t || 'R'},
                     {'c': w.a.c + x.late + 3, 't': w.a.t || 'R'}] END) AS u,
           list_min([{'c': w.a.c + 4, 't': w.a.t || 'D'}] || CASE WHEN x.must THEN [] WHEN x.r = 'a' THEN
                    [{'c': w.u.c + x.late, 't': w.u.t || 'K'}] ELSE
                    [{'c': w.u.c + x.late + 3, 't': w.u.t || 'R'}] END) AS a
    FROM walk w JOIN (SELECT c, rn, r, coalesce(fault IN ('blank', 'duplicate'), false) AS must,
                             CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late FROM rows_) x
         ON w.c = x.c AND x.rn = w.rn + 1)
), best AS (
  SELECT c, list_min([z, a]) AS b FROM walk QUALIFY rn = max(rn) OVER (PARTITION BY c)
), edits AS (
  SELECT c, unnest(string_split(b.t, '')) AS e, generate_subscripts(string_split(b.t, ''), 1) AS i FROM best WHERE b.t <> ''
), placed AS (
  SELECT c, e, i, count(*) FILTER (WHERE e <> 'I') OVER w AS rn, count(*) FILTER (WHERE e <> 'D') OVER w AS j
  FROM edits WINDOW w AS (PARTITION BY c ORDER BY i)
), written AS (
  SELECT p.c, p.e, p.i, p.j, CASE WHEN p.e <> 'I' THEN x.role END AS role, CASE WHEN p.e = 'I' THEN '' ELSE x.text END AS text
  FROM placed p LEFT JOIN rows_ x ON p.c = x.c AND p.rn = x.rn WHERE p.e <> 'D'
), shifted AS (
  SELECT *, j - (first_value(e = 'K' AND role[1:1] = 's') OVER (PARTITION BY c ORDER BY i))::INT AS k FROM written
), texts AS (
  SELECT c, string_agg(CASE WHEN e = 'K' THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                       chr(10) ORDER BY i) AS t
  FROM shifted GROUP BY c
), counted AS (
  SELECT conv_id, c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pr IS NOT NULL AND pr || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id, c
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.t, '') AS audit,
       sha256(coalesce(t.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted n ON o.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN best USING (c) LEFT JOIN texts t USING (c)""",
}
