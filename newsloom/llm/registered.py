"""The queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from newsloom.llm import (bloom_dedup, dialogue_repair, graph_ann, license_scan, minmax_dedup, mixing, packing, quality_rules,
                          suffix_dedup, surrogates, toxicity, warc, whitening)
from newsloom.llm.common import table


def op3_bloom_exact_dedup(spark, sf_dir):
    """Two-pass Bloom exact de-duplication of all documents."""
    return bloom_dedup.exact_groups(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
k AS (SELECT n, count(*) AS group_size, first(doc_id ORDER BY length(t) DESC, doc_id) AS keep_id FROM d GROUP BY n)
SELECT d.doc_id, k.keep_id, k.group_size, d.doc_id = k.keep_id AS kept, sha256(d.n) AS text_sha256
FROM d JOIN k USING (n)
"""


def op6_weighted_fair_mix(spark, sf_dir):
    """Weighted fair queueing of all documents by source."""
    return mixing.fair_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY (source IS NULL), encode(source)) AS rnk FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][(rnk - 1) % 3 + 1] AS weight, 3 * source_size AS cap,
         CAST(3 * source_size AS DOUBLE) / [5, 2, 1][(rnk - 1) % 3 + 1] AS lvl FROM s),
c AS (
  SELECT *, CAST(sum(cap) OVER o AS BIGINT) AS caps, CAST(sum(weight) OVER o AS BIGINT) AS ws,
         CAST(sum(source_size) OVER () AS BIGINT) AS budget, CAST(sum(weight) OVER () AS BIGINT) AS allw
  FROM w WINDOW o AS (ORDER BY lvl, rnk ROWS UNBOUNDED PRECEDING)),
f AS (
  SELECT coalesce(max(caps) FILTER (allw > ws AND CAST(budget - caps AS DOUBLE) / nullif(allw - ws, 0) >= lvl), 0) AS done_c,
         coalesce(max(ws) FILTER (allw > ws AND CAST(budget - caps AS DOUBLE) / nullif(allw - ws, 0) >= lvl), 0) AS done_w FROM c),
t AS (
  SELECT source, source_size, weight, budget,
         least(CAST(cap AS DOUBLE), CAST(budget - done_c AS DOUBLE) / CAST(allw - done_w AS DOUBLE) * weight) AS target
  FROM c, f),
q AS (
  SELECT d.doc_id, d.source, d.size, md5('mix:' || d.doc_id) AS h,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id), d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS queued
  FROM d WHERE size > 0),
i AS (
  SELECT q.*, e, CAST(q.queued + e * t.source_size AS DOUBLE) / t.weight AS finish, t.budget
  FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source, range(3) r(e)),
l AS (
  SELECT doc_id, size, budget, sum(size) OVER (ORDER BY finish, (source IS NULL), encode(source), h, doc_id, e ROWS UNBOUNDED PRECEDING) AS mixed FROM i),
k AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM l WHERE mixed <= budget GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(k.taken, 0) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN k USING (doc_id)
"""

def op1_minmax_near_dedup(spark, sf_dir):
    """Near-duplicate components of all documents by min-max hashing."""
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS sh FROM d),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
x AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.both >= 75 * (na.n + nb.n - p.both)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(id, near) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.near),
c AS (SELECT id, min(near) AS component_id FROM r GROUP BY id)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN c ON c.id = n.doc_id
"""


#: Segment size of the registered query: small enough that many of the test
#: tables' pages are cut.
QUERY_SEGMENT_BYTES = 4096


def op4_warc_segments(spark, sf_dir):
    """All pages written as WARC records and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"), segment_bytes=QUERY_SEGMENT_BYTES).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
k AS (SELECT b, max(page_id) AS keep, count(*) AS n FROM p WHERE octet_length(b) >= 1000 GROUP BY b)
SELECT p.page_id, octet_length(p.b) AS payload_bytes, sha1(p.b) AS payload_digest,
       CASE WHEN p.page_id <> k.keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id <> k.keep THEN k.keep END AS refers_to
FROM p LEFT JOIN k ON k.b = p.b
"""


def op9_pruned_graph_ann(spark, sf_dir):
    """Ten nearest neighbours of every hundredth vector among all."""
    return graph_ann.search_all(table(spark, sf_dir, "embeddings"))


def op10_best_fit_packing(spark, sf_dir):
    """All documents tokenised and packed into sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_license_scan(spark, sf_dir):
    """Licence detections in all documents."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_toxicity_grades(spark, sf_dir):
    """Expected severity of all documents, model fitted on the labels."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_suffix_repeats(spark, sf_dir):
    """Passages of 50 words and more that occur more than once."""
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


#: Key of the registered query; a user passes their own.
SURROGATE_KEY = "newsloom-surrogates"


def op8_surrogates(spark, sf_dir):
    """Personal data in all documents replaced by keyed surrogates."""
    return surrogates.replace_private(table(spark, sf_dir, "documents"), SURROGATE_KEY).select(
        "doc_id", "text", "n_entities", "kinds")


def op11_bit_sliced_whitening(spark, sf_dir):
    """All embeddings whitened on the exact covariance of the distinct ones."""
    return whitening.whiten_table(table(spark, sf_dir, "embeddings"))


def op12_quality_rules(spark, sf_dir):
    """All documents measured and judged by the threshold table."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (
  SELECT rid, unnest(list_transform(range(1, len(w) - 6), lambda i: {'i': i, 'g': array_to_string(w[i:i + 7], ' ')}), recursive := true)
  FROM w),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
c AS (
  SELECT rid, CAST(sum(least(8, coalesce(nxt - i, 8))) AS BIGINT) AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r) GROUP BY rid),
m AS (
  SELECT w.doc_id, w.lang, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: list_contains(CASE lang
           WHEN 'en' THEN ['the', 'of', 'and', 'to', 'a', 'in', 'is', 'that', 'it', 'for', 'was', 'on', 'with', 'as', 'be', 'by', 'are', 'this', 'at', 'from']
           WHEN 'de' THEN ['der', 'die', 'und', 'in', 'den', 'von', 'zu', 'das', 'sich', 'mit', 'des', 'auf', 'für', 'ist', 'im', 'nicht', 'dem', 'ein', 'eine', 'als']
           WHEN 'fr' THEN ['de', 'la', 'le', 'et', 'les', 'en', 'des', 'un', 'du', 'une', 'que', 'est', 'pour', 'par', 'dans', 'avec', 'qui', 'pas', 'sur', 'au']
           WHEN 'es' THEN ['de', 'la', 'que', 'el', 'en', 'y', 'los', 'las', 'se', 'del', 'un', 'por', 'con', 'no', 'una', 'su', 'para', 'es', 'al', 'lo']
           ELSE [] END, lower(x)))) AS n_stop_words,
         len(list_filter(l, lambda x: regexp_matches(x, '^ *[-*\x{2022}]'))) AS n_bullet_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{2026}) *$'))) AS n_cut_lines
  FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words AND 100 * n_symbols <= 25 * n_words
         AND (coalesce(lang, '') NOT IN ('en', 'de', 'fr', 'es') OR 100 * n_stop_words >= n_words)
         AND 100 * n_dup_lines <= 50 * n_lines AND 100 * n_bullet_lines <= 90 * n_lines
         AND 100 * n_cut_lines <= 30 * n_lines AS kept
FROM b
"""


def op13_dialogue_repair(spark, sf_dir):
    """All conversations damaged, audited and repaired."""
    return dialogue_repair.audit(table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                        lambda ch: ascii(ch)),
             lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295),
             4294967295) % 20 AS pick
  FROM conversations),
dmg AS (
  SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
         CASE pick WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN pick = 3 THEN 2 ELSE 1 END)) AS copy
  FROM src WHERE pick <> 0),
pos AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text), copy) AS n,
         regexp_replace(text, '[ 	-
]+$', '') AS solid FROM dmg),
rws AS (
  SELECT c, conv_id, n, turn, role, text, substr(role, 1, 1) AS ini,
         CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(ini) OVER (PARTITION BY c ORDER BY n) AS before
  FROM pos),
ins(st, k, mid, edits, cost, turns) AS (
  VALUES ('E', 0, 'E', '', 0, []::VARCHAR[]), ('E', 1, 'U', 'I', 5, ['user:']), ('E', 2, 'A', 'II', 10, ['user:', 'assistant:']),
         ('S', 0, 'S', '', 0, []), ('S', 1, 'U', 'I', 5, ['user:']), ('S', 2, 'A', 'II', 10, ['user:', 'assistant:']),
         ('U', 0, 'U', '', 0, []), ('U', 1, 'A', 'I', 5, ['assistant:']),
         ('A', 0, 'A', '', 0, []), ('A', 1, 'U', 'I', 5, ['user:'])),
nxt(mid, want, after) AS (VALUES ('E', 'user', 'U'), ('S', 'user', 'U'), ('U', 'assistant', 'A'), ('A', 'user', 'U')),
way AS (
  SELECT r.c, r.n, i.st, i.edits || e.edit AS edits, i.turns || e.line AS turns,
         i.cost + e.cost AS cost, e.after
  FROM rws r CROSS JOIN ins i JOIN nxt x USING (mid),
       LATERAL (SELECT 'D' AS edit, 2 AS cost, i.mid AS after, []::VARCHAR[] AS line
                UNION ALL SELECT 'K', CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END,
                                 CASE WHEN r.ini = 's' THEN 'S' ELSE x.after END, [r.role || ':' || r.text]
                WHERE r.fault NOT IN ('blank', 'duplicate') AND (r.ini = x.want[1] OR r.ini = 's' AND i.mid = 'E')
                UNION ALL SELECT 'R', CASE WHEN r.fault = 'truncated' THEN 6 ELSE 1 END, x.after, [x.want || ':' || r.text]
                WHERE r.fault NOT IN ('blank', 'duplicate')) e),
walk AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS n, 'E' AS st, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM rws
  UNION ALL
  SELECT c, n, st, cost, audit, lines FROM (
    SELECT w.c, y.n, y.after AS st, w.cost + y.cost AS cost, w.audit || y.edits AS audit, w.lines || y.turns AS lines,
           row_number() OVER (PARTITION BY w.c, y.after ORDER BY w.cost + y.cost, w.audit || y.edits) AS best
    FROM walk w JOIN way y ON y.c = w.c AND y.n = w.n + 1 AND y.st = w.st) WHERE best = 1),
fin AS (
  SELECT w.c, w.cost + i.cost AS cost, w.audit || i.edits AS audit, w.lines || i.turns AS lines
  FROM walk w JOIN (SELECT c, max(n) AS n FROM rws GROUP BY c) l USING (c, n) JOIN ins i ON i.st = w.st AND i.mid IN ('E', 'A')
  QUALIFY row_number() OVER (PARTITION BY w.c ORDER BY w.cost + i.cost, w.audit || i.edits) = 1),
tot AS (
  SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rws GROUP BY c)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN (tot JOIN fin USING (c)) f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


QUERIES = {
    "op1_minmax_near_dedup": (op1_minmax_near_dedup, OP1_SQL),
    "op2_license_scan": (op2_license_scan, None),
    "op3_bloom_exact_dedup": (op3_bloom_exact_dedup, OP3_SQL),
    "op4_warc_segments": (op4_warc_segments, OP4_SQL),
    "op6_weighted_fair_mix": (op6_weighted_fair_mix, OP6_SQL),
    "op5_toxicity_grades": (op5_toxicity_grades, None),
    "op7_suffix_repeats": (op7_suffix_repeats, None),
    "op8_surrogates": (op8_surrogates, None),
    "op9_pruned_graph_ann": (op9_pruned_graph_ann, None),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_bit_sliced_whitening": (op11_bit_sliced_whitening, None),
    "op12_quality_rules": (op12_quality_rules, OP12_SQL),
    "op13_dialogue_repair": (op13_dialogue_repair, OP13_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}


def queries():
    return {k: f for k, (f, _) in QUERIES.items()}


def oracle_sql():
    return {k: s for k, (_, s) in QUERIES.items() if s}
