"""One query per operator, over whole tables, and the SQL forms of those that have one."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers
from launchcohort.llm import (cover_join, decontamination, hard_negatives, line_dedup, minhash, mixing, quality_rules, secrets, spelling, substring_dedup,
                              token_counts, toxicity, url_filter)
from launchcohort.llm.common import table


def op1_line_dedup(spark, sf_dir):
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_secret_scan(spark, sf_dir):
    out = secrets.secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = [F.expr(f"bigint(size(filter(base, x -> x.kind = '{k}')))").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return out.select("row.doc_id", *n, F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op3_substring_dedup(spark, sf_dir):
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), window=35, digest=True)
    return out.select("row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op4_token_counts(spark, sf_dir):
    out = token_counts.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op5_toxicity(spark, sf_dir):
    out = toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return out.select("row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_embedding_links(spark, sf_dir):
    out = cover_join.cover_join(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), cosine=0.98)
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_mix_sources(spark, sf_dir):
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "size", "source_size", "target", "taken", "shard")


def op8_near_duplicates(spark, sf_dir):
    out = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words_per=2, similarity=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_url_filter(spark, sf_dir):
    out = url_filter.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), url_filter.labelled_urls(spark))
    return out.select("row.page_id", "host", "path", "rule", "verdict", "score")


def op10_decontamination(spark, sf_dir):
    out = decontamination.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score", F.col("end").alias("end_word"))


def op11_spelling_variants(spark, sf_dir):
    out = spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def op12_quality_rules(spark, sf_dir):
    out = quality_rules.quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"), "embedding")
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, id="vec_id", vector="embedding")


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_secret_scan, op3_substring_dedup, op4_token_counts, op5_toxicity, op6_embedding_links, op7_mix_sources, op8_near_duplicates, op9_url_filter, op10_decontamination,
                                op11_spelling_variants, op12_quality_rules, op13_hard_negatives)}
ORACLES: dict[str, str] = {
    "op1_line_dedup": """
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT doc_id, lines, list_transform(lines, lambda x: translate(
    trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS keys
  FROM cut),
shared AS (
  SELECT key FROM (SELECT unnest(list_distinct(keys)) AS key FROM keyed) WHERE key <> '' GROUP BY key HAVING count(*) >= 10),
gone AS (SELECT coalesce(list(key), []) AS gone FROM shared),
left_over AS (
  SELECT doc_id, lines, list_transform(list_filter(list_zip(lines, keys), lambda p: NOT list_contains(gone, p[2])), lambda p: p[1]) AS kept FROM keyed, gone)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
  sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM left_over""",
    "op3_substring_dedup": r"""
WITH cut AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT k, unnest(range(1, len(w) - 33)) AS s FROM cut),
windows AS (SELECT k, s, array_to_string(w[s:s + 34], ' ') AS passage FROM starts JOIN cut USING (k)),
again AS (SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1),
gone AS (SELECT DISTINCT k, unnest(range(s, s + 35)) AS place FROM windows JOIN again USING (passage)),
marked AS (SELECT k, count(*) AS n, list(place) AS places FROM gone GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda p: NOT list_contains(places, p[2])), lambda p: p[1]) END, ' '), '')) AS kept_sha256
FROM cut LEFT JOIN marked USING (k)""",
    "op6_embedding_links": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
good AS (
  SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM vectors
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE a.size > 0 AND b.size > 0 AND list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) / (a.size * b.size) >= 0.98),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
named AS (SELECT a, min(b) AS least FROM reached GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(named.least, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(named.least, vec_id)) AS kept
FROM vectors LEFT JOIN named ON vec_id = named.a LEFT JOIN counted ON vec_id = counted.a""",
    "op8_near_duplicates": r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s FROM cut),
classes AS (SELECT min(doc_id) AS a, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
each AS (SELECT a, n, unnest(s) AS shingle FROM classes),
pairs AS (SELECT x.a AS a, y.a AS b, x.n AS n, y.n AS m, count(*) AS common FROM each x JOIN each y ON x.shingle = y.shingle AND x.a <> y.a AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (n + m - common)),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
named AS (SELECT a, min(b) AS least FROM reached GROUP BY a),
found AS (SELECT s, least(classes.a, coalesce(named.least, classes.a)) AS component_id FROM classes LEFT JOIN named ON classes.a = named.a)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN found ON list_sort(sets.s) = found.s""",
    "op11_spelling_variants": """
WITH RECURSIVE table_of AS (
  SELECT list_transform(range(256), lambda v: list_reduce(range(8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE text IS NOT NULL),
lowered AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
spelt AS (SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM lowered),
bytes AS (
  SELECT run, n, flatten(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN ord(s[i]) < 128 THEN [ord(s[i])::BIGINT]
    ELSE [(192 | (ord(s[i]) >> 6))::BIGINT, (128 | (ord(s[i]) & 63))::BIGINT] END)) AS b FROM spelt),
hashed AS (
  SELECT run, n, xor(list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) AS h FROM bytes, table_of),
cut AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gaps AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM gaps x JOIN gaps y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT w.word, w.n, g.word, g.n FROM words w JOIN gaps g ON w.word = g.rest
  UNION SELECT g.word, g.n, w.word, w.n FROM words w JOIN gaps g ON w.word = g.rest),
counted AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
forms AS (
  SELECT word, other AS form, other_n AS form_n FROM near WHERE other_n >= 10 * n
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
follow(word, root) AS (SELECT word, form FROM forms UNION ALL SELECT f.word, g.form FROM follow f JOIN forms g ON f.root = g.word),
roots AS (SELECT word, root FROM follow WHERE root NOT IN (SELECT word FROM forms))
SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM words w LEFT JOIN counted USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)""",
    "op13_hard_negatives": """
WITH rows_ AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, a.v AS av, c.vec_id, c.label, c.v, coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM rows_ a JOIN rows_ c ON a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, av, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own AND NOT (vec_id = anchor_id AND v = av)
  QUALIFY row_number() OVER (PARTITION BY anchor_id, own, av ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND s.label <> s.own
WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3""",
}
