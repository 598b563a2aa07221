"""Registered queries of the corpus operators, with SQL where it can express them."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import Query
from tidemark.llm.common import documents, table
from tidemark.llm.decontaminate import contamination, hit_words
from tidemark.llm.embedding_join import near_vectors
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.filter_audit import failure_masks, filter_audit
from tidemark.llm.licenses import license_scan
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.ngram_join import ngram_join
from tidemark.llm.packing import pack
from tidemark.llm.pii import KINDS as PII_KINDS
from tidemark.llm.pii import personal_data
from tidemark.llm.quality import quality_scores
from tidemark.llm.ranked_search import ranked_search
from tidemark.llm.secrets import KINDS as SECRET_KINDS
from tidemark.llm.secrets import secret_spans
from tidemark.llm.token_counts import token_counts


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


NGRAM_JOIN_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents
),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 2), lambda p: array_to_string(ws[p : p + 3], ' ')) END)) AS e FROM d
),
u AS (SELECT e, min(doc_id) AS id, len(e) AS n FROM s WHERE len(e) > 0 GROUP BY e),
x AS (SELECT id, n, unnest(e) AS t FROM u),
p AS (
  SELECT a.id AS a, b.id AS b FROM x a JOIN x b ON a.t = b.t AND a.id < b.id
         AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p UNION ALL SELECT id, id FROM u),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS root FROM r GROUP BY a)
SELECT s.doc_id, len(s.e) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id
FROM s LEFT JOIN u ON s.e = u.e LEFT JOIN c ON u.id = c.a
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text"
    )


LINE_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, text, md5(text) AS h, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
w AS (
  SELECT doc_id, h, p, ls[p] AS a, ls[p + 1] AS b, ls[p + 2] AS c
  FROM (SELECT doc_id, h, ls, unnest(range(1, len(ls) - 1)) AS p FROM d WHERE len(ls) >= 3)
  WHERE trim(ls[p] || ls[p + 1] || ls[p + 2], ' ') <> ''
),
f AS (
  SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id NULLS LAST, p) AS n FROM w
),
g AS (SELECT DISTINCT doc_id, h, unnest([p, p + 1, p + 2]) AS p FROM f WHERE n > 1),
l AS (SELECT doc_id, h, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM d),
k AS (
  SELECT l.doc_id, l.h, count(*) AS n_lines, count(g.p) AS n_removed,
         coalesce(string_agg(CASE WHEN g.p IS NULL THEN line END, chr(10) ORDER BY l.p), '') AS text
  FROM l LEFT JOIN g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.h = g.h AND l.p = g.p GROUP BY l.doc_id, l.h
)
SELECT doc_id, n_lines, n_removed, text FROM k
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    n_hit = hit_words(F.col("hits"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join(items, ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, hash(text) AS h, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
),
n AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM b WHERE len(ws) > 0),
w AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[p : p + n - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS p FROM n)
),
g AS (
  SELECT doc_id, h, p, n, array_to_string(ws[p : p + n - 1], ' ') AS words
  FROM (SELECT d.*, l.n, unnest(range(1, len(ws) - l.n + 2)) AS p FROM d, (SELECT DISTINCT n FROM w) l WHERE len(ws) >= l.n)
),
f AS (SELECT DISTINCT g.doc_id, g.h, g.p, g.n, w.item_id FROM g JOIN w USING (n, words)),
i AS (
  SELECT doc_id, h, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, h, item_id FROM f) GROUP BY doc_id, h
),
c AS (
  SELECT doc_id, h, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, h, unnest(range(p, p + n)) AS q FROM f) GROUP BY doc_id, h
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN i ON d.doc_id IS NOT DISTINCT FROM i.doc_id AND d.h IS NOT DISTINCT FROM i.h
LEFT JOIN c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.h IS NOT DISTINCT FROM c.h
"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(documents(spark, sf_dir))
    base = F.transform("phrases", lambda p: p["label"])
    named = F.filter("matches", lambda m: m["named"])
    added = F.transform(named, lambda m: m["label"])
    best = F.coalesce(F.array_max(F.transform(named, lambda m: m["containment"])), F.lit(0.0))

    def spelled(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases")["place"].alias("first_word"),
        F.array_max("phrases")["place"].alias("last_word"),
        spelled(base).alias("base_labels"),
        spelled(F.concat(base, added)).alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


EXACT_DEDUP_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""

def _spelled(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of each span, comma-joined; the spans' kinds are indexes."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(documents(spark, sf_dir))

    def of_kind(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(of_kind(k).alias(f"n_{SECRET_KINDS[k]}") for k in range(3)),
        F.sha2(_spelled(F.col("base"), SECRET_KINDS), 256).alias("base_sha256"),
        _spelled(F.array_sort(F.concat("base", "added")), SECRET_KINDS).alias("spans"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(documents(spark, sf_dir))

    def of_kind(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(of_kind(k).alias(f"n_{PII_KINDS[k]}") for k in range(4)),
        F.sha2(_spelled(F.col("base"), PII_KINDS), 256).alias("base_sha256"),
        _spelled(F.concat("base", "added"), PII_KINDS).alias("spans"),
    )


def op11_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


EMBEDDING_JOIN_SQL = r"""
WITH RECURSIVE r AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
v AS MATERIALIZED (
  SELECT r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM r
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
p AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
l AS (SELECT a, b FROM p UNION ALL SELECT r, r FROM v),
c AS (SELECT a, b FROM l UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a),
k AS (SELECT c.a, min(r.vec_id) AS component_id FROM c JOIN r ON c.b = r.r GROUP BY c.a),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, CASE WHEN k.a IS NULL THEN vec_id ELSE component_id END AS component_id,
       vec_id IS NOT DISTINCT FROM CASE WHEN k.a IS NULL THEN vec_id ELSE component_id END AS kept
FROM r LEFT JOIN k ON r.r = k.a LEFT JOIN n ON r.r = n.a
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = failure_masks(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return filter_audit(masks, "ABCDE").drop("filter")


FILTER_AUDIT_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
k AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
f AS (
  SELECT doc_id, part, concat(
    CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails FROM d
),
m AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN k USING (doc_id) GROUP BY part, fails
),
o AS (
  SELECT '' AS filter_order
  UNION ALL SELECT filter_order || l FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(filter_order, l)
),
s AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS l, filter_order[1:step - 1] AS before
  FROM o, range(1, 6) x(step) WHERE length(filter_order) = 5
),
r AS (
  SELECT part, filter_order, step, l,
         coalesce(sum(n) FILTER (NOT hit AND NOT contains(fails, l)), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (NOT hit AND contains(fails, l)), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND contains(fails, l)), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = l), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (NOT hit AND contains(fails, l)), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (NOT hit AND contains(fails, l)), 0)::BIGINT AS toxic_lost
  FROM (SELECT s.*, m.*, regexp_matches(fails, CASE WHEN before = '' THEN 'x' ELSE '[' || before || ']' END) AS hit FROM s, m)
  GROUP BY part, filter_order, step, l
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley
FROM r
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


RANKED_SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
g AS (SELECT count(*)::BIGINT AS n, sum(len(ws))::BIGINT AS l FROM d WHERE len(ws) > 0),
p AS (SELECT r, doc_id, len(ws)::BIGINT AS n, term, count(*) AS tf FROM (SELECT r, doc_id, ws, unnest(ws) AS term FROM d) GROUP BY r, doc_id, len(ws), term),
w AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * g.n + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g
),
s AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * p.n * g.n) // g.l))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), g GROUP BY item_id, r, doc_id
),
o AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 10
"""


QUERIES: dict[str, Query] = {
    "op1_ngram_join": Query(op1_ngram_join, NGRAM_JOIN_SQL),
    "op3_token_counts": Query(op3_token_counts, None),
    "op5_line_dedup": Query(op5_line_dedup, LINE_DEDUP_SQL),
    "op6_decontamination": Query(op6_decontamination, DECONTAMINATION_SQL),
    "op7_packing": Query(op7_packing, None),
    "op9_exact_dedup": Query(op9_exact_dedup, EXACT_DEDUP_SQL),
    "op10_secrets": Query(op10_secrets, None),
    "op8_licenses": Query(op8_licenses, None),
    "op4_quality": Query(op4_quality, None),
    "op2_pii": Query(op2_pii, None),
    "op11_embedding_join": Query(op11_embedding_join, EMBEDDING_JOIN_SQL),
    "op12_filter_audit": Query(op12_filter_audit, FILTER_AUDIT_SQL),
    "op13_ranked_search": Query(op13_ranked_search, RANKED_SEARCH_SQL),
    "pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
