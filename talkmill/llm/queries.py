"""The thin queries over whole tables, one for each operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact, language, media, negatives, packing, phrases, pii, quality, secrets, sharding, simhash, toxicity
from .common import doc_crc, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train_chain(docs, table(spark, sf_dir, "labels")))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(doc_crc("doc_id"), F.lit(4)) == 2, F.lit(False))
    model = language.train_languages(docs.where(~held_out))
    return language.predict_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.pmod(doc_crc("doc_id"), F.lit(5)) == 0, F.lit(False))
    model = quality.train_quality(docs, labels.where(~held_out))
    return quality.score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "passages")


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stored(media.texts_to_media(table(spark, sf_dir, "documents")), "media")
    read = media.media_features(kept)
    payload = F.col("payload")
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -32, 32)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        F.concat_ws(":", "dhash", F.sha2("tile", 256)).alias("feature"),
        "tile",
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_sharding": op3_sharding,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_quality": op7_quality,
    "op8_media_columns": op8_media_columns,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_pii_spans": op10_pii_spans,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}

#: DuckDB's SQL for the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op11_exact_dedup": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size, row_number() OVER w = 1 AS kept, sha256(k) AS text_sha256
FROM t WINDOW w AS (PARTITION BY k ORDER BY length(x) DESC, doc_id NULLS LAST)""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS p, string_split_regex(piece, '[\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, p, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM numbered),
w AS MATERIALIZED (SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM words WHERE x <> '' WINDOW o AS (PARTITION BY p ORDER BY i)),
grams AS (
  SELECT lang, 1 AS m, x AS phrase FROM w UNION ALL SELECT lang, 2, x || ' ' || y FROM w WHERE y IS NOT NULL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM w WHERE z IS NOT NULL),
counts AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE m > 1 AND f >= 10),
parts AS MATERIALIZED (
  SELECT lang, m, phrase, a, k, array_to_string(w[1 : k], ' ') AS first, array_to_string(w[k + 1 :], ' ') AS rest
  FROM (SELECT *, unnest(CASE m WHEN 2 THEN [1] ELSE [1, 2] END) AS k FROM cand)),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, l.f AS l, r.f AS r, CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM parts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.first JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, a AS longer, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE m = 3),
held AS (SELECT DISTINCT i.lang, i.phrase FROM inner_ i JOIN cand c ON c.lang = i.lang AND c.phrase = i.phrase WHERE 100 * i.longer >= 50 * c.a),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, score
  FROM best b ANTI JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
