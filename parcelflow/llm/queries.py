"""Registered queries of the operators in this package, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import (
    factorization,
    jaccard_join,
    language,
    licenses,
    line_dedup,
    mixing,
    multi_index,
    phrase_index,
    pseudonyms,
    quality,
    repair,
    shards,
    spelling,
)

# A cluster passes a secret of its own to the operator.
KEY = "registered-query"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all vectors."""
    vectors = _table(spark, sf_dir, "embeddings")
    return multi_index.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a similarity of 0.85."""
    similarity = jaccard_join.Similarity(words=4, percent=85)
    return jaccard_join.linked_documents(_table(spark, sf_dir, "documents"), similarity)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in all documents."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts with pseudonyms for personal data."""
    named = pseudonyms.pseudonymise(_table(spark, sf_dir, "documents"), KEY)
    return named.select("doc_id", "n_private", "text")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose bytes are near equal, equal texts together."""
    placed = shards.assign_shards(_table(spark, sf_dir, "documents"), 16)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that a mix of the sources takes."""
    return mixing.taken_words(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents share."""
    kept = line_dedup.without_shared_lines(_table(spark, sf_dir, "documents"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word passages of the benchmark in all documents, and items found with three words more among them."""
    docs, items = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return phrase_index.contamination(docs, items, length=10, slop=3).drop("content")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from three quarters of the labels."""
    docs, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = _remainder(4) == 2
    machine = factorization.learn(docs, labels.where(~held_out))
    return factorization.score(docs, machine).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from four fifths of them."""
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder(5) == 0
    network = language.learn(docs.where(~held_out))
    return language.identify(docs, network).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words that all documents hold three times or more."""
    return spelling.variants(spelling.counted_words(_table(spark, sf_dir, "documents")))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from three quarters of the labels."""
    docs, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = _remainder(4) == 2
    classifier = quality.learn(docs, labels.where(~held_out))
    return quality.score(docs, classifier).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repairs of all conversations after damage."""
    turns = _table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(turns), every=turns)


def _remainder(parts: int) -> Column:
    """Remainder of the id's crc32; a row without an id has that of an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts


QUERIES: dict[str, Query] = {
    "op1_multi_index": op1_multi_index,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_licenses": op3_licenses,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_shards": op5_shards,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_phrase_index": op8_phrase_index,
    "op9_toxicity": op9_toxicity,
    "op10_language": op10_language,
    "op11_spelling": op11_spelling,
    "op12_quality": op12_quality,
    "op13_repair": op13_repair,
}

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op6_mixing": r"""
WITH sized AS (
    SELECT doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS size,
           CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS tie
    FROM documents
),
totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source
),
levels AS (
    SELECT s.*, 2 * source_size AS cap,
           (SELECT sum(least(2 * o.source_size * s.weight, 2 * s.source_size * o.weight))
            FROM totals o) <= 1.5 * (SELECT sum(source_size) FROM totals) * s.weight AS is_full
    FROM totals s
),
shared AS (
    SELECT *,
           1.5::DOUBLE * (SELECT sum(source_size) FROM levels)
           - coalesce((SELECT sum(cap) FROM levels WHERE is_full), 0) AS rest,
           (SELECT sum(weight) FROM levels WHERE NOT is_full) AS weights
    FROM levels
),
targets AS (
    SELECT source, source_size,
           CASE WHEN is_full THEN CAST(cap AS DOUBLE)
                ELSE CAST(rest AS DOUBLE) * weight / CAST(weights AS DOUBLE) END AS target,
           CAST('0x' || substr(md5(coalesce(source, '')), 1, 15) AS BIGINT)
           / CAST(1152921504606846976 AS DOUBLE) AS start_at
    FROM shared
),
placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, t.start_at,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS copies,
           CAST(row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.tie, s.doc_id) AS DOUBLE) AS upto
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(floor(upto * copies + start_at) - floor((upto - 1) * copies + start_at) AS BIGINT) * size AS taken
FROM placed
""",
    "op7_line_dedup": f"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
),
lines AS (
    SELECT row, doc_id, text, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM texts
),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM lines),
shared AS (
    SELECT key FROM (SELECT DISTINCT key, doc_id, text FROM keyed WHERE length(key) >= 1)
    GROUP BY key HAVING count(*) >= 10
),
marked AS (SELECT k.*, s.key IS NOT NULL AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
""",
    "op8_phrase_index": rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS words
    FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '{_WORD}') AS words
    FROM benchmark WHERE item_id IS NOT NULL
),
windows AS (
    SELECT item_id, unnest(list_transform(
        range(greatest(1, len(words) - 9)), lambda i: array_to_string(words[i + 1 : i + 10], ' '))) AS phrase,
        least(10, len(words)) AS length
    FROM items WHERE len(words) > 0
),
lengths AS (SELECT DISTINCT length FROM windows),
places AS (
    SELECT row, length, unnest(range(len(words) - length + 1)) AS start, words
    FROM texts, lengths WHERE len(words) >= length
),
matches AS (
    SELECT p.row, p.start, w.length, w.item_id
    FROM (SELECT *, array_to_string(words[start + 1 : start + length], ' ') AS phrase FROM places) p
    JOIN windows w ON w.phrase = p.phrase AND w.length = p.length
),
hits AS (
    SELECT row, count(DISTINCT place) AS n_hit
    FROM (SELECT row, unnest(range(start, start + length)) AS place FROM matches) GROUP BY row
),
owners AS (
    SELECT row, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM matches) GROUP BY row
),
stretches AS (
    SELECT row, length, words[start + 1] AS first,
           array_to_string(words[start + 1 : start + length + 3], ' ') || ' ' AS stretch
    FROM places
),
near AS (
    SELECT row, count(DISTINCT item_id) AS n_near
    FROM stretches s
    JOIN (SELECT *, split_part(phrase, ' ', 1) AS first, split_part(phrase, ' ', -1) AS last,
                 '^' || replace(phrase, ' ', ' (?:[^ ]+ )*') || ' ' AS pattern FROM windows) w
      ON w.first = s.first AND w.length = s.length
    WHERE contains(s.stretch, w.last || ' ') AND regexp_matches(s.stretch, w.pattern)
    GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(n_near, 0) AS n_near,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN hits USING (row) LEFT JOIN owners USING (row) LEFT JOIN near USING (row)
""",
}
