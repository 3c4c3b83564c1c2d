"""The registered queries of this subpackage and, where SQL can say it, the same in DuckDB's."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, jaccard, languages, lexical, licenses, neighbours, pages, phrases, sharding, substrings, tokenfiles, vectors

RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = substrings.repeated_passages(docs).select(*substrings.KEYS, "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
    return substrings.attach(docs, found).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("licences").cast("long").alias("n_licences"), F.array_join(F.array_sort(F.array_distinct("licences.name")), ",").alias("licence_names"), "licences")


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path(RANKS))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    file = Path(public_tokenizers.path(TOKENIZER)).read_text(encoding="utf-8")
    manifest = tokenfiles.write(docs, file, 2, tokenfiles.folder(spark))
    return tokenfiles.read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(_table(spark, folder, "pages").select("page_id", "url", "html")).drop("html")


def op6_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, folder, "embeddings"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.scan(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op8_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(_table(spark, folder, "documents"))


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.with_components(_table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    filters = languages.fit(docs.where(~languages.held_out(F.col("doc_id"))))
    found = languages.predict(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op12_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_substring_dedup, op2_license_scan, op3_bpe, op4_token_files, op5_main_text, op6_near_vectors, op7_decontaminate, op8_shards, op9_jaccard, op10_language, op11_collocations, op12_nearest, op13_ranked_search, pipeline)
}

#: A-Z to a-z, and nothing else.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), places AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM worded
), spans AS (
    SELECT lang, ws, i, unnest(range(1, 6)) AS k FROM places
), f AS (
    SELECT lang, k, list_slice(ws, i, i + k - 1) AS g, count(*)::HUGEINT AS f FROM spans WHERE i + k - 1 <= len(ws) GROUP BY ALL
), n AS (
    SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
    SELECT * FROM f WHERE k > 1 AND f >= 100
), covered AS (
    SELECT DISTINCT c.lang, c.g FROM cand c JOIN cand x ON x.lang = c.lang AND x.k = c.k + 1 AND x.f >= c.f
        AND (list_slice(x.g, 1, c.k) = c.g OR list_slice(x.g, 2, x.k) = c.g)
), cuts AS (
    SELECT c.*, unnest(range(1, c.k)) AS cut FROM cand c ANTI JOIN covered USING (lang, g)
), scored AS (
    SELECT c.lang, c.g, c.f AS a, c.cut, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * c.f * n.n) // (l.f * r.f) AS score
    FROM cuts c JOIN f l ON l.lang = c.lang AND l.g = list_slice(c.g, 1, c.cut)
        JOIN f r ON r.lang = c.lang AND r.g = list_slice(c.g, c.cut + 1, c.k) JOIN n ON n.lang = c.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM lowest
)
SELECT lang, rank, array_to_string(g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = rf"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS d, {_TERMS} AS ts FROM documents
), sizes AS (
    SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_words FROM docs WHERE len(ts) > 0
), tf AS (
    SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(ts) AS t FROM docs) GROUP BY d, t
), items AS (
    SELECT item_id, row_number() OVER () AS q, {_TERMS} AS ts FROM benchmark
), asked AS (
    SELECT DISTINCT q, t FROM (SELECT q, unnest(ts) AS t FROM items)
), weights AS (
    SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, sizes GROUP BY t, n_docs
), scores AS (
    SELECT q, d, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(ts) * n_docs) // n_words))))::BIGINT AS score
    FROM asked JOIN weights USING (t) JOIN tf USING (t) JOIN docs USING (d), sizes GROUP BY q, d
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM scores JOIN docs USING (d) JOIN items USING (q) WHERE score > 0
) WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op11_collocations": OP11_SQL, "op13_ranked_search": OP13_SQL}
