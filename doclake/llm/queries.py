"""The registered queries of the operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm import fertility, language, pii, quality, secret_scan, spans
from doclake.llm.bpe import encode_decode
from doclake.llm.common import crc_mod, documents
from doclake.llm.mixing import mix_sources
from doclake.llm.ngram_join import link_groups
from doclake.llm.packing import pack, token_pieces
from doclake.llm.passages import remove_repeated_passages
from doclake.llm.spelling import count_words, group_variants
from doclake.llm.topk import top_k
from doclake.llm.whitening import whiten


TOP_K_SQL = """
WITH clean AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(max(list_inner_product(q.v, c.v)) AS BIGINT) AS score
    FROM clean q JOIN clean c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 50 = 0
    GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""


JOIN_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(id, root) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT b, root FROM reached JOIN edges ON id = a WHERE root < b
)
SELECT id AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id
FROM reached LEFT JOIN sizes ON doc_id = id GROUP BY id
"""


# A source stops at three times its size. In the order of size per weight those that
# stop come first: the level is that of the first one that may stay below its limit.
MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, text, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
    FROM documents
), sources AS (
    SELECT source, sum(size) AS source_size,
        [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM sized GROUP BY source
), ranked AS (
    SELECT *, sum(source_size) OVER () AS words,
        coalesce(sum(3 * source_size) OVER before, 0) AS stopped,
        sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
    FROM sources
    WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT words - stopped AS free, open_weight AS open FROM ranked
    WHERE weight * (words - stopped) <= 3 * source_size * open_weight
    ORDER BY source_size / weight, source NULLS LAST LIMIT 1
), targets AS (
    SELECT source, source_size, CASE WHEN weight * free > 3 * source_size * open
        THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(weight * free AS DOUBLE) / greatest(open, 1) END AS target
    FROM ranked, level
), rates AS (
    SELECT doc_id, text, size, source_size, target,
        CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END AS rate
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
    CAST(size * (floor(rate) + CASE WHEN
        CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 13) AS BIGINT)
        / CAST(4503599627370496 AS DOUBLE) < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
"""


def op1_information_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[spans.count(F.col("pii_base"), kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]],
        F.sha2(spans.listed(F.col("pii_base")), 256).alias("base_sha256"),
        spans.listed(F.col("pii_spans")).alias("spans"),
    )


def op2_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs.filter(crc_mod("doc_id", 4) != 2))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op3_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.fit(docs))
    return found.select(
        "doc_id",
        *[spans.count(F.col("secret_base"), kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]],
        F.sha2(spans.listed(F.col("secret_base")), 256).alias("base_sha256"),
        spans.listed(F.col("secret_spans")).alias("spans"),
    )


def op4_word_table_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(documents(spark, sf_dir))


def op5_size_aware_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_groups(documents(spark, sf_dir))


def op6_paragraph_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(documents(spark, sf_dir).select("doc_id", "text"))


def op7_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    judged = fertility.quality_rules(docs).drop("lang")
    first = ["doc_id", *fertility.BASE, "base_failed", "kept"]
    return judged.select(*first, *[c for c in judged.columns if c not in first])


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Learned from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(crc_mod("doc_id", 5) != 0)
    return quality.fit(documents(spark, sf_dir), labels)


def op8_naive_bayes_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(documents(spark, sf_dir).select("doc_id", "text"), quality_model(spark, sf_dir))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(documents(spark, sf_dir).select("doc_id", "text")))


def op10_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


def op11_contour_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_trie_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(count_words(documents(spark, sf_dir)))


def op13_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_information_pii": op1_information_pii,
        "op2_language_spans": op2_language_spans,
        "op3_markov_secrets": op3_markov_secrets,
        "op4_word_table_bpe": op4_word_table_bpe,
        "op5_size_aware_join": op5_size_aware_join,
        "op6_paragraph_bands": op6_paragraph_bands,
        "op7_tokeniser_fertility": op7_tokeniser_fertility,
        "op8_naive_bayes_svm": op8_naive_bayes_svm,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_threshold_top_k": op10_threshold_top_k,
        "op11_contour_whitening": op11_contour_whitening,
        "op12_trie_variants": op12_trie_variants,
        "op13_mix_sources": op13_mix_sources,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_size_aware_join": JOIN_SQL,
        "op10_threshold_top_k": TOP_K_SQL,
        "op13_mix_sources": MIX_SQL,
    }
