"""The given tables in the shapes of the layers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators.cleaning import clean_long_texts, with_clean_text
from doclake.operators.features import embed_documents
from doclake.operators.tables import KeyedTable
from doclake.plans.layers import GOLD_SCHEMA, Lake, dealt_texts, gold
from doclake.plans.marts import stg_normalise
from doclake.session import scratch_path
from doclake.sources import scan_parquet

# The topic labels with words that are frequent in the given texts.
LEXICON = {
    "economia": ("the", "of"),
    "imóveis": ("and", "to"),
    "inflação": ("der", "die"),
    "mercado financeiro": ("de", "le"),
    "política": ("la", "el"),
    "tecnologia": ("und", "in"),
}
QUALITY = ("low", "high")


# Tables with texts to work on, and what tells their rows apart.
TEXTS = {"documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}


FILE_BYTES = 16 << 20  # of a text table's file that one task reads without dealing its rows
PART_BYTES = 4 << 20  # of such files to a part where rows are dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. A text table in one file or large ones is dealt out, in more parts the larger it is."""
    path = f"{sf_dir}/{name}.parquet"
    df = scan_parquet(spark, path)
    if name not in TEXTS:
        return df
    files = len(df.inputFiles())
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    size = listed.agg(F.sum("length")).first()[0] or 0
    if files == 1 or size > files * FILE_BYTES:
        parts = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
        return df.repartition(parts, *TEXTS[name])
    return df


def fixed_time(text: str = "2025-03-01 12:00:00") -> Column:
    return F.lit(text).cast("timestamp")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze columns made from ``documents``; blanks follow language and length."""
    seconds = F.make_dt_interval(secs=F.col("doc_id").cast("decimal(18,6)"))
    return table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias(
            "file_name"
        ),
        F.lit("text/plain").alias("content_type"),
        F.col("text").alias("text_content"),
        F.when(F.col("lang") == "de", "").otherwise(F.concat(F.lit(" "), "source")).alias("author"),
        F.when(F.col("lang") == "en", "  ")
        .otherwise(F.concat("source", F.lit(" "), "lang", F.lit(" ")))
        .alias("title"),
        F.lit("").alias("created"),
        F.when(F.col("lang") == "es", "").otherwise(F.col("lang")).alias("language"),
        F.when(
            F.col("n_chars") > 3000,
            F.concat(F.lit(" "), F.floor(F.col("n_chars") / 3000).cast("string")),
        )
        .when(F.col("n_chars") < 500, "x")
        .otherwise("")
        .alias("num_pages"),
        (fixed_time("2025-01-01 00:00:00") + seconds).alias("ingested_at"),
    )


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, layer: str, build) -> DataFrame:
    """A layer as a stored table, written once per application.

    The layers above read stored tables in production too; without this every
    query would build all the layers below it again.
    """
    key = (spark.sparkContext.applicationId, sf_dir, layer)
    if key not in _STORED:
        path = scratch_path(spark, layer)
        build(spark, sf_dir).write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def build_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_long_texts(raw_documents(spark, sf_dir))
    return cleaned.drop("text_content").withColumn("processed_at", fixed_time())


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver without vectors."""
    return stored(spark, sf_dir, "clean", build_clean)


def plain_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text_clean, text_length`` of every document, short ones included."""
    return with_clean_text(table(spark, sf_dir, "documents"), "text").select(
        "doc_id", "text_clean", "text_length"
    )


def build_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold; enriched two hours after ingestion."""
    later = F.col("ingested_at") + F.expr("interval 2 hours")
    return gold(dealt_texts(clean_documents(spark, sf_dir)), LEXICON, now=later)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "enriched", build_enriched)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_normalise(enriched(spark, sf_dir))


def build_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_documents(clean_documents(spark, sf_dir)).select(
        "file_name", "text_clean", "embedding"
    )


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver vectors."""
    return stored(spark, sf_dir, "embedded", build_embedded)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def centroids(spark: SparkSession, sf_dir: str, by_label: bool = True) -> DataFrame:
    """The mean vector of each label, or of the whole table."""
    vectors = table(spark, sf_dir, "embeddings")
    key = F.col("label") if by_label else F.lit(-1)
    means = (
        vectors.select(key.alias("question_id"), F.posexplode("embedding").alias("pos", "x"))
        .groupBy("question_id", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    return means.groupBy("question_id").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"]
        ).alias("embedding")
    )


def messages(spark: SparkSession, sf_dir: str, key: str = "file_name") -> DataFrame:
    """One JSON message per document in ``value``; the title carries its number."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "file_name", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    )
    return docs.select(
        F.to_json(
            F.struct(
                F.col(key).alias("file_name"),
                F.col("text").alias("text_content"),
                F.col("lang").alias("content_type"),
                F.col("doc_id").cast("string").alias("title"),
            )
        ).alias("value"),
        F.col(key).alias("key"),
    )


def message_time() -> Column:
    """A time per message from the document number in its title."""
    seconds = F.make_dt_interval(secs=F.col("title").cast("decimal(18,6)"))
    return fixed_time("2025-01-01 00:00:00") + seconds


def fresh_database(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def fresh_lake(spark: SparkSession, folder: str = "") -> Lake:
    return Lake(
        spark,
        scratch_path(spark, "lake"),
        folder,
        database=fresh_database("lake"),
        lexicon=LEXICON,
        now=fixed_time(),
    )


def gold_table(spark: SparkSession) -> KeyedTable:
    return KeyedTable(spark, scratch_path(spark, "gold"), "file_name", GOLD_SCHEMA)
