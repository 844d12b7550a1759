"""The raw, feature, enriched and analytic layers, alone or in order."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.constants import DOCUMENT_SUFFIXES, SHORT_TEXT_CHARS, UNKNOWN_TOPIC
from doclake.functions.messages import now_or, whole_seconds
from doclake.functions.topics import DEFAULT_LEXICON, classify_topic, summarise
from doclake.operators.cleaning import clean_long_texts
from doclake.operators.extract import ParserFactory, extract_documents
from doclake.operators.features import embed_documents, hashing_tf, idf_weights, tokenize
from doclake.operators.models import BatchModel, label_model, text_model
from doclake.operators.quality import check_models
from doclake.operators.tables import KeyedTable, bucket_count, table_mart, write_table
from doclake.plans.marts import mart_by_topic, mart_summaries, stg_normalise
from doclake.session import scratch_path
from doclake.sources.files import scan_files

# The columns of the enriched table; ``file_name`` is its key.
GOLD_SCHEMA = (
    "file_name string, content_type string, title string, author string, language string, "
    "num_pages string, text_length int, topic string, summary string, "
    "ingested_at timestamp, processed_at timestamp, enriched_at timestamp"
)


TASK_BYTES = 8 << 20  # of text that one task summarises and classifies


def dealt_texts(stored: DataFrame, text: str = "text_clean", task_bytes: int = TASK_BYTES) -> DataFrame:
    """A stored table in parts of about ``task_bytes`` of text.

    Summaries cost far more than reading, and files are split by their
    compressed size, at row groups: left as they are, tasks would grow with the files.
    """
    size = stored.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = -(-size // task_bytes)
    if parts <= 1:
        return stored
    return stored.repartition(max(parts, stored.sparkSession.sparkContext.defaultParallelism), "file_name", "text_length")


def bronze(
    spark: SparkSession,
    folder: str,
    parser: ParserFactory | None = None,
    suffixes: Sequence[str] = DOCUMENT_SUFFIXES,
    recursive: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """Raw documents from a folder of files."""
    files = scan_files(spark, folder, suffixes, recursive=recursive)
    return extract_documents(files.select("file_name", "content"), parser, now)


def silver(
    raw: DataFrame,
    model: BatchModel | None = None,
    now: Column | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """Clean text with its length, TF-IDF and embedding; too short texts are left out."""
    cleaned = clean_long_texts(raw).drop("text_content")
    counted = hashing_tf(tokenize(cleaned, target="_words"), target="_counts", words="_words")
    embedded = embed_documents(counted, model=model, max_chars=max_chars, words="_words")
    # Cleaned, tokenised and counted once: fitting and weighting read the stored counts.
    path = scratch_path(raw.sparkSession, "counted")
    embedded.drop("_words").write.parquet(path)
    weighted = idf_weights(raw.sparkSession.read.parquet(path), "_counts")
    return weighted.drop("_counts").withColumn("processed_at", now_or(now))


def gold(
    features: DataFrame,
    lexicon: Mapping[str, Sequence[str]] = DEFAULT_LEXICON,
    summary_model: BatchModel | None = None,
    topic_model: BatchModel | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Topic and summary of each document, ready for the keyed table."""
    text = F.col("text_clean")
    given = F.coalesce(text, F.lit(""))
    summary, topic = summarise(text), classify_topic(text, lexicon)
    # Fixed rules come before any model: short texts are their own summary, and
    # a text that is missing has no topic.
    if summary_model:
        modelled = text_model(summary_model, "string")(F.when(F.length(given) >= SHORT_TEXT_CHARS, text))
        summary = F.when(F.length(given) < SHORT_TEXT_CHARS, given).otherwise(modelled)
    if topic_model:
        modelled = label_model(topic_model)(F.when(given != "", text))
        topic = F.when(given == "", UNKNOWN_TOPIC).otherwise(modelled)
    return features.select(
        "file_name",
        "content_type",
        "title",
        "author",
        "language",
        "num_pages",
        "text_length",
        topic.alias("topic"),
        summary.alias("summary"),
        whole_seconds("ingested_at").alias("ingested_at"),
        whole_seconds("processed_at").alias("processed_at"),
        whole_seconds(now_or(now)).alias("enriched_at"),
    )


@dataclass
class Lake:
    """Where the layers live and what they are made with."""

    spark: SparkSession
    root: str
    folder: str
    database: str = "doclake"
    recursive: bool = False
    parser: ParserFactory | None = None
    embedding: BatchModel | None = None
    summary_model: BatchModel | None = None
    topic_model: BatchModel | None = None
    max_chars: int | None = None
    lexicon: Mapping[str, Sequence[str]] = field(default_factory=lambda: DEFAULT_LEXICON)
    now: Column | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def enriched(self) -> KeyedTable:
        return KeyedTable(
            self.spark, self.path("gold", "documents_enriched"), "file_name", GOLD_SCHEMA
        )


def _run_bronze(lake: Lake, batch_id: str) -> int:
    raw = bronze(
        lake.spark, lake.folder, lake.parser, recursive=lake.recursive, now=lake.now
    )
    return write_table(
        raw, lake.table("documents"), lake.path("bronze", "documents"), lake.path("db")
    )


def _run_silver(lake: Lake, batch_id: str) -> int:
    raw = lake.spark.read.parquet(lake.path("bronze", "documents"))
    return write_table(
        silver(raw, lake.embedding, lake.now, lake.max_chars),
        lake.table("documents_features"),
        lake.path("silver", "documents_features"),
        lake.path("db"),
    )


def _run_gold(lake: Lake, batch_id: str) -> int:
    features = lake.spark.read.parquet(lake.path("silver", "documents_features"))
    table = lake.enriched()
    enriched = gold(dealt_texts(features), lake.lexicon, lake.summary_model, lake.topic_model, lake.now)
    table.upsert(enriched, batch_id, ["enriched_at"])
    return table.written(batch_id)


LAYERS: dict[str, Callable[[Lake, str], int]] = {
    "bronze": _run_bronze,
    "silver": _run_silver,
    "gold": _run_gold,
}


def run_layers(
    lake: Lake, layer: str | None = None, batch_id: str | None = None
) -> dict[str, int]:
    """Run one layer by name, or all of them in order; returns rows per layer.

    Each run adds to the enriched table under a name of its own. Give the
    ``batch_id`` of a run that failed to run it again in its place.
    """
    if layer is not None and layer not in LAYERS:
        raise ValueError(f"no layer {layer!r}; choose from {', '.join(LAYERS)}")
    chosen = [layer] if layer else list(LAYERS)
    batch_id = batch_id or f"run-{uuid.uuid4().hex}"
    return {name: LAYERS[name](lake, batch_id) for name in chosen}


def run_marts(lake: Lake) -> DataFrame:
    """Store both marts and return the result of the quality rules.

    Staging reads the live rows of the keyed table, which takes a shuffle, so
    it is written once and both marts and their rules read the stored rows.
    """
    staged = lake.table("stg_documents_enriched")
    rows = write_table(
        stg_normalise(lake.enriched().latest()),
        staged,
        lake.path("marts", "stg_documents_enriched"),
        lake.path("db"),
    )
    staging = lake.spark.table(staged)
    models = {"stg_documents_enriched": staging}
    for name, build in (
        ("mart_documents_by_topic", mart_by_topic),
        ("mart_document_summaries", mart_summaries),
    ):
        models[name] = table_mart(
            build(staging),
            lake.table(name),
            lake.path("marts", name),
            buckets=bucket_count(rows),
            database_path=lake.path("db"),
        )
    return check_models(models)
