"""A training corpus from documents, in five stages.

Each stage gets the documents that the one before it kept, as a stored table.
Documents that the quality classifier rejects go; one of each group of near
copies stays; passages that repeat across documents go; personal data is
replaced; the rest is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm import packing, passages, pii, quality
from doclake.llm.common import crc_mod, near_keys, stored
from doclake.llm.ngram_join import link_groups


def with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with ``n_chars`` (where there is one) of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return docs.select(*columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels not held out, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(crc_mod("doc_id", 5) != 0)
    model = quality.fit(docs, labels)
    return quality.score(docs, model).filter("predicted = 1").select(*docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id.

    Texts link by shingles of five words at 80 %, not by op5's own numbers. Of
    rows with one id, one stays; rows without an id are linked with nothing.
    """
    linked = link_groups(docs.select("doc_id", "text"), width=5, percent=80)
    groups = stored(linked, "groups").filter("doc_id IS NOT NULL")
    gone = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    several = groups.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    concerned = stored(gone.unionByName(several).distinct(), "concerned")
    # only documents that may go are shuffled
    known = docs.filter("doc_id IS NOT NULL")
    kept = (
        near_keys(known, "doc_id", concerned, "doc_id")
        .join(gone, "doc_id", "left_anti")
        .dropDuplicates(["doc_id"])
    )
    others = near_keys(known, "doc_id", concerned, "doc_id", "left_anti")
    return kept.select(*docs.columns).unionByName(others).unionByName(docs.filter("doc_id IS NULL"))


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_length(passages.remove_repeated_passages(docs), docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_length(pii.sanitise(docs), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs.select("doc_id", "text")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("passages", passages_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

# Learned weights and MinHash bands have no SQL twin; a test holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
