"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.checks import inputs
from doclake.checks.inputs import LEXICON, QUALITY, table
from doclake.functions import messages as msg
from doclake.functions import text as txt
from doclake.functions import vectors as vec
from doclake.functions.metadata import first_value_or_empty, meta_fallback
from doclake.functions.topics import classify_topic, summarise
from doclake.operators import barrier_training as barrier_training_
from doclake.operators import answers, cleaning, features, quality, similarity, tables, training
from doclake.operators.extract import extract_documents, extract_pages
from doclake.operators.vector_index import VectorIndex
from doclake.plans import layers, marts, reports
from doclake.plans.ingest import ingest_tables
from doclake.session import cut_lineage, scratch_path
from doclake.sources import from_rows, scan_catalog, scan_csv, scan_files, scan_parquet, stream_source
from doclake.streaming import documents as documents_stream
from doclake.streaming.intake import Intake
from doclake.streaming import stream_classify, stream_run, stream_upsert

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _text(column: str):
    """A timestamp as text, the same in every client."""
    return msg.ts_to_text(column).alias(column)


def _times_as_text(df: DataFrame) -> DataFrame:
    return df.select(
        *[_text(f.name) if f.dataType.typeName().startswith("timestamp") else f.name for f in df.schema]
    )


# --- sources -----------------------------------------------------------------


def _write_files(rows: DataFrame, folder: str, key: str | None = None) -> None:
    """A text file for each row, or a folder ``key=value`` for each key.

    On a local disk Hadoop starts a program for the mode of every file and of its
    checksum, which takes longer than all else, so tasks write there themselves. A
    task that runs again writes the same names. Elsewhere Spark's writer does it.
    """
    spark = rows.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.getScheme() != "file":
        if key is None:
            rows.write.option("maxRecordsPerFile", 1).text(folder)
        else:
            rows.write.partitionBy(key).text(folder)
        return
    system.mkdirs(place)
    root = system.makeQualified(place).toUri().getPath()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            texts = batch["text"].to_pylist()
            for value, text in zip(batch[key].to_pylist() if key else texts, texts):
                if key:
                    name = f"{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
                    os.makedirs(f"{root}/{name}", exist_ok=True)
                    path = f"{root}/{name}/part-{task:05d}.txt"
                else:
                    path = f"{root}/part-{task:05d}-{number:09d}.txt"
                with open(path, "ab" if path == last else "wb") as file:
                    file.write((text or "").encode() + b"\n")
                number, last = number + 1, path
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], names=["files"])

    if key:
        rows = rows.sortWithinPartitions(key)
    rows.mapInArrow(write, "files long").agg(F.sum("files")).first()


def _write_text_files(spark: SparkSession, sf_dir: str) -> str:
    """One text file per document."""
    folder = scratch_path(spark, "files")
    _write_files(table(spark, sf_dir, "documents").select("text"), folder)
    return folder


@query
def scan_files_(spark, sf_dir):
    folder = scratch_path(spark, "files")
    table(spark, sf_dir, "documents").select("source", "text").write.partitionBy("source").text(folder)
    files = scan_files(spark, folder, recursive=True)
    return (
        files.groupBy(F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source"))
        .agg(F.sum("length").alias("bytes"))
    )


@query
def intake_runs(spark, sf_dir):
    """A file with the documents of each source, then a small one for each, then nothing new: each is read once."""
    folder = scratch_path(spark, "incoming")
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    by_source = docs.select("source", F.concat(F.col("doc_id"), F.lit("\n"), "text").alias("text"))

    def put(rows, mode):
        (
            rows.repartition("source").write.mode(mode).partitionBy("source")
            .option("lineSep", "\x00").text(folder)
        )

    put(by_source, "append")
    intake = Intake(spark, folder, scratch_path(spark, "intake"), recursive=True, now=inputs.fixed_time())
    runs = [intake.run()]
    put(docs.groupBy("source").agg(F.count(F.lit(1)).cast("string").alias("text")), "append")
    runs.append(intake.run())
    runs.append(intake.run())
    source = F.regexp_extract("file_name", "source=([^/]+)/", 1)
    ends = F.length("text_content") - F.length(F.regexp_replace("text_content", "\\x00", ""))
    taken = intake.table.latest().select(source.alias("source"), "bytes", ends.cast("long").alias("docs"))
    return taken.groupBy("source").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")
    ).select(
        "source", "files", "bytes", "docs",
        *[F.lit(r[name]).cast("bigint").alias(f"{name}_{i}") for i, r in enumerate(runs) for name in ("new", "changed")],
    )


@query
def scan_parquet_(spark, sf_dir):
    return scan_parquet(spark, f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "n_chars")


def _orders_csv(spark, sf_dir):
    folder = scratch_path(spark, "csv")
    table(spark, sf_dir, "orders").withColumn("o_orderdate", msg.ts_to_text("o_orderdate")).write.option(
        "header", True
    ).csv(folder)
    return folder


@query
def scan_csv_(spark, sf_dir):
    schema = (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate string, o_orderpriority string"
    )
    return scan_csv(spark, _orders_csv(spark, sf_dir), schema)


@query
def scan_catalog_(spark, sf_dir):
    name = inputs.fresh_database("catalog") + ".customer"
    folder = scratch_path(spark, "catalog")
    tables.write_table(table(spark, sf_dir, "customer"), name, f"{folder}/customer", folder)
    return scan_catalog(spark, name).select("c_custkey", "c_name", "c_mktsegment")


@query
def from_rows_(spark, sf_dir):
    labels = from_rows(spark, [(i, t) for i, t in enumerate(LEXICON)], "pos int, topic string")
    stats = inputs.enriched(spark, sf_dir).groupBy("topic").agg(F.count(F.lit(1)).alias("docs"))
    return labels.join(stats, "topic", "left").select(
        "pos", "topic", F.coalesce("docs", F.lit(0)).alias("docs")
    )


def _message_folder(spark, sf_dir, key="file_name"):
    """Message files; all messages of a key share a file."""
    folder = scratch_path(spark, "messages")
    inputs.messages(spark, sf_dir, key).repartition("key").select("value").write.text(folder)
    return folder


@query
def stream_source_(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    raw = stream_source(spark, "text", path=_message_folder(spark, sf_dir))
    parsed = raw.select(F.get_json_object("value", "$.file_name").alias("file_name"), "value")
    (
        parsed.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.parquet(out).select(
        "file_name", F.length(F.get_json_object("value", "$.text_content")).alias("chars")
    )


# --- sinks -------------------------------------------------------------------


@query
def write_table_(spark, sf_dir):
    name = inputs.fresh_database("bronze") + ".documents"
    folder = scratch_path(spark, "bronze")
    rows = tables.write_table(inputs.raw_documents(spark, sf_dir), name, f"{folder}/documents", folder)
    return (
        spark.table(name)
        .groupBy("language")
        .agg(
            F.count(F.lit(1)).alias("docs"),
            F.sum(F.length("text_content")).alias("chars"),
            F.lit(rows).cast("bigint").alias("written"),
        )
    )


@query
def upsert_by_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    order = ["ts", "event_id"]
    purchase = F.col("event_type") == "purchase"
    current = tables.latest_by_key(events.filter(~purchase), "user_id", order)
    merged = tables.upsert_by_key(current, events.filter(purchase), "user_id", order)
    return merged.select("user_id", "event_id", "event_type", "value")


@query
def stream_upsert_(spark, sf_dir):
    """Many messages per key: the latest one wins."""
    from doclake.streaming.documents import STREAM_SCHEMA

    keyed = tables.KeyedTable(spark, scratch_path(spark, "live"), "file_name", STREAM_SCHEMA)
    raw = stream_source(
        spark, "text", {"maxFilesPerTrigger": "4"}, path=_message_folder(spark, sf_dir, "source")
    )
    classified = stream_classify(raw, LEXICON, now=inputs.message_time())
    (
        classified.writeStream.foreachBatch(stream_upsert(keyed, "messages"))
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return _times_as_text(keyed.latest())


@query
def keyed_runs(spark, sf_dir):
    """Two runs, a compaction, replays of both and a stream that counts from zero again."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("file_name"), "doc_id", "lang"
    )
    schema = "file_name string, lang string, step int"

    def step(rows, number):
        return rows.select("file_name", "lang", F.lit(number).alias("step"), "doc_id")

    first = step(docs.filter("doc_id % 3 <> 0"), 1)
    second = step(docs.filter("doc_id % 3 <> 1"), 2)
    live = tables.KeyedTable(spark, scratch_path(spark, "live"), "file_name", schema)
    live.upsert(first, "run-a", ["doc_id"])
    live.upsert(second, "run-b", ["doc_id"])
    stream_upsert(live, "old-checkpoint", ["doc_id"])(step(docs.filter("doc_id % 7 = 0"), 3), 0)
    compacted = live.compact(scratch_path(spark, "compacted"))
    compacted.upsert(first, "run-a", ["doc_id"])
    compacted.upsert(second, "run-b", ["doc_id"])
    stream_upsert(compacted, "new-checkpoint", ["doc_id"])(step(docs.filter("doc_id % 5 = 0"), 4), 0)
    compacted.upsert(second, "run-b", ["doc_id"])
    return compacted.latest()


@query
def keyed_replays(spark, sf_dir):
    """Batches of similar names, one run again with other rows after a compaction, one in place."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "doc_id", "source"
    )
    live = tables.KeyedTable(spark, scratch_path(spark, "live"), "id", "id string, source string, step int")

    def step(condition, number):
        return docs.filter(condition).select("id", "source", F.lit(number).alias("step"))

    live.upsert(step("true", 1), "run:1")
    live.upsert(step("doc_id % 2 = 0", 2), "run_1")
    live.upsert(step("doc_id % 5 = 0", 3), "compacted")
    moved = live.compact(scratch_path(spark, "moved"))
    moved.upsert(step("doc_id % 4 = 0", 4), "run_1")
    moved.upsert(step("doc_id % 9 = 0", 5), "later")
    moved.compact()
    moved.upsert(step("doc_id % 3 <> 0", 6), "run:1")
    return moved.latest()


@query
def view_staging(spark, sf_dir):
    return _times_as_text(
        tables.view_staging(inputs.staging(spark, sf_dir), inputs.fresh_database("stg"))
    )


@query
def table_mart(spark, sf_dir):
    folder = scratch_path(spark, "marts")
    stored = tables.table_mart(
        marts.mart_summaries(inputs.staging(spark, sf_dir)),
        inputs.fresh_database("marts") + ".mart_document_summaries",
        f"{folder}/mart_document_summaries",
        database_path=folder,
    )
    return stored.select("file_name", "document_title", "topic", "text_length", "num_pages")


# --- projections and filters -------------------------------------------------


@query
def project_cols(spark, sf_dir):
    return inputs.clean_documents(spark, sf_dir).select(
        "file_name", "content_type", "title", "author", "language", "num_pages", "text_length"
    )


@query
def add_drop_cols(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("chars_per_page", F.col("n_chars") / 3000).withColumnRenamed(
        "lang", "language"
    ).drop("text", "source")


@query
def struct_expand(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int").alias("data")).select(
        "event_id", "data.*"
    )


@query
def filter_min_length(spark, sf_dir):
    return cleaning.filter_min_length(inputs.plain_clean(spark, sf_dir)).select("doc_id", "text_length")


@query
def filter_not_null(spark, sf_dir):
    return cleaning.filter_not_null(inputs.staging(spark, sf_dir), "num_pages", "language").select(
        "file_name", "num_pages", "language"
    )


@query
def filter_summary_length(spark, sf_dir):
    return cleaning.filter_summary_length(inputs.enriched(spark, sf_dir)).select(
        "file_name", F.octet_length("summary").alias("summary_bytes")
    )


@query
def filter_key_eq(spark, sf_dir):
    """The documents of one source; the key reaches the scan."""
    return (
        scan_parquet(spark, f"{sf_dir}/documents.parquet")
        .filter(F.col("source") == "src7")
        .select("doc_id", "source", "lang", "n_chars")
    )


@query
def empty_text_rows(spark, sf_dir):
    """Rows without a text, and rows whose title is blank."""
    raw = inputs.raw_documents(spark, sf_dir).withColumn("title", F.trim("title"))
    # one text in eleven or so is left out
    texts = raw.withColumn("text_content", F.when(F.length("text_content") % 11 > 0, F.col("text_content")))
    found = [
        cleaning.empty_text_rows(rows, column).select("file_name", F.lit(column).alias("column_name"))
        for rows, column in ((raw, "title"), (texts, "text_content"))
    ]
    return found[0].unionByName(found[1])


@query
def typed_clean(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")).alias("o_orderstatus"),
        F.concat(F.lit(" "), "o_orderpriority").alias("o_orderpriority"),
        F.concat(msg.ts_to_text("o_orderdate"), F.lit(" ")).alias("o_orderdate"),
    )
    return _times_as_text(cleaning.typed_clean(orders, ["o_orderdate", "not_there"]))


# --- joins -------------------------------------------------------------------


@query
def mart_by_topic(spark, sf_dir):
    return _times_as_text(marts.mart_by_topic(inputs.staging(spark, sf_dir))).withColumns(
        {c: F.round(c, 6) for c in ("topic_avg_text_length", "topic_avg_pages")}
    )


@query
def score_cross(spark, sf_dir):
    return similarity.score_documents(
        table(spark, sf_dir, "embeddings"),
        inputs.centroids(spark, sf_dir, by_label=False),
        doc_key="vec_id",
    ).select("vec_id", "score")


@query
def training_set(spark, sf_dir):
    silver = inputs.plain_clean(spark, sf_dir)
    gold = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "high").otherwise("low").alias("topic")
    )
    return training.training_set(silver, gold, "doc_id")


# --- aggregations ------------------------------------------------------------


@query
def topic_stats(spark, sf_dir):
    return _times_as_text(marts.topic_stats(inputs.staging(spark, sf_dir))).withColumns(
        {c: F.round(c, 6) for c in ("avg_text_length", "avg_pages")}
    )


@query
def row_count(spark, sf_dir):
    return quality.row_count(table(spark, sf_dir, "documents"))


@query
def doc_frequency(spark, sf_dir):
    return features.doc_frequency(inputs.clean_documents(spark, sf_dir))


@query
def check_unique(spark, sf_dir):
    return quality.check_unique(table(spark, sf_dir, "conversations"), "conv_id")


@query
def check_not_null(spark, sf_dir):
    return quality.check_not_null(
        inputs.staging(spark, sf_dir),
        ["file_name", "topic", "summary", "language", "num_pages", "document_author"],
    )


# --- sorts and reports -------------------------------------------------------


@query
def topk_similar(spark, sf_dir):
    return similarity.topk_similar(
        table(spark, sf_dir, "embeddings"), inputs.centroids(spark, sf_dir), doc_key="vec_id"
    )


@query
def topk_index(spark, sf_dir):
    """The same result as ``topk_similar``, out of a stored index."""
    index = VectorIndex.build(table(spark, sf_dir, "embeddings"), scratch_path(spark, "index"), "vec_id")
    return index.search(inputs.centroids(spark, sf_dir))


@query
def mart_summaries(spark, sf_dir):
    return _times_as_text(
        marts.newest_first(marts.mart_summaries(inputs.staging(spark, sf_dir)))
    )


@query
def report_enriched(spark, sf_dir):
    return _times_as_text(reports.report_enriched(inputs.enriched(spark, sf_dir)))


@query
def report_topics(spark, sf_dir):
    mart = marts.mart_by_topic(inputs.staging(spark, sf_dir))
    return reports.report_topics(mart).withColumn(
        "topic_avg_text_length", F.round("topic_avg_text_length", 6)
    )


@query
def report_bronze(spark, sf_dir):
    return _times_as_text(reports.report_bronze(inputs.raw_documents(spark, sf_dir)))


@query
def report_silver(spark, sf_dir):
    return _times_as_text(reports.report_silver(inputs.clean_documents(spark, sf_dir)))


@query
def preview(spark, sf_dir):
    return reports.preview(inputs.raw_documents(spark, sf_dir))


# --- scalar functions --------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", txt.clean_text("text").alias("text_clean")
    )


@query
def lower_trim(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", txt.lower_trim("text").alias("text")
    )


@query
def text_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", txt.text_length("text").alias("chars"))


@query
def stg_normalise(spark, sf_dir):
    return _times_as_text(inputs.staging(spark, sf_dir))


@query
def first_value_or_empty_(spark, sf_dir):
    long_words = F.filter(txt.words("text"), lambda w: F.length(w) >= 16)
    return table(spark, sf_dir, "documents").select(
        "doc_id", first_value_or_empty(long_words).alias("first_long_word")
    )


@query
def meta_fallback_(spark, sf_dir):
    """Authors under three keys by language; French ones are present but empty."""

    def key(lang):
        return (
            F.when(lang == "fr", "dc:creator")
            .when(lang == "de", "pdf:docinfo:creator")
            .when(lang == "es", "Author")
            .otherwise("Other")
        )

    values = F.when(F.col("lang") == "fr", F.array().cast("array<string>")).otherwise(
        F.array("source", "lang")
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        meta_fallback(
            F.create_map(key(F.col("lang")), values),
            ("dc:creator", "pdf:docinfo:creator", "Author"),
        ).alias("author"),
    )


@query
def truncate_text(spark, sf_dir):
    purposes = ("embed", "summary", "classify", "prompt", "chat_preview", "table_preview")
    return table(spark, sf_dir, "documents").select(
        "doc_id", *[txt.truncate_text("text", p).alias(p) for p in purposes]
    )


@query
def parse_json(spark, sf_dir):
    raw = inputs.messages(spark, sf_dir).select(F.encode("value", "UTF-8").alias("value"))
    return (
        raw.select(msg.parse_json("value").alias("data"))
        .select("data.*")
        .filter("text_content is not null")
    )


@query
def parse_reply(spark, sf_dir):
    """Each turn of a conversation as the reply of the three providers."""
    padded = F.concat(F.lit(" \n"), "text", F.lit("\n"))
    content = F.struct(F.struct(padded.alias("content")).alias("message"))
    part = F.struct(
        F.struct(F.array(F.struct(padded.alias("text"))).alias("parts")).alias("content")
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        msg.parse_reply(F.to_json(F.struct(padded.alias("response"))), "ollama").alias("first"),
        msg.parse_reply(F.to_json(F.struct(F.array(content).alias("choices"))), "openai").alias("second"),
        msg.parse_reply(F.to_json(F.struct(F.array(part).alias("candidates"))), "gemini").alias("third"),
    )


@query
def now_cols(spark, sf_dir):
    now = msg.now_or(None)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        (now >= F.lit("2025-01-01").cast("timestamp")).alias("stamped"),
        msg.ts_to_text(msg.whole_seconds(msg.now_or(inputs.fixed_time()))).alias("fixed"),
    )


@query
def ts_to_text(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", msg.ts_to_text("ts").alias("ts_text"))


@query
def keyword_context(spark, sf_dir):
    found = table(spark, sf_dir, "documents").withColumn(
        "position", txt.keyword_position("text", ["Of The", "de la", "der "])
    )
    return found.select(
        "doc_id", "position", txt.keyword_context("text", "position").alias("context")
    )


@query
def clean_loss_profile(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", txt.clean_text("text").alias("cleaned")
    )
    before, after = F.length("text"), F.length("cleaned")
    return docs.select(
        "doc_id",
        before.alias("chars_before"),
        after.alias("chars_after"),
        (before - after).alias("lost"),
        ((before - after) * 100.0 / F.nullif(before, F.lit(0))).cast("double").alias("lost_percent"),
        F.array_join(txt.removed_characters("text", "cleaned"), "").alias("removed"),
    )


@query
def lost_characters(spark, sf_dir):
    """Over the whole of the corpus."""
    docs = table(spark, sf_dir, "documents").withColumn("cleaned", txt.clean_text("text"))
    return cleaning.lost_characters(docs, "text", "cleaned")


@query
def embedding_dims(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", vec.embedding_dims("embedding").alias("dims")
    )


# --- vectors, features and models --------------------------------------------


@query
def cosine_score(spark, sf_dir):
    """Each vector against the mean of its label."""
    means = inputs.centroids(spark, sf_dir).select(
        F.col("question_id").alias("label"), F.col("embedding").alias("mean")
    )
    joined = table(spark, sf_dir, "embeddings").join(means, "label", "left")
    return joined.select(
        "vec_id", "label", (F.round(vec.cosine_score("embedding", "mean"), 6) + 0.0).alias("score")
    )


@query
def l2_normalise(spark, sf_dir):
    scaled = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: x.cast("double") * 3 + F.col("label")).alias("v"),
    )
    return scaled.select("vec_id", F.posexplode(vec.l2_normalise("v")).alias("pos", "x")).select(
        "vec_id", "pos", (F.round("x", 6) + 0.0).alias("x")
    )


@query
def tokenize(spark, sf_dir):
    tokens = features.tokenize(inputs.clean_documents(spark, sf_dir))
    return tokens.select("file_name", F.posexplode("words").alias("pos", "term"))


@query
def hashing_tf(spark, sf_dir):
    counted = features.hashing_tf(inputs.clean_documents(spark, sf_dir))
    return features.bucket_rows(counted, "file_name", "raw_features", "tf")


@query
def tf_idf(spark, sf_dir):
    weighted = features.tf_idf(inputs.clean_documents(spark, sf_dir))
    return features.bucket_rows(weighted, "file_name", "tfidf_features").withColumn(
        "weight", F.round("weight", 6)
    )


@query
def term_tf_idf(spark, sf_dir):
    weighted = features.term_tf_idf(inputs.clean_documents(spark, sf_dir), "file_name")
    return weighted.withColumn("tf_idf", F.round("tf_idf", 6) + 0.0)


@query
def embed_documents(spark, sf_dir):
    docs = inputs.build_embedded(spark, sf_dir)
    return (
        docs.select("file_name", F.posexplode("embedding").alias("bucket", "weight"))
        .filter("weight <> 0")
        .select("file_name", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight"))
    )


@query
def embed_query(spark, sf_dir):
    asked = features.embed_query(inputs.questions(spark, sf_dir))
    return (
        asked.select("question_id", F.posexplode("embedding").alias("bucket", "weight"))
        .filter("weight <> 0")
        .select("question_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight"))
    )


@query
def summarise_(spark, sf_dir):
    return inputs.plain_clean(spark, sf_dir).select(
        "doc_id", summarise("text_clean").alias("summary")
    )


@query
def classify_topic_(spark, sf_dir):
    return inputs.plain_clean(spark, sf_dir).select(
        "doc_id", classify_topic("text_clean", LEXICON).alias("topic")
    )


@query
def classify_by_prototype(spark, sf_dir):
    """Prototype of a label: its vector with the lowest id."""
    vectors = table(spark, sf_dir, "embeddings")
    prototypes = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return similarity.classify_by_prototype(vectors, prototypes, doc_key="vec_id")


@query
def encode_labels(spark, sf_dir):
    labels = ("user", "assistant")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", training.encode_labels(F.nullif("role", F.lit("system")), labels[::-1]).alias("label_id")
    )


def _quality_training(spark, sf_dir):
    return training_set(spark, sf_dir)


@query
def barrier_training(spark, sf_dir):
    """The split, whether held-out rows are told apart, and whether the number of workers matters."""
    train, test = training.hold_out(_quality_training(spark, sf_dir), "doc_id")
    sides = cut_lineage(train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test"))))
    train, test = sides.filter("side = 'train'"), sides.filter("side = 'test'")
    one, two = (barrier_training_.train_in_step(train, QUALITY, "doc_id", workers=n) for n in (1, 2))
    right = F.avg((F.col("predicted_topic") == F.col("topic")).cast("int"))
    most = test.groupBy("topic").count().agg(F.max("count") / F.sum("count")).first()[0]
    better = one.predict(test).agg(right).first()[0] >= most
    same = bool(abs(one.weights - two.weights).max() < 1e-9)
    counted = sides.groupBy("side", "topic").agg(F.count(F.lit(1)).alias("docs"))
    return counted.withColumn("at_least_majority", F.lit(better)).withColumn("same_weights", F.lit(same))


@query
def train_topic_model(spark, sf_dir):
    """Rows on either side of the split, and whether the held-out ones are told apart."""
    train, test = training.hold_out(_quality_training(spark, sf_dir), "doc_id")
    model = training.train_topic_model(train, QUALITY)
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    most = test.groupBy("topic").count().agg(F.max("count") / F.sum("count")).first()[0]
    better = training.accuracy(model, test, QUALITY) >= most
    counted = sides.groupBy("side", "topic").agg(F.count(F.lit(1)).alias("docs"))
    return counted.withColumn("at_least_majority", F.lit(better))


@query
def save_model(spark, sf_dir):
    """The stored model gives every row what the model in memory gives it."""
    data = _quality_training(spark, sf_dir)
    path = scratch_path(spark, "model")
    model = training.train_topic_model(data, QUALITY, rounds=3)
    training.save_model(model, path)
    scored = training.predict_topics(model, data, QUALITY).select(
        "doc_id", "topic", F.col("predicted_topic").alias("memory")
    )
    loaded = training.predict_topics(training.load_model(path), data, QUALITY)
    joined = scored.join(loaded.select("doc_id", F.col("predicted_topic").alias("stored")), "doc_id")
    return joined.select("doc_id", "topic", (F.col("memory") == F.col("stored")).alias("same"))


# --- extraction --------------------------------------------------------------


@query
def extract_documents_(spark, sf_dir):
    """Every page as an HTML file and every document as a text file."""
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_name"),
        F.encode("html", "UTF-8").alias("content"),
    )
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".TXT")).alias("file_name"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return _times_as_text(extract_documents(pages.unionByName(docs), now=inputs.fixed_time()))


@query
def extract_pages_(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("file_name"), "html")
    return extract_pages(pages, now=inputs.fixed_time()).select(
        "file_name", "title", "language", "text_content"
    )


@query
def extract_latin1(spark, sf_dir):
    """Files in ISO-8859-1 where the text allows it and the id is even, in UTF-8 elsewhere."""
    old = (F.col("doc_id") % 2 == 0) & ~F.col("text").rlike(r"[^\x00-\xff]")
    files = table(spark, sf_dir, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.when(old, F.encode(F.when(old, F.col("text")), "ISO-8859-1"))
        .otherwise(F.encode("text", "UTF-8"))
        .alias("content"),
    )
    return extract_documents(files, now=inputs.fixed_time()).select("file_name", "text_content")


# --- retrieval ---------------------------------------------------------------


def _hits(spark, sf_dir):
    return answers.retrieve(inputs.embedded(spark, sf_dir), inputs.questions(spark, sf_dir))


@query
def retrieve(spark, sf_dir):
    return _hits(spark, sf_dir).select("question_id", "file_name", "score", "rank")


def _prompts(spark, sf_dir):
    hits = answers.with_texts(_hits(spark, sf_dir), inputs.clean_documents(spark, sf_dir))
    return answers.build_prompt(hits, inputs.questions(spark, sf_dir))


@query
def build_prompt(spark, sf_dir):
    return _prompts(spark, sf_dir).select("question_id", "prompt")


def _first_source_client():
    """Stands in for a provider: answers with the name of the best hit."""

    def reply(prompt: str, temperature: float) -> str:
        name = prompt.split("\n[", 1)[1].split("]\n", 1)[0]
        return json.dumps({"response": f" {name}\n"})

    return reply


@query
def generate_answers(spark, sf_dir):
    """Each provider's shape of reply, and a provider that nobody knows."""
    shapes = {
        "ollama": lambda text: {"response": text},
        "openai": lambda text: {"choices": [{"message": {"content": text}}]},
        "gemini": lambda text: {"candidates": [{"content": {"parts": [{"text": text}]}}]},
    }

    def factory(shape):
        def client():
            first = _first_source_client()
            return lambda prompt, t: json.dumps(shape(json.loads(first(prompt, t))["response"]))

        return client

    clients = {name: factory(shape) for name, shape in shapes.items()}
    prompts = cut_lineage(_prompts(spark, sf_dir))
    answered = [
        answers.generate_answers(prompts, clients, name).select(
            F.lit(name).alias("provider"), "question_id", "answer"
        )
        for name in ("ollama", "OpenAI", "gemini", "unheard-of")
    ]
    return reduce(DataFrame.unionByName, answered)


# --- streaming ---------------------------------------------------------------


@query
def stream_classify_(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "classified"), scratch_path(spark, "checkpoint")
    raw = stream_source(spark, "text", path=_message_folder(spark, sf_dir))
    (
        stream_classify(raw, LEXICON, now=inputs.message_time())
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return _times_as_text(spark.read.parquet(out))


@query
def stream_run_(spark, sf_dir):
    from doclake.streaming.documents import STREAM_SCHEMA

    keyed = tables.KeyedTable(spark, scratch_path(spark, "live"), "file_name", STREAM_SCHEMA)
    raw = stream_source(
        spark, "text", {"maxFilesPerTrigger": "4"}, path=_message_folder(spark, sf_dir)
    )
    classified = stream_classify(raw, LEXICON, now=inputs.message_time())
    stream_run(classified, keyed, scratch_path(spark, "checkpoint"), None).awaitTermination()
    return _times_as_text(keyed.latest())


# --- layers ------------------------------------------------------------------


@query
def bronze(spark, sf_dir):
    """A folder for each document; the name below the root is the key."""
    folder = scratch_path(spark, "files")
    _write_files(table(spark, sf_dir, "documents").select("doc_id", "text"), folder, "doc_id")
    raw = layers.bronze(spark, folder, recursive=True, now=inputs.fixed_time())
    return _times_as_text(
        raw.withColumn("file_name", F.regexp_extract("file_name", "^(doc_id=[0-9]+)/[^/]+[.]txt$", 1))
    )


@query
def message_faults(spark, sf_dir):
    """Of each three messages one is cut off and one has no text."""
    number = F.get_json_object("value", "$.title").cast("long")
    raw = inputs.messages(spark, sf_dir).withColumn("number", number)
    broken = F.when(F.col("number") % 3 == 0, F.expr("left(value, length(value) - 1)")).when(
        F.col("number") % 3 == 1, F.to_json(F.struct(F.col("key").alias("file_name")))
    ).otherwise(F.col("value"))
    return documents_stream.message_faults(raw.select("number", broken.alias("value"))).select("number", "fault")


@query
def silver(spark, sf_dir):
    built = layers.silver(inputs.raw_documents(spark, sf_dir), now=inputs.fixed_time())
    nonzero = F.filter(vector_to_array("tfidf_features"), lambda v: v != 0)

    def weighed(values):
        """Every value at the weight of its place."""
        placed = F.transform(values, lambda v, i: v.cast("double") * (i + 1))
        return F.round(F.aggregate(placed, F.lit(0.0), lambda total, v: total + v), 3)

    return built.select(
        "file_name",
        "author",
        "title",
        "language",
        "num_pages",
        "text_clean",
        "text_length",
        F.size(nonzero).alias("tfidf_buckets"),
        vec.embedding_dims("embedding").alias("dims"),
        weighed(vector_to_array("tfidf_features")).alias("tfidf_values"),
        weighed("embedding").alias("embedding_values"),
    )


@query
def gold(spark, sf_dir):
    keyed = inputs.gold_table(spark)
    keyed.upsert(inputs.build_enriched(spark, sf_dir), 0, ["enriched_at"])
    return _times_as_text(keyed.latest())


@query
def marts_(spark, sf_dir):
    lake = inputs.fresh_lake(spark)
    lake.enriched().upsert(inputs.enriched(spark, sf_dir), 0, ["enriched_at"])
    return layers.run_marts(lake)


@query
def mart_rows(spark, sf_dir):
    """The mart that a run stores, row by row."""
    lake = inputs.fresh_lake(spark)
    lake.enriched().upsert(inputs.enriched(spark, sf_dir), "run", ["enriched_at"])
    layers.run_marts(lake)
    return _times_as_text(spark.table(lake.table("mart_documents_by_topic"))).withColumns(
        {c: F.round(c, 6) for c in ("topic_avg_text_length", "topic_avg_pages")}
    )


@query
def run_layers(spark, sf_dir):
    """Files through all layers; statistics of the mart, which has a row per document."""
    lake = inputs.fresh_lake(spark, _write_text_files(spark, sf_dir))
    layers.run_layers(lake)
    layers.run_marts(lake)
    mart = spark.table(lake.table("mart_documents_by_topic"))
    return mart.groupBy("topic", "topic_total_docs").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("text_length").alias("chars"),
        F.sum(F.length("summary")).alias("summary_chars"),
    )


@query
def ingest_tables_(spark, sf_dir):
    """Three of the given tables as CSV files, read, cleaned and stored."""
    folder, warehouse = scratch_path(spark, "csv"), scratch_path(spark, "warehouse")
    database = inputs.fresh_database("raw")
    stamps = {"orders": ("o_orderdate",), "lineitem": ("l_shipdate",), "customer": ()}
    for name in stamps:
        source = table(spark, sf_dir, name)
        _times_as_text(source).write.option("header", True).csv(f"{folder}/{name}.csv")
    schemas = {
        name: ", ".join(
            f"{f.name} {'string' if f.name in stamps[name] else f.dataType.simpleString()}"
            for f in table(spark, sf_dir, name).schema
        )
        for name in stamps
    }
    written = ingest_tables(
        spark, folder, warehouse, database, schemas, {n: (f"{n}.csv", c) for n, c in stamps.items()}
    )

    def facts(name, key, day, amount):
        return spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"),
            F.lit(written[name]).cast("bigint").alias("written"),
            F.min(key).alias("low_key"),
            F.max(key).alias("high_key"),
            (msg.ts_to_text(F.max(day)) if day else F.lit(None).cast("string")).alias("newest"),
            F.round(F.sum(F.col(amount).cast("decimal(38,2)")).cast("double"), 2).alias("amount"),
        )

    return (
        facts("orders", "o_orderkey", "o_orderdate", "o_totalprice")
        .unionByName(facts("lineitem", "l_orderkey", "l_shipdate", "l_extendedprice"))
        .unionByName(facts("customer", "c_custkey", None, "c_acctbal"))
    )


def registered() -> dict:
    """Queries by name; a trailing underscore only avoids a clash with an import."""
    return {name.rstrip("_"): function for name, function in QUERIES.items()}
