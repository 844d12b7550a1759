import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from doclake.operators import quality
from doclake.operators.cleaning import empty_text_rows, filter_not_null, filter_summary_length
from doclake.plans import marts, reports
from doclake.plans.layers import GOLD_SCHEMA


@pytest.fixture
def enriched(spark):
    def row(name, title, author, pages, length, topic, summary):
        return (name, "text/plain", title, author, " pt ", pages, length, topic, summary, None, None, None)

    return spark.createDataFrame(
        [
            row("a", "  ", None, "", 10, " t1 ", "s" * 20),
            row("b", "B", " Ana ", "x", 20, "t1", "s" * 21),
            row("c", "C", "", " 12 ", 30, "t2", "ã" * 11),
            row("d", "D", "Eva", "4", 40, None, None),
            row(None, "E", "Eva", "4", 40, "t2", "lost"),
        ],
        GOLD_SCHEMA,
    )


def test_staging(enriched):
    rows = {r["file_name"]: r for r in marts.stg_normalise(enriched).collect()}
    assert set(rows) == {"a", "b", "c", "d"}
    assert [rows[k]["document_title"] for k in "abcd"] == ["a", "B", "C", "D"]
    assert [rows[k]["document_author"] for k in "abcd"] == ["Desconhecido", "Ana", "Desconhecido", "Eva"]
    assert [rows[k]["num_pages"] for k in "abcd"] == [None, None, 12, 4]
    assert rows["a"]["topic"] == "t1" and rows["a"]["language"] == "pt"


def test_mart_keeps_documents_without_topic(enriched):
    rows = {r["file_name"]: r for r in marts.mart_by_topic(marts.stg_normalise(enriched)).collect()}
    assert (rows["a"]["topic_total_docs"], rows["a"]["topic_avg_text_length"], rows["a"]["topic_avg_pages"]) == (2, 15.0, 1.0)
    assert rows["c"]["topic_avg_pages"] == 12.0
    assert rows["d"]["topic_total_docs"] is None and rows["d"]["topic_avg_pages"] is None


def test_small_statistics_are_broadcast_at_run_time(enriched):
    mart = marts.mart_by_topic(marts.stg_normalise(enriched))
    assert mart.count() == enriched.filter("file_name is not null").count()
    mart.collect()
    assert "BroadcastHashJoin" in plan_of(mart)


def test_summary_length_counts_bytes(enriched):
    kept = filter_summary_length(enriched).select("file_name").collect()
    assert sorted(r[0] for r in kept) == ["b", "c"]


def test_not_null_keeps_empty_strings(spark):
    df = spark.createDataFrame([("", "a"), (None, "b"), ("x", None)], "t string, u string")
    assert filter_not_null(df, "t").count() == 2
    assert filter_not_null(df, "t", "u").count() == 1
    assert empty_text_rows(df, "t").count() == 2


def test_rules(enriched):
    staging = marts.stg_normalise(enriched).unionByName(marts.stg_normalise(enriched).filter("file_name = 'a'"))
    failures = {
        (r["model"], r["rule"], r["column_name"]): r["failures"]
        for r in quality.check_models({"stg_documents_enriched": staging}).collect()
    }
    assert failures == {
        ("stg_documents_enriched", "not_null", "file_name"): 0,
        ("stg_documents_enriched", "not_null", "topic"): 1,
        ("stg_documents_enriched", "unique", "file_name"): 1,
    }


def test_preview_takes_the_first_ten(spark):
    df = spark.range(30).select(
        F.format_string("%02d", "id").alias("file_name"),
        F.lit("t").alias("content_type"),
        F.lit("x" * 500).alias("text_content"),
    )
    got = reports.preview(df)
    assert "TakeOrderedAndProject" in plan_of(got)
    rows = got.collect()
    assert [r["file_name"] for r in rows] == [f"{i:02d}" for i in range(10)]
    assert {(r["text_len"], len(r["text_preview"])) for r in rows} == {(500, 200)}


def test_rows_of_one_run_spread_over_all_sort_tasks(spark):
    from doclake.plans import marts, reports

    run = spark.range(0, 40000, 1, 4).select(
        F.col("id").cast("string").alias("file_name"),
        F.lit("t").alias("topic"),
        F.lit("s").alias("summary"),
        F.lit("2025-01-01 00:00:00").cast("timestamp").alias("enriched_at"),
        F.lit(40000).alias("topic_total_docs"),
        F.lit(1.0).alias("topic_avg_text_length"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for ordered in (reports.report_enriched(run), reports.report_topics(run), marts.newest_first(run)):
            sizes = [len(p) for p in ordered.rdd.glom().collect()]
            assert max(sizes) < 0.5 * sum(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_texts_are_dealt_by_their_bytes(spark):
    from pyspark.sql import functions as F

    from doclake.plans.layers import dealt_texts

    rows = spark.range(0, 200, 1, 1).select(
        F.col("id").cast("string").alias("file_name"), F.repeat(F.lit("é "), 500).alias("text_clean")
    ).withColumn("text_length", F.length("text_clean"))
    dealt = dealt_texts(rows, task_bytes=5000)
    assert dealt.rdd.getNumPartitions() == 60 and rows.rdd.getNumPartitions() == 1
    assert sorted(dealt.collect()) == sorted(rows.collect())
    assert dealt_texts(rows).rdd.getNumPartitions() == 1
    assert dealt_texts(rows.limit(0)).count() == 0


def test_term_weights_of_frequent_and_other_terms(spark, monkeypatch):
    import math
    from collections import Counter

    from doclake.operators import features

    monkeypatch.setattr(features, "COMMON", 3)
    rows = [("a", "x y x"), ("b", "x z"), ("b", "z q"), (None, "x y"), (None, "x"), ("c", None), ("d", "x")]
    data = spark.createDataFrame(rows, "file_name string, text_clean string")
    counts = Counter((k, w) for k, t in rows for w in (t.split() if t else ()))
    terms = Counter(w for _, w in counts)
    weighed = features.term_tf_idf(data, "file_name")
    found = {(r[0], r[1]): (r[2], r[3], round(r[4], 9)) for r in weighed.collect()}
    assert found == {
        (k, w): (n, terms[w], round(n * math.log((len(rows) + 1) / (terms[w] + 1)), 9)) for (k, w), n in counts.items()
    }
    plan = weighed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2  # frequent terms aren't shuffled
