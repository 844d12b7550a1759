import math
import random

import pytest
from pyspark.sql import functions as F

from doclake.operators.answers import retrieve
from doclake.operators.similarity import topk_similar
from doclake.operators.vector_index import VectorIndex
from doclake.session import scratch_path

VECTORS = "file_name string, embedding array<double>"
QUESTIONS = "question_id long, embedding array<double>"


def clustered(n, dims=12, groups=10, seed=1, spread=0.05):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    return [[x + rng.gauss(0, spread) for x in middles[i % groups]] for i in range(n)]


def frames(spark, vectors, questions):
    docs = spark.createDataFrame([(f"d{i:05d}", v) for i, v in enumerate(vectors)], VECTORS).repartition(4)
    return docs, spark.createDataFrame(list(enumerate(questions)), QUESTIONS)


def same(found, expected):
    order = ["question_id", "rank"]
    columns = ["question_id", "rank", "file_name", "score"]
    assert [tuple(r) for r in found.select(columns).orderBy(order).collect()] == [
        tuple(r) for r in expected.select(columns).orderBy(order).collect()
    ]


@pytest.fixture(scope="module")
def index(spark):
    vectors = clustered(2000)
    docs, _ = frames(spark, vectors, [])
    return docs, VectorIndex.build(docs, scratch_path(spark, "index"))


@pytest.mark.parametrize("k", [1, 3, 50])
def test_search_equals_the_full_scan_and_reads_less(spark, index, k):
    docs, built = index
    questions = clustered(40, seed=1, spread=0.2) + clustered(5, seed=9)
    questions += [[0.0] * 12, [1e-6] * 12, [float("nan")] * 12, [-x for x in clustered(1)[0]]]
    _, asked = frames(spark, [], questions)
    same(built.search(asked, k), topk_similar(docs, asked, k))
    assert built.share() < (0.6 if k < 50 else 1.0)


def test_odd_vectors_are_found_as_in_the_full_scan(spark):
    vectors = clustered(300, dims=4, groups=3, spread=0.5)
    vectors += [[0.0] * 4, [1e-9, 0.0, 0.0, 0.0], [0.01] * 4, [math.inf, 0.0, 0.0, 0.0], [math.nan] * 4, None]
    vectors += [vectors[0]] * 20 + [[1e8, 1.0, 0.0, 0.0]]
    docs, asked = frames(spark, vectors, [vectors[0], [-1.0, -1.0, -1.0, -1.0], [0.0, 0.0, 1e-5, 0.0], vectors[7]])
    built = VectorIndex.build(docs, scratch_path(spark, "index"))
    for k in (2, 30, 1000):
        same(built.search(asked, k), topk_similar(docs, asked, k))


def test_small_and_empty_tables(spark):
    docs, asked = frames(spark, [[1.0, 2.0], [2.0, 1.0]], [[1.0, 1.0]])
    same(VectorIndex.build(docs, scratch_path(spark, "index")).search(asked), topk_similar(docs, asked))
    same(VectorIndex.build(docs, scratch_path(spark, "index")).search(asked.limit(0)), topk_similar(docs, asked.limit(0)))
    none = docs.limit(0)
    assert VectorIndex.build(none, scratch_path(spark, "index")).search(asked).collect() == []


def test_widths_must_agree(spark):
    docs, _ = frames(spark, [[1.0, 2.0], [2.0]], [])
    with pytest.raises(ValueError):
        VectorIndex.build(docs, scratch_path(spark, "index"))


def test_cells_that_no_question_reaches_are_not_read(spark, index):
    _, built = index
    plan_rows = built._vectors_at(spark, built.path).filter(F.col("cell").isin([0, 1]))
    files = plan_rows.inputFiles()
    every = built._vectors_at(spark, built.path).inputFiles()
    read = plan_rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in read and len(every) >= 3 and files


def test_retrieve_reads_an_index(spark):
    docs, _ = frames(spark, clustered(50, dims=768), [])
    asked = spark.createDataFrame([(1, "some words"), (2, "others")], "question_id long, question string")
    built = VectorIndex.build(docs, scratch_path(spark, "index"))
    same(retrieve(built, asked), retrieve(docs, asked))
