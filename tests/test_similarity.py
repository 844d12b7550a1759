import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from doclake.functions import vectors as vec
from doclake.operators import similarity


def brute(docs, asked, k):
    def cosine(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return round(dot / (size + 1e-9), 6) + 0.0

    found = set()
    for q, theirs in asked:
        ranked = sorted((-cosine(v, theirs), d) for d, v in docs)[:k]
        found |= {(q, d, -s + 0.0, r) for r, (s, d) in enumerate(ranked, 1)}
    return found


@pytest.fixture(scope="module")
def data(spark):
    pick = random.Random(1)
    vector = lambda: [float(pick.randint(-3, 3)) for _ in range(6)]
    # A third of the documents are copies of one vector, so scores tie.
    docs = [(f"d{i:03}", [1.0, 0.0, 0.0, 0.0, 0.0, 2.0] if i % 3 == 0 else vector()) for i in range(120)]
    docs.append(("zero", [0.0] * 6))
    asked = [(i, vector()) for i in range(25)] + [(99, [1.0, 0.0, 0.0, 0.0, 0.0, 2.0])]
    schema = "embedding array<double>"
    return (
        docs,
        asked,
        spark.createDataFrame(docs + [("none", None)], f"file_name string, {schema}").repartition(3),
        spark.createDataFrame(asked, f"question_id int, {schema}"),
    )


@pytest.mark.parametrize("blocks", [False, True])
def test_topk_equals_brute_force(data, monkeypatch, blocks):
    docs, asked, df, questions = data
    if blocks:
        monkeypatch.setattr(similarity, "BLOCK_BYTES", 1000)
    for k in (1, 3, 7):
        got = similarity.topk_similar(df, questions, k)
        rows = {(r["question_id"], r["file_name"], r["score"], r["rank"]) for r in got.collect()}
        assert rows == brute(docs, asked, k)


@pytest.mark.parametrize("blocks", [False, True])
def test_all_scores(data, monkeypatch, blocks):
    docs, asked, df, questions = data
    if blocks:
        monkeypatch.setattr(similarity, "BLOCK_BYTES", 1000)
    rows = similarity.score_documents(df, questions).collect()
    assert len(rows) == len(docs) * len(asked)
    expected = {(q, d): s for q, d, s, _ in brute(docs, asked, len(docs))}
    assert {(r["question_id"], r["file_name"]): r["score"] for r in rows} == expected


@pytest.mark.parametrize("blocks", [False, True])
def test_prototype(data, monkeypatch, blocks):
    docs, asked, df, questions = data
    if blocks:
        monkeypatch.setattr(similarity, "BLOCK_BYTES", 1000)
    got = similarity.classify_by_prototype(df, questions, label_key="question_id").collect()
    best = {d: (q, s) for d, q, s, r in brute(asked, docs, 1)}
    assert {r["file_name"]: (r["question_id"], r["score"]) for r in got} == best


def test_only_local_winners_are_shuffled(data):
    _, _, df, questions = data
    plan = plan_of(similarity.topk_similar(df, questions, 3))
    assert "WindowGroupLimit" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_vectors_that_are_not_finite_hide_no_hits(spark, data):
    docs, asked, df, questions = data
    odd = [(f"x{i}", [float("nan") if i % 2 else float("inf")] + [1.0] * 5) for i in range(5)]
    more = df.unionByName(spark.createDataFrame(odd, df.schema))
    got = similarity.topk_similar(more.coalesce(1), questions, 3).collect()
    assert {(r["question_id"], r["file_name"], r["score"], r["rank"]) for r in got} == brute(docs, asked, 3)
    assert len(similarity.classify_by_prototype(more, questions, label_key="question_id").collect()) == len(docs)
    few = similarity.score_documents(more, questions, least_score=0.9).collect()
    assert few and all(r["score"] >= 0.9 for r in few)


def test_mixed_widths_are_an_error(spark, data):
    _, _, _, questions = data
    odd = spark.createDataFrame([("a", [1.0, 2.0])], "file_name string, embedding array<double>")
    with pytest.raises(Exception, match="2 dimensions meet questions of 6"):
        similarity.topk_similar(odd, questions).collect()
    with pytest.raises(Exception, match="different widths"):
        odd.select(vec.cosine_score("embedding", F.array(F.lit(1.0)))).collect()
    mixed = questions.unionByName(odd.select(F.lit(500).alias("question_id"), "embedding"))
    with pytest.raises(ValueError, match="2 to 6 dimensions"):
        similarity.topk_similar(odd, mixed)


def test_vector_functions(spark):
    df = spark.createDataFrame(
        [([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0])],
        "a array<float>, b array<float>",
    )
    rows = df.select(
        F.round(vec.cosine_score("a", "b"), 6), vec.l2_normalise("a"), vec.embedding_dims("a")
    ).collect()
    assert [tuple(r) for r in rows] == [
        (1.0, [0.6, 0.8], 2),
        (0.0, [0.0, 0.0], 2),
        (0.0, [1.0, 0.0], 2),
    ]
