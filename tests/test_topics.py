import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from doclake.functions import topics


def brute_summary(text, sentences=2):
    parts = re.split(r"(?<=[.!?])\s+", text)
    terms = [set(re.findall(r"[^\W_]+", p.lower())) for p in parts]
    used = Counter(t for own in terms for t in own)
    score = [sum(used[t] > 1 for t in own) for own in terms]
    best = sorted(range(len(parts)), key=lambda i: (-score[i], i))[:sentences]
    return " ".join(parts[i] for i in sorted(best))


TEXTS = [
    "the cat sat on the mat. a dog ran. the cat ate the dog! nothing else here? cat and dog sat.",
    "one sentence only, without an end",
    "a. b. c. d.",
    "x y. y z. z x. x y z. q",
    ". . .",
    "same words here. same words here. same words here.",
]


def test_summary_equals_brute_force(values):
    assert values(topics.extractive_summary, TEXTS) == [brute_summary(t) for t in TEXTS]


def test_summary_of_documents_equals_brute_force(spark, values):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.collect()]
    texts = [re.sub(r"\s+", " ", t).strip() for t in texts]
    expected = [brute_summary(t) for t in texts]
    assert values(topics.extractive_summary, texts) == expected


def test_summary_rules(values):
    assert values(topics.summarise, [None, "", "x" * 99]) == ["", "", "x" * 99]


def test_topic_rules(values):
    lexicon = {"first": ["alpha"], "second": ["beta", "gamma"]}
    topic = lambda c: topics.classify_topic(c, lexicon)
    texts = [None, "", "no hit", "alpha beta", "beta, gamma alpha", "ALPHA alphabet"]
    assert values(topic, texts) == ["desconhecido", "desconhecido", "first", "first", "second", "first"]


def test_topics_and_summaries_need_no_shuffle(spark):
    df = spark.createDataFrame([("x",)], "t string")
    plan = plan_of(df.select(topics.summarise("t"), topics.classify_topic("t")))
    assert "Exchange" not in plan and "Python" not in plan


def test_default_lexicon_covers_the_topics():
    from doclake.constants import TOPICS

    assert tuple(topics.DEFAULT_LEXICON) == TOPICS
