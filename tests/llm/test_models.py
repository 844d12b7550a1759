"""Language spans, fertility and the quality classifier."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from doclake.llm import fertility, language, quality, queries
from samples import clashing, prose

SF_DIR = "/root/testdata/sf0.01"


def test_language_of_held_out_texts(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op2_language_spans(spark, SF_DIR).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) > 0.97 * len(held)


def test_mixed_text_falls_into_spans(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit(docs)
    texts = {r["lang"]: r["text"].split()[:60] for r in docs.filter("n_chars > 1500").orderBy("doc_id").collect()}
    mixed = texts["de"] + texts["fr"]
    rows = [(1, " ".join(mixed)), (2, None), (3, "123 -- !"), (4, ""), (5, "Привет мир"), (None, "der"), (None, "der")]
    got = {}
    for r in language.identify(clashing(spark, rows), model, spans=True).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [s["lang"] for s in got[1][0]["lang_spans"]] == ["de", "fr"]
    assert abs(got[1][0]["lang_spans"][1]["word"] - 60) <= 3
    assert [got[i][0]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3 and got[2][0]["score"] == 0
    assert got[5][0]["lang_pred"] in model.languages and len(got[None]) == 2
    none = language.fit(docs.limit(0))
    assert [r["lang_pred"] for r in language.identify(docs.limit(2), none).collect()] == ["und"] * 2


def test_viterbi_matches_the_best_of_all_paths():
    import itertools

    rng = np.random.default_rng(4)
    scores = rng.normal(size=(11, 3)) * 3
    starts = np.array([0, 5, 6])
    got = language.viterbi(scores, starts, 2.0)
    for begin, end in ((0, 5), (5, 6), (6, 11)):
        def worth(path):
            return sum(scores[begin + i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(3), repeat=end - begin), key=worth)
        assert tuple(got[begin:end]) == best


def test_scripts_narrow_the_languages(spark):
    rows = [(i, "мир война и дом " * 5, "ru") for i in range(5)] + [(10 + i, "house and war of the world " * 5, "en") for i in range(5)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    scores, letters = model.word_scores(["дом", "house", "漢字", "12"])
    assert scores[0].argmax() == model.languages.index("ru") and scores[0].min() == -100
    assert not scores[2].any() and not scores[3].any() and letters.tolist() == [3, 5, 2, 0]


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered))


def test_base_rules_and_bands(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 40)) for i in range(60)]
    odd = [(100, None), (101, ""), (102, "a b c d e a b c d e a b c d e"), (103, "x # *\nx # *\n \n \n|<>"), (104, "a b c d e f " * 40),
           (105, " ".join("漢" * rng.randint(30, 60) for _ in range(40))), (None, "q"), (None, "q")]
    table = clashing(spark, rows + odd)
    got = {}
    for r in fertility.quality_rules(table).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, text in rows + odd[:6]:
        r = got[i][0]
        expected = plain_counts(text)
        assert tuple(r[c] for c in fertility.BASE) == expected
        assert r["base_failed"] == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
    assert all(got[i][0]["kept"] for i, _ in rows) and len(got[None]) == 2
    assert not got[100][0]["kept"] and not got[104][0]["kept"]
    assert got[105][0]["band_missed"] is not None and not got[105][0]["kept"]
    assert fertility.quality_rules(table.limit(0)).collect() == []


def test_short_texts_and_small_groups_are_judged(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 40), "en") for i in range(40)] + [(100 + i, prose(rng, 3), "en") for i in range(20)]
    bytes_only = " ".join("".join(chr(rng.randrange(0x13A0, 0x13F0)) for _ in range(3)) for _ in range(12))
    rows += [(200, bytes_only, "en"), (201, bytes_only, "chr"), (202, prose(rng, 3), "la")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in fertility.quality_rules(docs).collect()}
    assert sorted(i for i, k in kept.items() if not k) == [200, 201]


def test_base_counts_of_the_given_texts(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op7_tokeniser_fertility(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in fertility.BASE) == plain_counts(texts[r["doc_id"]])


def test_quality_of_held_out_texts(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = queries.op8_naive_bayes_svm(spark, SF_DIR).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert len(held) > 40 and right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(60)]
    labels = np.array([int(3 in r or 7 in r) for r in rows])
    ratio = quality.log_count_ratio(rows, labels, 6)
    w, b = quality.dual_coordinate_descent(rows, ratio, labels, 1.0, 500)
    bound = 1.0 / (2 * (np.bincount(labels) / len(labels))[labels])

    def primal(w, b):
        m = np.array([w[r] @ (ratio[r] / np.sqrt(len(r))) + b for r in rows]) * np.where(labels == 1, 1, -1)
        return 0.5 * (w @ w + b * b) + (bound * np.maximum(0, 1 - m)).sum()

    best = primal(w, b)
    for _ in range(200):  # no step in any direction is better
        assert primal(w + rng.normal(size=len(w)) * 0.02, b + rng.normal() * 0.02) >= best - 1e-2


def test_classifier_of_odd_rows(spark):
    docs = clashing(spark, [(i, "clean words here " + str(i)) for i in range(20)] + [(50, None), (51, ""), (None, "x"), (None, "x")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, quality int")
    for given in (labels, labels.limit(0), labels.filter("quality = 1")):
        scored = quality.score(docs, quality.fit(docs, given)).collect()
        assert len(scored) == 24 and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.score(docs.limit(0), quality.fit(docs, labels)).collect() == []
