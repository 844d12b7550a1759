"""Whitening, spelling variants and mixing by source."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import re
from pyspark.sql import functions as F

from conftest import plan_of
from doclake.llm import common, mixing, queries, spelling, whitening

SF_DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, component string, n string, x string, white string, i string"


def spd(rng, values):
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return q @ np.diag(values) @ q.T


# ---- whitening


@pytest.mark.parametrize("d", [1, 2, 5, 30])
def test_inertia_counts(d):
    rng = np.random.default_rng(d)
    for _ in range(20):
        a = rng.standard_normal((d, d))
        a = a + a.T
        assert whitening.negatives(a) == (np.linalg.eigvalsh(a) < 0).sum()
    hollow = np.ones((d, d)) - np.eye(d)  # every pivot has two rows at first
    assert whitening.negatives(hollow) == (np.linalg.eigvalsh(hollow) < -1e-12).sum()


SPECTRA = {
    "falling": [100.0, 50, 20, 10, 5, 1, 0.5],
    "flat": list(np.linspace(1.0, 1.2, 40)),
    "equal": [3.0] * 12,
    "cluster": [10.0, 9, 8, 7.0000001, 7.0, 7.0, 1, 1],
    "few": [5.0, 2.0, 0, 0, 0, 0],
    "one": [4.0],
    "apart": [1e9, 1.0, 1e-3, 1e-4, 1e-5],
    "tiny": [3e-9, 2e-9, 1e-9, 5e-10, 1e-10],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_pairs(name):
    values = np.array(sorted(SPECTRA[name], reverse=True))
    matrix = spd(np.random.default_rng(3), values)
    found, vectors = whitening.leading(matrix)
    k = min(4, int((values > len(values) * np.finfo(float).eps * values.sum()).sum()))
    assert len(found) == k
    assert np.allclose(found, values[:k], rtol=1e-6, atol=1e-13 * values[0])
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * values[0]


def test_no_variance_has_no_component():
    assert len(whitening.leading(np.zeros((3, 3)))[0]) == 0
    assert len(whitening.leading(np.zeros((0, 0)))[0]) == 0


def expected_rows(rows):
    """vec_id: (n, deviation, explained, matrix of components) by plain numpy, a width at a time."""
    widths = defaultdict(list)
    for key, v in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            widths[len(v)].append((key, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int)))
    out = []
    for width, own in widths.items():
        if not width:
            continue
        distinct = np.unique(np.array([x for _, x in own]), axis=0)
        n, sums = len(distinct), distinct.sum(axis=0)
        v = np.cov(distinct.T.reshape(width, -1), bias=True).reshape(width, width)
        values, vectors = np.linalg.eigh(v)
        order = [i for i in np.argsort(-values)[:4] if values[i] > 1e-12 * np.trace(v)]
        for key, x in own:
            deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
            white = (x - sums / n) @ vectors[:, order] / np.sqrt(values[order])
            out += [(key, k + 1, n, deviation, abs(white[k]), values[i] / np.trace(v)) for k, i in enumerate(order)]
    return sorted(out, key=str)


def check_whitening(found, rows):
    got = sorted(
        [(r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in found],
        key=str,
    )
    wanted = expected_rows(rows)
    key = lambda r: (str(r[0]), r[1], r[2], r[3], round(r[4], 6))
    got.sort(key=key), wanted.sort(key=key)
    assert [r[:4] for r in got] == [r[:4] for r in wanted]
    assert np.allclose([r[4] for r in got], [r[4] for r in wanted], rtol=1e-7, atol=1e-7)
    assert np.allclose([r[5] for r in got], [r[5] for r in wanted], rtol=1e-9)
    assert all(r["identity_error"] < 1e-9 for r in found)


def test_whitening_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(queries.op11_contour_whitening(spark, SF_DIR).collect(), rows)


def test_whitening_of_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, s) for s in (3, 2, 1, 0.5, 0.2)]) for i in range(60)]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (None, rows[2][1])] + [(1000 + i, rows[3][1]) for i in range(40)]
    rows += [(70, None), (71, [1.0, None, 1.0, 1.0, 1.0]), (72, [float("nan")] * 5), (73, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    rows += [(80 + i, [float(i % 3), 1.0]) for i in range(7)] + [(90, [])]  # another width, of one component
    table = [(k, v, "a", "b", "c", "d", "e") for k, v in rows]
    found = whitening.whiten(spark.createDataFrame(table, VECTORS).repartition(5)).collect()
    check_whitening(found, rows)


def test_whitening_of_no_or_one_vector(spark):
    for rows in ([], [(1, [1.0, 2.0])] * 3, [(1, None)]):
        table = [(k, v, "a", "b", "c", "d", "e") for k, v in rows]
        assert whitening.whiten(spark.createDataFrame(table, VECTORS)).collect() == []


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(10**9, [0, 0], np.ones(1), np.ones((2, 1)), 1.0)
    assert model.deviation(np.array([[1, 2], [10, 0], [0, 0]])) == [5 * 10**18, None, 0]


# ---- spelling variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts):
    out, form = {}, {}
    for w, n in counts.items():
        found = [v for v in counts if near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (n, len(found))
    rows = set()
    for w, (n, count) in out.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, count, counts.get(form[w])))
    return rows


def as_rows(df):
    found = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("alphabet, longest", [("ab", 6), ("abé", 4), ("a😀z", 3), ("ab", 12)])
def test_variants_equal_brute_force(spark, alphabet, longest):
    rng = random.Random(longest)
    counts = {}
    for _ in range(150):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest)))
        counts[word] = rng.choice([3, 3, 4, 6, 7, 20, 50])
    found = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert as_rows(found) == brute_groups(counts)


def test_variants_of_long_words(spark):
    long = "".join(random.Random(1).choice("abc") for _ in range(5000))
    counts = {long: 9, long[:2500] + long[2501:]: 3, "x" + long: 4, long[:-1] + "z": 2, long[::-1]: 5, long[:100]: 3}
    found = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert as_rows(found) == brute_groups(counts)


def test_chains_of_forms_end_at_the_last(spark):
    counts = {"w" * 5 + "x" * i + "y" * (12 - i): 3 * 2**i for i in range(13)}
    rows = as_rows(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert rows == brute_groups(counts) and {r[2] for r in rows} == {"wwwww" + "x" * 12}


def test_repeated_null_and_empty_words(spark):
    data = [("abc", 2), ("abc", 3), (None, 9), ("", 9), ("abd", 10)]
    rows = as_rows(spelling.group_variants(spark.createDataFrame(data, "word string, n long")))
    assert rows == brute_groups({"abc": 5, "abd": 10})
    none = spelling.group_variants(spark.createDataFrame([], "word string, n long"))
    assert none.collect() == []


def plain_counts(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_no_table_is_sent_to_every_task(spark, monkeypatch):
    """Prefixes and states are many times the words they come from; Spark sizes them by those."""
    plans = []

    def seen(df, name):
        plans.append(plan_of(df))
        return common.stored(df, name)

    monkeypatch.setattr(spelling, "stored", seen)
    counts = {"letter": 9, "lettre": 2, "leter": 3, "ladder": 5, "latter": 7}
    found = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    plans.append(plan_of(found))
    assert sum("SortMergeJoin" in p for p in plans) > 4 and not any("Broadcast" in p for p in plans)


def test_words_with_typos(spark):
    rng = random.Random(2)
    letters = "abcdeXYZÀÿ÷×ßĀ1 _¿Ā漢"
    rows = [(i, "".join(rng.choice(letters) for _ in range(3000))) for i in range(40)]
    rows += [(i, "Straße straße WÖRTER Wörter wörter wÖrter " * 3) for i in range(100, 300)]
    rows += [(None, "Straße straße"), (7, None), (8, ""), rows[0], (9, "verylongword" * 10_000)] + [(10, "again " * 7)] * 2
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, word string, n string")
    assert {tuple(r) for r in spelling.count_words(table).collect()} == set(plain_counts(rows).items())


def test_a_typo_that_is_drawn_itself_loses_one_letter_only(spark):
    def drawn(key, word):
        return zlib.crc32(f"{key}:{word}".encode()) % 97 == 0

    def typo(key, word):
        at = zlib.crc32(f"{key}:{word}".encode()) % len(word)
        return word[:at] + word[at + 1 :]

    long = ((k, "abcdefgh" + c + d) for k in range(3000) for c in "xyzé" for d in "uvw")
    key, word = next((k, w) for k, w in long if drawn(k, w) and drawn(k, typo(k, w)))
    short = typo(key, word)
    rows = [(key, f"{word} {short} " * 3)]
    expected = {short: 3, typo(key, short): 3}
    assert plain_counts(rows) == expected
    for text in (rows[0][1], f"{short} {word} " * 3):
        counted = spelling.text_words(key, text)
        assert {w.decode(): n for w, n in counted.items()} == expected
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in spelling.count_words(table).collect()} == set(expected.items())


def test_variants_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    counts = plain_counts(rows)
    shapes = defaultdict(set)  # neighbours share a text with one letter left out
    for w in counts:
        for shape in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            shapes[shape].add(w)
    pairs = {(a, b) for group in shapes.values() for a in group for b in group if near(a, b)}
    found = as_rows(queries.op12_trie_variants(spark, SF_DIR))
    assert {(r[0], r[3]) for r in found} == set(counts.items())
    degree = Counter(a for a, _ in pairs)
    assert {r[0]: r[4] for r in found} == {w: degree[w] for w in counts}
    best = {}
    for a, b in pairs:
        best[a] = min(best.get(a, b), b, key=lambda v: (-counts[v], v))
    form = {a: b for a, b in best.items() if counts[b] >= 2 * counts[a]}
    for word, own, root, _, _, form_n in found:
        last = word
        while last in form:
            last = form[last]
        assert (own, root, form_n) == (form.get(word), last, counts.get(form.get(word)))


# ---- mixing


def brute_targets(sizes):
    order = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    words, full = sum(sizes.values()), set()
    while True:
        left = words - sum(3 * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        share = {s: Fraction(weight[s] * left, total) for s in order if s not in full} if total else {}
        over = {s for s, x in share.items() if x > 3 * sizes[s]}
        if not over:
            return {s: float(3 * sizes[s] if s in full else share[s]) for s in order}
        full |= over


SOURCES = [
    {"a": 100, "b": 100, "c": 100, None: 100},
    {"a": 5, "b": 5000, "c": 30, "d": 1000, None: 1},
    {"a": 0, "b": 7, "ä": 3, "z": 2, "": 9},
    {"a": 0, None: 0},
    {"x": 50},
    {f"s{i:03d}": (i * 37) % 91 for i in range(200)},
    {"big": 10**6} | {f"s{i}": 1 for i in range(40)},
    {},
]


@pytest.mark.parametrize("sizes", SOURCES)
def test_targets(spark, sizes):
    rows = [(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()]
    found = mixing.source_targets(spark.createDataFrame(rows, "source string, size long").repartition(3)).collect()
    assert {r["source"]: r["source_size"] for r in found} == sizes
    wanted = brute_targets(sizes)
    assert {r["source"]: r["target"] for r in found} == pytest.approx(wanted, rel=1e-14)


def mixed_documents(n=4000):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 8 + ["a", "b", "c", None, "rare"] if i % 50 else ["tiny"])
        rows.append((i, "w " * rng.randint(1, 40), source))
    return rows + [(5, "twice given", "a"), (5, "twice given", "a"), (None, "no key", "a"), (None, None, "b"), (6, "", "c")]


def test_mix(spark):
    rows = mixed_documents()
    table = [(*r, "x", "y", "z", "q") for r in rows]
    docs = spark.createDataFrame(
        table, "doc_id long, text string, source string, size string, taken string, _target string, weight string"
    )
    mix = mixing.mix_sources(docs)
    found = mix.collect()
    assert len(found) == len(rows) and {"_target", "weight"} <= set(mix.columns)
    sizes, taken, target = defaultdict(int), Counter(), {}
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    wanted = brute_targets(sizes)
    for r in found:
        assert r["size"] == len((r["text"] or "").split()) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3
        rate = wanted[r["source"]] / sizes[r["source"]]
        assert r["copies"] in (int(rate), int(rate) + (rate > int(rate)))
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(wanted)
    for source, words in wanted.items():
        largest = 40
        assert abs(taken[source] - words) <= 4 * (largest * words / 4) ** 0.5 + largest, source
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(found, key=str) == sorted(again, key=str)
    copies = mixing.emitted(mix)
    assert copies.count() == sum(r["copies"] for r in found)
    assert copies.agg(F.max("copy")).first()[0] == 3


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(docs).collect() == []


def test_words_are_cut_at_ascii_space(values):
    found = values(lambda x: mixing.word_count(x), ["a b\tc\x0bd\x0ce\rf\ng", None, "", " \n", "a\xa0b\x85c\x1c d"])
    assert found == [7, 0, 0, 0, 2]
