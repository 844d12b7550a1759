"""n-gram join, repeated passages and components against brute force."""

import itertools
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from doclake.llm import common, ngram_join, passages
from doclake.llm.common import components, lower_words, near_keys, text_shingles
from samples import clashing, documents, prose, sentence


def shingle_sets(rows, width=4):
    out = {}
    for i, text in rows:
        words = lower_words(text)
        if len(words) < width:
            out[i] = {tuple(words)} if words else set()
        else:
            out[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
    return out


def groups(sets, percent=85):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def family(seed, n, words, edits):
    """Near copies of one text, and of one another, about as far apart as links reach."""
    rng = random.Random(seed)
    base = prose(rng, 40).split()[:words]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = sentence(rng, 1)
        if rng.random() < 0.3:
            own = own[: rng.randint(max(1, len(own) - 3), len(own))]
        out.append(" ".join(own))
    return out


def test_link_groups_match_brute_force(spark):
    rows = documents(4, 12)[:-1]
    texts = [t for _, t in rows]
    for seed in range(3):
        texts += family(seed, 40, 60, 3) + family(10 + seed, 15, 9 + seed * 3, 1)
    passage = prose(random.Random(9), 5)  # in many texts that are not alike
    texts += [f"{prose(random.Random(100 + i), 5)} {passage}" for i in range(40)]
    rows = list(enumerate(texts))
    sets = shingle_sets(rows)
    expected = groups(sets)
    got = ngram_join.link_groups(clashing(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(sets)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), expected[r["doc_id"]])


def test_near_copies_stage_links_five_words_at_80_percent(spark):
    import corpus_pipeline

    texts = []
    for seed in range(3):
        texts += family(30 + seed, 30, 120, 4) + family(40 + seed, 20, 14, 1)
    words = prose(random.Random(50), 30).split()[:200]
    block = [f"new{i}" for i in range(17)]  # 175 of 217 shingles shared at five words
    texts += [" ".join(words), " ".join(words[:80] + block + words[97:])]
    rows = list(enumerate(texts))
    expected = groups(shingle_sets(rows, 5), 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies_stage(spark, docs, "").collect()}
    assert kept == set(expected.values()) and len(texts) - 1 not in kept


def test_link_groups_of_odd_rows(spark):
    text = prose(random.Random(2), 8)
    rows = [(5, text), (5, text), (3, text), (None, text), (None, None), (7, None), (8, "")]
    got = sorted(map(tuple, ngram_join.link_groups(clashing(spark, rows)).collect()), key=str)
    n = len(shingle_sets([(0, text)])[0])
    assert got == sorted([(5, n, 3), (5, n, 3), (3, n, 3), (None, n, None), (None, 0, None), (7, 0, 7), (8, 0, 8)], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.link_groups(empty).collect() == []


def test_light_sets_meet_at_a_subset_and_heavy_ones_in_the_prefix():
    rng = np.random.default_rng(1)
    late = rng.integers(0, 4, ngram_join.CELLS).astype(np.uint8)
    for boundary in (0, 8, 14):
        for _ in range(300):
            n = int(rng.integers(1, 30))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            b = a.copy()
            for _ in range(int(rng.integers(0, 4))):
                b[rng.integers(len(b))] = rng.integers(0, 2**63)
            b = np.unique(b)[int(rng.integers(0, 3)) :]
            common = len(np.intersect1d(a, b))
            if len(b) and 100 * common >= 85 * (len(a) + len(b) - common):
                x, y = (dict(zip(*map(np.ndarray.tolist, ngram_join.set_keys(s, boundary, late)))) for s in (a, b))
                # where they first meet, enough of both is left
                least = ngram_join.least_overlap(len(a), len(b))
                assert any(min(len(a) - x[k], len(b) - y[k]) >= least for k in set(x) & set(y))


def test_boundary_follows_the_cost():
    # lists that are long make subsets worth while, very short ones don't
    sizes = dict.fromkeys(range(1, 25), 1000)
    assert ngram_join.choose_boundary(sizes, 50.0) > ngram_join.choose_boundary(sizes, 0.0)


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(2)
    for n, m in ((10, 900), (500, 520), (1, 1), (300, 4000)):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 2**63, m).astype(np.uint64)]))
        bound = ngram_join.least_difference(ngram_join.bitmap(a), ngram_join.bitmap(b))
        assert bound <= len(np.setxor1d(a, b))
        assert ngram_join.least_difference(ngram_join.bitmap(a), ngram_join.bitmap(a)) == 0


def test_signs_bound_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        for bits in (128, 512):
            x, y = (ngram_join.sign(s, bits).view(np.uint64) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b)) and len(x) == bits // 64


def test_unlike_members_of_a_list_are_not_compared_and_links_are_found(spark):
    """Families of near copies and single sets, all in two lists; sets are of 100 numbers."""
    rng = np.random.default_rng(5)
    sets = {}
    for family in range(40):
        base = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
        for _ in range(1 if family > 4 else 30):
            own = base.copy()
            own[rng.integers(0, 100, 6)] = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
            sets[int(rng.integers(0, 1 << 62))] = np.unique(own)
    percent = 85
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * (k := len(np.intersect1d(sets[a], sets[b]))) >= percent * (len(sets[a]) + len(sets[b]) - k)}
    keyed = spark.createDataFrame([(key, len(s), node, 0) for node, s in sets.items() for key in (1, 2)], "key long, n int, node long, at int")
    signs = spark.createDataFrame([(node, ngram_join.sign(s).tolist()) for node, s in list(sets.items())[1:]], "node long, sign array<long>")
    met = {}

    def verified(pairs, name):
        met[name] = {(r["a"], r["b"]) for r in pairs.collect()}
        assert len(met[name]) == pairs.count()
        return spark.createDataFrame([p for p in met[name] if p in linked], "a long, b long")

    roots = {r["id"]: r["root"] for r in ngram_join.linked_lists(keyed, verified, percent, signs=lambda: signs).collect()}
    expected = {}
    for a in sets:
        seen, new = {a}, [a]
        while new:
            x = new.pop()
            more = {b if a == x else a for a, b in linked if x in (a, b)} - seen
            seen |= more
            new += more
        expected[a] = min(seen)
    assert {x: roots.get(x, x) for x in sets} == expected
    # a leader for each, then pairs that link or have no sign
    assert len(met["first"]) == len(sets) - 1
    assert sum(len(x - linked) for name, x in met.items() if name != "first") < 2 * len(sets)
    assert not any(x & y for x, y in itertools.combinations(met.values(), 2))


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["id"]: r["root"] for r in got} == {x: root[x] for x in linked} and len(got) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_few_edges_take_few_jobs_and_equal_those_of_many(spark, monkeypatch):
    rng = random.Random(7)
    ids = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(400)]
    edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(300)] + list(zip(ids[:80], ids[1:81])) + [(None, ids[0])]
    table = spark.createDataFrame(edges, "a long, b long")

    def found(group):
        spark.sparkContext.setJobGroup(group, group)
        try:
            rows = sorted(map(tuple, components(table).collect()))
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        return rows, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, jobs = found("few")
    monkeypatch.setattr(common, "FEW_EDGES", 0)
    many, more = found("many")
    assert few == many and len(few) > 100
    assert jobs < 10 < more  # some ten for each of the rounds


def test_what_is_left_of_a_list_meets_few_members_of_a_component_first(spark):
    """Ten nodes link with all 60 of a component, but leaders don't tell: 645 pairs are left, few have to be tried."""
    tried = {}

    def verified(pairs, name):
        tried[name] = pairs.count()
        return pairs.filter("a <= 60") if name in ("some", "left") else pairs.limit(0)

    keyed = spark.range(1, 71).selectExpr("7L AS key", "100 AS n", "id AS node", "0 AS at")
    known = spark.range(2, 61).selectExpr("1L AS a", "id AS b")
    none = spark.createDataFrame([], "node long, sign array<long>")
    found = ngram_join.linked_lists(keyed, verified, known=known, signs=lambda: none).collect()
    assert {r["id"]: r["root"] for r in found} == {i: 1 for i in range(1, 71)}
    assert sum(tried.values()) < 300


def test_short_lists_meet_at_once_and_unlike_sizes_never(spark, monkeypatch):
    """300 lists of two sets of 10 and 40, kept in no table; lists of four, of which only the last two link."""
    rows = [(k, n, 10 * k + n, 0) for k in range(300) for n in (10, 40)]
    rows += [(k, 100, 10 * k + i, 0) for k in range(1000, 1040) for i in range(4)]
    keyed = spark.createDataFrame(rows, "key long, n int, node long, at int")
    tables, tried = {}, {}

    def stored(df, name):
        tables[name] = df.cache()
        return tables[name]

    monkeypatch.setattr(ngram_join, "stored", stored)
    monkeypatch.setattr(ngram_join, "removed", lambda *tables: None)

    def verified(pairs, name):
        tried[name] = pairs.count()
        return pairs.filter("a % 10 = 2 AND b % 10 = 3")

    none = spark.createDataFrame([], "node long, sign array<long>")
    found = ngram_join.linked_lists(keyed, verified, signs=lambda: none).collect()
    assert {r["id"]: r["root"] for r in found} == {10 * k + i: 10 * k + 2 for k in range(1000, 1040) for i in (2, 3)}
    assert tables["lists"].count() == 120
    assert tried == {"first": 120, "round-1": 120}


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_near_keys(spark, how):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    got = {r["k"] for r in near_keys(rows, "k", spark.range(5).withColumn("other", F.lit(1)), "id", how).collect()}
    assert (got >= set(range(5)) and len(got) < 20) if how == "left_semi" else not got & set(range(5))


def test_shingles_of_short_texts():
    one, two, same, none, null = text_shingles(["a b", "a c", " A\tb ", "  ", None], 4)
    assert len(one) == len(two) == 1 and one[0] != two[0] and one[0] == same[0] and not len(none) and not len(null)


def test_bands_are_tuned():
    for percent in (70, 80, 90):
        bands, rows = passages.tune_bands(percent, 0.99)
        assert 1 - (1 - (percent / 100) ** rows) ** bands >= 0.99


@pytest.mark.parametrize("n", [100, 1000])
def test_families_of_paragraphs_match_brute_force(spark, n):
    # all hold one phrase, so that lists are long, and few are alike to those beside them
    rng = random.Random(n)
    phrase = " ".join(prose(rng, 4).replace(".", "").split()[:18])
    bases = [[sentence(rng, 1).rstrip(".") for _ in range(12)] for _ in range(n // 4)]
    texts = []
    for i in range(n):
        own = list(bases[i % len(bases)])
        own[-1] = f"ending{i}"  # alike to its base's others: 25 of 27 shingles
        texts.append(f"{phrase} {' '.join(own)}")
    rows = list(enumerate(texts))
    expected = groups(shingle_sets(rows, 5), 80)
    got = passages.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["first"] for r in got} == {i: root for i, root in expected.items() if i != root}


def test_long_paragraphs_are_cut_alike():
    rng = random.Random(3)
    shared = prose(rng, 20).replace(".", "")
    a = passages.paragraphs("Before it " + shared + " and after")
    b = passages.paragraphs(prose(rng, 9).replace(".", "") + " " + shared)
    same = {tuple(w) for _, _, w in a} & {tuple(w) for _, _, w in b}
    assert sum(map(len, same)) > 60
    text = prose(rng, 4) + "\n\n" + shared + "\n x"
    for start, end, words in passages.paragraphs(text):
        assert text[start:end].encode().lower().split() == words


def test_words_of_many_texts_are_cut_like_those_of_one():
    rng = random.Random(8)
    parts = ["a", "B.", "wörd", "x?", "..", "!", " ", "  ", "\n", "\n \n", ". ", "\x1c", "\u2003", "e.\x85f", "\t", prose(rng, 1), sentence(rng, 60)]
    texts = [None, "", " \n"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    found = passages.Words(texts)
    units = passages.Units(texts)
    for i, text in enumerate(texts):
        expected = passages.paragraphs(text)
        first, end = found.texts_at[i : i + 2]
        at = found.piece_at
        words = [found.flat[at[k] : at[k + 1]].tolist() for k in range(first, end)]
        assert words == [common.hash_words(w).tolist() for _, _, w in expected]
        # lines of several pieces and blocks of several lines
        breaks = [text.count("\n", a[1], b[0]) for a, b in zip(expected, expected[1:])]
        spans = {(k, k) for k in range(len(expected))}
        for least in (0, 1):
            start = 0
            for k, n in enumerate(breaks + [2] if expected else []):
                if n > least:
                    spans.add((start, k))
                    start = k + 1
        long = {(a, b) for a, b in spans if sum(len(expected[k][2]) for k in range(a, b + 1)) >= passages.LEAST_WORDS}
        own = units.owner == i
        assert sorted(zip(units.place[own].tolist(), units.last[own].tolist())) == sorted(long)


def test_signs_of_many_sets_are_lower_bounds():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 50, n).astype(np.uint64)) for n in (1, 30, 60, 200)]
    signs = passages.signs(sets).view(np.uint64)
    for (a, x), (b, y) in itertools.combinations(zip(sets, signs), 2):
        apart = np.bitwise_count(x ^ y).sum()
        assert apart <= len(np.setxor1d(a, b)) and apart % 2 == len(np.setxor1d(a, b)) % 2
    assert passages.signs([]).shape == (0, 2)


def test_runs_of_repeated_paragraphs():
    def runs(sizes, repeated):
        return passages.repeated_runs([(0, 0, [b"w"] * n) for n in sizes], repeated, 30)

    assert runs([20, 20, 9], {0: 1, 1: 1}) == [(0, 1, 40)]
    assert runs([20, 9, 20], {0: 1, 2: 1}) == [(0, 0, 20), (2, 2, 20)]  # a changed one between
    assert runs([20, 3, 20], {0: 1, 2: 1}) == [(0, 2, 43)]  # a short one between
    assert runs([20, 9, 9, 20], {0: 1, 3: 1}) == []
    assert runs([20, 20], {0: 1, 1: 2}) == []  # of two texts
    assert runs([29], {0: 1}) == [] and runs([30], {0: 1}) == [(0, 0, 30)] and runs([], {}) == []


def test_repeated_passages_go(spark):
    rng = random.Random(8)
    passage = prose(rng, 7)
    clean = [prose(rng, 10) for _ in range(12)]
    short = sentence(rng, 12)  # a line that many texts share stays
    rows = [(i, f"{t}\n{short}\n{sentence(rng)}") for i, t in enumerate(clean)]
    holders = [(20 + i, f"{prose(rng, 3)} in the {passage} {prose(rng, 3)}") for i in range(4)]
    near = passage.split()
    near[30] = "other"  # in one sentence, which stays
    holders.append((30, f"{prose(rng, 3)} {' '.join(near)} {prose(rng, 3)}"))
    odd = [(40, None), (41, ""), (None, passage), (42, f"{passage}\n{passage}"), (42, f"{passage}\n{passage}")]
    table = clashing(spark, rows + holders + odd)
    got = {}
    for r in passages.remove_repeated_passages(table).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        assert got[i][0]["text"] == text and got[i][0]["n_removed"] == 0
    interior = " ".join(passage.split()[15:25])
    assert interior in got[20][0]["text"]
    for i in (21, 22, 23):
        assert interior not in got[i][0]["text"] and got[i][0]["repeats_of"] == [20]
        old = dict(holders)[i]
        spans = [tuple(map(int, s.split(":"))) for s in got[i][0]["removed"].split(",")]
        kept, at = "", 0
        for a, b in spans:
            kept, at = kept + old[at:a], b
        assert kept + old[at:] == got[i][0]["text"]
    assert got[30][0]["n_words_removed"] >= 30 and "other" in got[30][0]["text"]
    assert got[40][0]["text"] is None and got[41][0]["text"] == "" and got[None][0]["text"] == passage
    assert len(got[42]) == 2 and all(20 in r["repeats_of"] for r in got[42])
    assert passages.remove_repeated_passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_near_copies_of_whole_paragraphs_go(spark):
    rng = random.Random(12)
    words = prose(rng, 30).split()[:200]
    near = list(words)
    for k in (30, 80, 130, 180):
        near[k] = "changed"  # a Jaccard similarity of 176 / 216
    wrap = lambda ws: "\n".join(" ".join(ws[k : k + 11]) for k in range(0, len(ws), 11))
    tops = [sentence(rng) for _ in range(4)]
    rows = [(1, f"{tops[0]}\n\n{' '.join(words)}\n\nend"), (2, f"{tops[1]}\n\n{' '.join(near)}\n\nlast")]
    lines = prose(rng, 30).split()[:200]
    rows += [(3, f"{tops[2]}\n\n{wrap(lines)}\n\nend"), (4, f"{tops[3]}\n\n{wrap(lines[:96] + ['x'] + lines[97:])}\n\nlast")]
    got = {r["doc_id"]: r for r in passages.remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["text"] for i in (1, 3)] == [rows[0][1], rows[2][1]]
    assert [got[i]["text"] for i in (2, 4)] == [f"{tops[1]}\n\nlast", f"{tops[3]}\n\nlast"]
    assert [got[i]["n_words_removed"] for i in (2, 4)] == [200, 200] and got[2]["repeats_of"] == [1]


def test_passages_of_over_fifty_words_go_wherever_they_are(spark):
    rng = random.Random(21)
    rows, expected = [], {}
    for n in range(50, 61):
        plain = prose(rng, 9).replace(".", "").split()[:n]  # without the marks of sentences
        words = prose(rng, 9).split()[:n]
        short = "\n".join(" ".join(plain[k : k + 3][::-1]) for k in range(0, n, 3))  # in lines of three words
        for kind, passage in enumerate((" ".join(plain), " ".join(words), short)):
            for copy in range(2):
                i = 1000 * copy + 10 * n + kind
                before, after = f"{sentence(rng)[:-1]} b{i}", f"a{i} {sentence(rng)}"
                rows.append((i, f"{before} {passage} {after}"))
                expected[i] = f"{before} {after}" if copy else rows[-1][1]
    got = passages.remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # the word beside a passage may go with the piece that holds it, which is alike
    plain = lambda t: re.sub(r" [ab]\d+\b", "", t)
    assert {r["doc_id"]: plain(r["text"]) for r in got} == {i: plain(t) for i, t in expected.items()}


def test_runs_of_sentences_that_others_hold_singly_go(spark):
    rng = random.Random(15)
    shared = [sentence(rng, 9) for _ in range(5)]
    rows = [(i, f"{prose(rng, 3)} {shared[i - 1]} {prose(rng, 3)}") for i in (1, 2, 3, 4)]
    rows += [(i, f"{prose(rng, 3)} {' '.join(shared)} {prose(rng, 3)}") for i in (10, 20)]
    got = {r["doc_id"]: r for r in passages.remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["text"] == text for i, text in rows[:5])
    assert got[20]["text"] == rows[5][1].replace(" ".join(shared) + " ", "")
    singly = {0: 1, 1: 2, 2: 3, 3: 4, 4: 10}
    found = [(0, 0, [b"w"] * 9)] * 5
    assert passages.repeated_runs(found, singly) == []
    assert passages.repeated_runs(found, singly, beside={k: (k + 1, 10) for k in range(4)}) == [(0, 4, 45)]


def test_places_are_gone_and_bands_dealt_singly_before_sets_meet(spark, monkeypatch):
    """The disk holds keys and places of all paragraphs only until lists are known, and sets of some pairs at a time."""
    rng = random.Random(7)
    shared = [prose(rng, 9) for _ in range(4)]
    rows = [(i, "\n\n".join([prose(rng, 3), shared[i % 4], shared[i % 3].replace(" an", " no")])) for i in range(24)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ["doc_id", "place", "last", "first", "next"]
    expected = sorted(map(str, passages.repeated_paragraphs(table).select(*columns).collect()))
    names, gone, there = [], [], []

    def stored(df, name):
        if name == "first-members":
            there.append([f for f in gone if os.path.exists(f)])
        names.append(name)
        return common.stored(df, name)

    def removed(*tables):
        gone.extend(f.removeprefix("file://") for t in tables for f in t.inputFiles() if "/places-" in f)
        common.removed(*tables)

    for module in (ngram_join, passages):
        monkeypatch.setattr(module, "stored", stored)
        monkeypatch.setattr(module, "removed", removed)
    monkeypatch.setattr(passages, "PAIRS_AT_ONCE", 4)
    monkeypatch.setattr(passages, "PAIRS_A_SET", 0)
    monkeypatch.setattr(passages, "signs_allow", lambda *args: F.lit(True))
    found = sorted(map(str, passages.repeated_paragraphs(table).select(*columns).collect()))
    assert found == expected and expected
    assert names.count("lists") == passages.tune_bands()[0] and gone and there[0] == []
    assert names.count("first-links") > 1


def test_registered_queries(spark):
    from doclake.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sets = shingle_sets(rows)
    expected = groups(sets)
    got = queries.op5_size_aware_join(spark, sf_dir).collect()
    assert {tuple(r) for r in got} == {(i, len(sets[i]), expected[i]) for i in sets} and len(got) == len(rows)
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert sorted(map(tuple, got)) == sorted(duckdb.sql(queries.oracle_sql()["op5_size_aware_join"]).fetchall())
    # no passage of 60 words is left in two texts, apart from those that repeat a word or two
    left = {r["doc_id"]: r["text"] for r in queries.op6_paragraph_bands(spark, sf_dir).collect()}
    assert len(left) == len(rows)

    def long_runs(texts):
        seen = {}
        for i, text in texts.items():
            words = (text or "").split()
            for k in range(len(words) - 59):
                run = tuple(words[k : k + 60])
                if len(set(run)) > 20:
                    seen.setdefault(run, set()).add(i)
        return sum(len(v) > 1 for v in seen.values())

    before = long_runs(dict(rows))
    assert before > 0 and long_runs(left) <= 0.05 * before
