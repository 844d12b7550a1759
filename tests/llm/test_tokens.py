"""BPE, packing, top-k search and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from doclake.llm import bpe, packing, queries, topk
from doclake.llm.common import tokenizer_path
from samples import clashing, documents

SF_DIR = "/root/testdata/sf0.001"
LETTERS = list("ab1!'s .\n\t  é漢\x85\xa0 ​\x1c😀İßẞÿ×ªµÀÑ~\x7f\xadΣς\x00́") + ["<|endoftext|>", "<|startoftext|>", "'ll", "A"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_texts(n=3000, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_words_are_cut_where_the_tokenizer_cuts():
    tokenizer = bpe.load(tokenizer_path(bpe.VOCABULARY))
    special = bpe.special_pattern(tokenizer)
    for text in odd_texts():
        words = bpe.split_words(text, special)
        assert "".join(words) == text
        one = [i for w in words for i in tokenizer.encode(w, add_special_tokens=False).ids]
        assert one == tokenizer.encode(text, add_special_tokens=False).ids


def test_encode_decode(spark, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path(bpe.VOCABULARY))
    rows = queries.op4_word_table_bpe(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    odd = list(enumerate(odd_texts(300))) + documents(3, 5) + [(None, "null key"), (None, "null key"), (9, None)]
    more = bpe.encode_decode(clashing(spark, odd), ids=True).collect()
    assert len(more) == len(odd)
    expected = {}
    for key, text in odd:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        expected.setdefault(key, []).append((ids, tokenizer.decode(ids, skip_special_tokens=False)))
    for r in more:
        assert (r["ids"], r["decoded"]) in expected[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
    for r in rows:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert tuple(r)[1:] == (len(ids), sha(",".join(map(str, ids))), sha(back))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_decode(empty).collect() == []


def test_word_ids_are_those_of_the_tokenizer():
    table = packing.WordIds(tokenizer_path(packing.VOCABULARY))
    for text in odd_texts(3000, 2):
        got = np.frombuffer(b"".join(table[w] for w in text.encode().split()), dtype="<u4").tolist()
        assert got == table.tokenizer.encode(text, add_special_tokens=False).ids


def test_text_ids_are_those_of_the_tokenizer():
    table = packing.WordIds(tokenizer_path(packing.VOCABULARY))
    for text in [*odd_texts(3000, 5), "It's a “plain”  word's\x0bÉtÉ,\xa0×2 <|endoftext|>x don'T"]:
        got = np.frombuffer(table.text(text), dtype="<u4").tolist()
        assert got == table.tokenizer.encode(text, add_special_tokens=False).ids


def test_parts_in_use_outlive_a_full_table(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_PARTS", 4)
    table, encoded = packing.WordIds(tokenizer_path(packing.VOCABULARY)), []

    class Counted:
        model = table.parts.model

        def tokenize(self, part):
            encoded.append(part)
            return self.model.tokenize(part)

    table.parts.model = Counted()
    text = " ".join(f"The {chr(97 + i)}bc." for i in range(20))
    got = np.frombuffer(table.text(text), dtype="<u4").tolist()
    assert got == table.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoded.count("the") == encoded.count(".") == 1 and len(table.parts) <= 4


def check_packing(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_documents(spark, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))
    rows = queries.op9_best_fit_packing(spark, SF_DIR).collect()
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    expected = {}
    for key, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected[key, k] = (at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))
    assert got == expected and len(rows) == len(expected)
    total = sum(r["length"] for r in rows)
    assert check_packing(rows, 4096) <= -(-total // 4096) + 1


def test_packing_of_odd_rows(spark):
    table = clashing(spark, [(1, None), (1, None), (None, ""), (2, "a b c d e f g h"), (3, "  ")])
    rows = packing.pack(packing.token_pieces(table, capacity=4), capacity=4).collect()
    assert sorted(r["length"] for r in rows) == [1, 1, 1, 1, 1, 4, 4]
    assert check_packing(rows, 4) == 4
    assert packing.pack(packing.token_pieces(table.limit(0))).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_reduction_and_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100])
    counts = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 15))}
    used, bins = {}, 0
    for first, m, items in packing.reduce_and_pack(counts, capacity):
        assert first == bins
        bins += m
        at = 0
        for length, rank, offset in items:
            assert offset == at
            at += length
            for i in range(m):
                used.setdefault(length, []).append(rank + i)
        assert at <= capacity
    assert {k: sorted(v) for k, v in used.items()} == {k: list(range(v)) for k, v in counts.items()}
    total = sum(k * v for k, v in counts.items())
    large = sum(v for k, v in counts.items() if 2 * k > capacity)
    assert bins <= max(large, 1.25 * total / capacity + 2)


@pytest.mark.parametrize("seed", range(12))
def test_reduction_is_never_worse_than_the_best_packing(seed):
    rng = random.Random(seed)
    items = [rng.randint(2, 12) for _ in range(9)]
    counts = {k: items.count(k) for k in items}
    groups = packing.reduce_and_pack(counts, 12)

    def best(left, rooms):
        if not left:
            return len(rooms)
        found = best(left[1:], rooms + [12 - left[0]])
        for i in range(len(rooms)):
            if rooms[i] >= left[0] and rooms[i] not in rooms[:i]:
                found = min(found, best(left[1:], rooms[:i] + [rooms[i] - left[0]] + rooms[i + 1 :]))
        return found

    assert sum(m for _, m, _ in groups) <= best(sorted(items, reverse=True), []) + 1


def brute(vectors, k=5):
    out = {}
    for q, x in vectors:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_top_k_matches_brute_force(spark):
    rng = random.Random(5)
    vectors = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5, 0.75]) for _ in range(4)]) for i in range(400)]
    odd = [(1000, None), (1050, [float("nan")] * 4), (1100, [None, 1.0, 1.0, 1.0]), (1150, [float("inf")] * 4), (None, [0.5] * 4)]
    again = vectors[:40]  # repeated rows change nothing
    table = spark.createDataFrame(vectors + odd + again, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    scaled = [(i, [int(np.floor(256 * v)) for v in x]) for i, x in vectors]
    expected = brute(scaled)
    for blocks in ({}, {"candidate_block": 7, "query_bytes": 100}):
        got = {}
        for r in topk.top_k(table, F.col("vec_id") % 50 == 0, **blocks).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert got == expected
    few = topk.top_k(table.filter("vec_id < 3"), F.col("vec_id") % 50 == 0).collect()
    assert len(few) == 2 and topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_threshold_stops_early():
    rng = np.random.default_rng(1)
    rows = rng.integers(-50, 50, (5000, 3))
    rows[17] = [500, 500, 500]
    rows[18] = [499, 500, 500]
    ids, query = np.arange(5000), np.array([1, 2, 1])
    lists = topk.sorted_lists(rows)

    class Counting(np.ndarray):
        read = 0

        def __getitem__(self, at):
            Counting.read += np.size(at)
            return super().__getitem__(at)

    found, _ = topk.threshold_top_k(query, -1, ids, rows.view(Counting), lists, 2)
    assert found.tolist() == [17, 18] and Counting.read < 1000


def test_top_k_query(spark):
    import duckdb

    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    expected = duckdb.sql(queries.oracle_sql()["op10_threshold_top_k"]).fetchall()
    got = queries.op10_threshold_top_k(spark, SF_DIR).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_pipeline(spark, texts):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert check_packing(rows, 4096) > 0
    kept = {r["doc_id"] for r in rows}
    assert kept <= set(texts) and len(kept) > 0.5 * len(texts)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert not any(quality.get(i) == 0 for i in kept)
    # of equal texts that the classifier keeps, one stays
    same = {}
    for i in kept:
        same.setdefault(texts[i], []).append(i)
    assert all(len(v) == 1 for t, v in same.items() if t and len(t.split()) > 3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    odd = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF_DIR).collect() == []


def test_input_in_another_order_each_time(spark):
    """Texts are split twice; behind an unseeded sort both readings would differ."""
    rows = documents(9, 40)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).orderBy(F.rand())
    tokenizer = Tokenizer.from_file(tokenizer_path(bpe.VOCABULARY))
    expected = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    assert {r["doc_id"]: r["n_tokens"] for r in bpe.encode_decode(table).collect()} == expected


def test_an_id_with_several_vectors_counts_once(spark):
    rows = [(0, [1.0, 0.0])] + [(1, [x, 0.5]) for x in (2.0, 3.0, 4.0, 5.0, 6.0, 7.0)] + [(i, [1.0 / i, 1.0]) for i in range(2, 9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(table, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3, 4, 5] and got[0]["score"] == 256 * 7 * 256
