"""Personal data and secrets against Python's own regular expressions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from doclake.llm import pii, secret_scan, spans
from samples import clashing, prose


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def secrets(text):
    text, out = text or "", []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text, re.I | re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if m.end() - m.start() >= 20:
            out.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer("[0-9a-f]+", text):
        if m.end() - m.start() >= 24:
            out.append((m.start(), 2, m.end(), "hex"))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


PERSONAL = ["a", "b.", "@", "x@y.z", ".", "1", "4111111111111111", "4111 1111-1111 1111", "0", "25", "255", "1.2.3.4",
            ".5", " ", "-", "+", "+1 (", "555) ", "555-1234", "é", "😀", "\n", "_", "%", "0001.002.3.4", "  "]
SECRET = ["password", "PassWD", "secret", "token", "apikey", "API_KEY", "=", " = ", ":", '"', "'", " ", "abc", "123456",
          "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "0", "é", "😀", "\n", "K", "ſ", ".", "-"]
LONG = ["a" * 20000 + "@b.c", "1" * 20000, "+1" + "." * 20000, "1.2.3.4 " * 1500, "token" * 3000, "a1" * 20000]


@pytest.mark.parametrize(
    "found, expected, parts", [(pii.base_spans, personal, PERSONAL), (secret_scan.base_spans, secrets, SECRET)]
)
def test_base_spans(spark, found, expected, parts):
    rng = random.Random(7)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(1200)] + ["", None] + LONG
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = rows.select("i", spans.listed(found(F.coalesce("t", F.lit("")))).alias("s")).collect()
    assert [r for r in got if r["s"] != expected(texts[r["i"]])] == []


def test_many_matches_keep_their_places(spark, values):
    text = "".join(f"é{i} " for i in range(1000))
    got = values(lambda c: spans.listed(spans.find(c, "[0-9]+", "n", 0)), [text, "", None, "12"])
    assert got[0] == ",".join(f"n:{m.start()}:{m.end()}" for m in re.finditer("[0-9]+", text))
    assert got[1] == "" and got[3] == "n:0:2"


def test_terms_that_tell_of_an_entity(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 4)) for i in range(40)]
    for i in range(4):  # one name beside one address, in different surroundings
        rows.append((100 + i, f"{prose(rng, 2)} Zaphodius, z@h2g2.example {prose(rng, 2)}"))
    # copies prove nothing: one surrounding only
    rows += [(200 + i, "Here marvinus sent a@b.example away.") for i in range(6)]
    rows += [(300, None), (301, ""), (None, "mail z@h2g2.example now"), (None, "mail z@h2g2.example now"), (302, "said (Zaphodius)!")]
    found = {}
    for r in pii.find_personal_data(clashing(spark, rows)).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert len(found[None]) == 2 and all(len(r["pii_spans"]) == 1 for r in found[None])
    words = lambda r: [r["text"][s["start"] : s["end"]] for s in r["pii_spans"] if s["kind"] == "term"]
    assert all(words(found[100 + i][0]) == ["Zaphodius"] for i in range(4))
    assert words(found[302][0]) == ["Zaphodius"]
    assert not any(words(found[200 + i][0]) for i in range(6))
    assert all(not words(found[i][0]) for i in range(40))
    assert found[300][0]["pii_spans"] == [] and found[301][0]["pii_spans"] == []
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(clashing(spark, rows)).filter("doc_id IS NOT NULL").collect()}
    assert "example" not in clean[100] and "Zaphodius" not in clean[101] and "<email>" in clean[100]
    assert clean[0] == dict(rows)[0] and clean[300] is None and clean[301] == ""


def test_overlapping_spans_are_replaced_once(spark):
    rows = spark.createDataFrame([("+378282246310005 é x@y.z.",), ("plain",), (None,)], "text string")
    rows = rows.select(F.lit(1).alias("doc_id"), "text")
    got = [r["text"] for r in pii.sanitise(rows).collect()]
    assert sorted(got, key=str) == ["<phone> é <email>.", None, "plain"]


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert pii.sanitise(rows).collect() == []
    assert secret_scan.find_secrets(rows, secret_scan.fit(rows)).collect() == []


def test_random_strings(spark):
    rng = random.Random(5)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(60)]
    rows = [(i, f"{prose(rng, 5)} token = {h} and {k}") for i, (h, k) in enumerate(zip(hexes, keys))]
    rows += [(1000 + i, prose(rng, 20)) for i in range(60)] + [(2000, None), (None, "x"), (None, "x")]
    secret = "wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLEKEY"
    rows += [(3000, f"key {secret} here"), (3001, "antidiscofolejakoregasamiunve " + "-" * 60)]
    table = clashing(spark, rows)
    model = secret_scan.fit(table)
    got = {}
    for r in secret_scan.find_secrets(table, model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [s["value"] for s in got[3000][0]["secret_spans"]] == [secret]
    assert got[3001][0]["secret_spans"] == [] and len(got[None]) == 2 and got[2000][0]["secret_spans"] == []
    assert all(got[1000 + i][0]["secret_spans"] == [] for i in range(60))
    # the ratio is that of plain Python
    token = "ghp_16C7e42F292c6912E7710c838347Ae178B4a"
    value = spark.range(1).select(secret_scan.log_ratio(F.lit(token), model).alias("v")).first()["v"]
    assert abs(value - sum(model.get(p, 0) for p in zip(token, token[1:]) if p in model)) < 0.1


def test_random_tokens_of_all_alphabets(spark):
    rng = random.Random(11)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = secret_scan.fit(docs)
    hexes = "0123456789ABCDEF"
    alphabets = (hexes, hexes.lower(), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    planted = [
        (1000 * a + n, f"see {''.join(rng.choice(letters) for _ in range(n))} there")
        for a, letters in enumerate(alphabets) for n in (16, 20) for _ in range(100)
    ]
    found = {}
    for r in secret_scan.find_secrets(spark.createDataFrame(planted, "doc_id long, text string"), model).collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + bool(r["secret_spans"])
    assert all(n >= 97 for n in found.values()), found


def test_registered_queries(spark):
    from doclake.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for query, expected in ((queries.op1_information_pii, personal), (queries.op3_markov_secrets, secrets)):
        rows = query(spark, sf_dir).collect()
        assert len(rows) == len(texts)
        for r in rows:
            base = expected(texts[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
            kinds = [k for k in ("email", "ip", "card", "phone", "assign", "access", "hex") if f"n_{k}" in r]
            assert [r[f"n_{k}"] for k in kinds] == [len(re.findall(f"{k}:", base)) for k in kinds]
            assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
