"""Files, extraction, messages, streams, models and the layers end to end."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from doclake.constants import PROMPT_HEAD, TOPICS
from doclake.functions import html
from doclake.functions import messages as msg
from doclake.functions.metadata import first_value_or_empty, meta_fallback
from doclake.operators import answers, features, training
from doclake.operators.extract import extract_documents
from doclake.operators.tables import KeyedTable
from doclake.plans import Lake, ingest_tables, run_layers, run_marts
from doclake.session import scratch_path
from doclake.sources import files, kafka_options, scan_csv, scan_files, stream_source
from doclake.plans.layers import gold
from doclake.streaming import classify_stream, stream_classify, stream_run
from doclake.streaming.documents import STREAM_SCHEMA, rejected_messages

PAGE = (
    '<!DOCTYPE html><html lang="pt"><head><title>Pre&ccedil;os &amp; &#237;ndices</title>'
    '<meta name="author" content="Ana &amp; Rui"><style>p{}</style></head>'
    "<body><!-- hidden --><script>var x='<p>';</script><p>Um&nbsp;texto<br>longo</p></body></html>"
)


@pytest.fixture
def folder(tmp_path):
    sentence = "O mercado de imóveis cresce. A construção de imóveis residencial cresce com o mercado. "
    (tmp_path / "a.txt").write_text("  " + sentence * 3)
    (tmp_path / "b.HTML").write_text(PAGE.replace("Um&nbsp;texto", "Texto com inflação e IPCA " * 6))
    (tmp_path / "c.pdf").write_bytes(b"%PDF raw bytes")
    (tmp_path / "d.jpg").write_bytes(b"picture")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.txt").write_text("nested")
    return str(tmp_path)


def names(df):
    return sorted(r["file_name"] for r in df.select("file_name").collect())


def test_scan_files(spark, folder):
    assert names(scan_files(spark, folder)) == ["a.txt", "b.HTML", "c.pdf"]
    assert names(scan_files(spark, folder, ["pdf", "html"], ignore_case=False)) == ["c.pdf"]
    assert names(scan_files(spark, folder, ["txt"], recursive=True)) == ["a.txt", "sub/e.txt"]


@pytest.mark.parametrize("recursive", [False, True])
def test_long_listings_stay_out_of_the_driver(spark, tmp_path, monkeypatch, recursive):
    """Tasks list and read the same files as Spark's own reader, and no plan holds them."""
    odd = ["a.txt", "B.TXT", "c d%20é.txt", "_hidden.txt", "_k=1.txt", ".dot.txt", "x.txt._COPYING_", "empty.txt", "p.jpg", "notxt"]
    for i, name in enumerate(odd + [f"{i}.txt" for i in range(40)]):
        (tmp_path / name).write_bytes(b"" if name == "empty.txt" else b"\xff\x00" * i + name.encode())
        os.utime(tmp_path / name, ns=(10**18 + i, 1_700_000_000_123_456_789 + i * 10**6))
    if recursive:
        for place in ("k=1/in", "_no", "_metadata", ".git", "deep/er/est"):
            (tmp_path / place).mkdir(parents=True)
            (tmp_path / place / "z.txt").write_text(place)
        os.symlink(tmp_path / "deep", tmp_path / "k=1" / "linked")
        os.symlink(tmp_path / "nowhere", tmp_path / "broken.txt")
    folder = f"{tmp_path}/"
    rows = lambda df: sorted(map(tuple, df.select("path", "modificationTime", "length", "content", "file_name").collect()))
    by_driver = scan_files(spark, folder, recursive=recursive)
    expected = rows(by_driver)
    monkeypatch.setattr(files, "MOST_LISTED", 10)
    monkeypatch.setattr(files, "READ_BYTES", 30)
    by_tasks = scan_files(spark, folder, recursive=recursive)
    assert by_tasks.columns == by_driver.columns and rows(by_tasks) == expected and len(expected) > 40
    read = set(by_tasks.inputFiles())
    assert read and not any(f.endswith(("txt", "TXT")) for f in read)
    # content is read only where it is asked for
    assert "Python" not in plan_of(by_tasks.select("file_name", "length"))
    few = names(by_tasks.filter("length < 5"))
    assert few == sorted(r[4] for r in expected if r[2] < 5)


def test_extract(spark, folder):
    rows = {r["file_name"]: r for r in extract_documents(scan_files(spark, folder)).collect()}
    assert rows["a.txt"]["text_content"].startswith("O mercado")
    page = rows["b.HTML"]
    assert (page["title"], page["author"], page["language"]) == ("Preços & índices", "Ana & Rui", "pt")
    assert page["text_content"].endswith("IPCA longo") and "hidden" not in page["text_content"]
    assert rows["c.pdf"]["text_content"] == "" and rows["c.pdf"]["content_type"] == "application/pdf"
    assert rows["a.txt"]["num_pages"] == "" and rows["a.txt"]["ingested_at"] is not None


def test_extract_with_parser(spark, folder):
    def factory():
        def parser(name, content):
            if b"broken" in content:
                raise ValueError("no such page")
            return f" {name} {len(content)}\n", {"Author": ["Eva", "Rui"], "Page-Count": [3], "title": []}

        return parser

    with open(f"{folder}/z.pdf", "wb") as file:
        file.write(b"broken")
    rows = {r["file_name"]: r for r in extract_documents(scan_files(spark, folder), factory, errors=True).collect()}
    pdf = rows["c.pdf"]
    assert (pdf["text_content"], pdf["author"], pdf["num_pages"], pdf["title"]) == ("c.pdf 14", "Eva", "3", "")
    bad = rows["z.pdf"]
    assert (bad["text_content"], bad["content_type"], bad["parse_error"]) == ("", "application/pdf", "ValueError: no such page")
    assert pdf["parse_error"] is None and rows["a.txt"]["parse_error"] is None
    plan = plan_of(extract_documents(scan_files(spark, folder), factory))
    assert plan.count("FileScan binaryFile") == 1


def test_files_of_any_encoding(spark, tmp_path):
    text = "informação é útil"
    for name, coding in (("a", "utf-8"), ("b", "latin-1"), ("c", "utf-16"), ("d", "utf-8-sig")):
        (tmp_path / f"{name}.txt").write_bytes(text.encode(coding))
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.txt").write_bytes(b"\xff\xfe\xfd")
    rows = {r["file_name"]: r["text_content"] for r in extract_documents(scan_files(spark, str(tmp_path), recursive=True)).collect()}
    assert {rows[f"{n}.txt"] for n in "abcd"} == {text} and rows["x/a.txt"] == "ÿþý"


def test_meta_attributes_in_any_order(values):
    page = """<meta content="D'Angelo" name='author'><META  name=date content=2024-01-02>
        <meta name="author" content='a "b" > c' /><meta name="keywords" content="x">"""
    found = values(html.html_metadata, [page, "<meta name='author' content='" + "a" * 50000 + "'>"])
    assert found[0]["dc:creator"] == ["D'Angelo", 'a "b" > c'] and found[0]["dcterms:created"] == ["2024-01-02"]
    assert len(found[1]["dc:creator"][0]) == 50000


def test_entities(values):
    given = ["caf&#233; &#xE9;&#x1F600;", "&amp;lt;", "&#bad; &# x", None, "a;b&#65;c;d",
             "informa&ccedil;&atilde;o &euro;&#0000233;&#x0000E9;", "&nosuch; & &;", "&#0;&#xD800;&#99999999999;"]
    assert values(html.unescape, given) == ["café é😀", "&lt;", "&#bad; &# x", None, "a;bAc;d",
                                            "informação €éé", "&nosuch; & &;", "\ufffd" * 3]


def test_metadata(values):
    keys = ("first", "second")
    fallback = lambda c: meta_fallback(c, keys)
    given = [
        {"first": ["x", "y"], "second": ["z"]},
        {"second": ["z"]},
        {"first": [], "second": ["z"]},
        {"other": ["z"]},
        None,
    ]
    assert values(fallback, given, "x map<string, array<string>>") == ["x", "z", "", "", ""]
    assert values(first_value_or_empty, [["a", "b"], [], None], "x array<string>") == ["a", "", ""]


def test_replies(values):
    replies = {
        "ollama": {"response": " yes\n"},
        "openai": {"choices": [{"message": {"content": " yes "}}]},
        "gemini": {"candidates": [{"content": {"parts": [{"text": "yes"}]}}]},
        "unheard-of": {"response": "yes"},
    }
    for provider, reply in replies.items():
        assert values(lambda c: msg.parse_reply(c, provider), [json.dumps(reply), "{"]) == ["yes", None]


def message(name, text):
    return json.dumps({"file_name": name, "text_content": text, "content_type": "t", "title": "T"})


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    lexicon = {"one": ["alpha"], "two": ["beta"]}
    (tmp_path / "1.txt").write_text("\n".join([message("a", "alpha"), "{bad", message("b", None), message("c", "")]))
    keyed = KeyedTable(spark, scratch_path(spark, "live"), "file_name", STREAM_SCHEMA)
    checkpoint = scratch_path(spark, "checkpoint")
    raw = stream_source(spark, "text", path=str(tmp_path))

    def run():
        stream_run(stream_classify(raw, lexicon), keyed, checkpoint, None).awaitTermination()
        return {r["file_name"]: r["topic"] for r in keyed.latest().collect()}

    assert run() == {"a": "one", "c": "desconhecido"}
    (tmp_path / "2.txt").write_text(message("a", "beta!"))
    assert run() == {"a": "two", "c": "desconhecido"}
    assert run() == {"a": "two", "c": "desconhecido"}
    batch = spark.read.text(str(tmp_path))
    assert stream_classify(batch, lexicon).count() == 3
    assert rejected_messages(batch).count() == 2


def test_later_messages_of_a_key_win_and_a_new_checkpoint_loses_nothing(spark, tmp_path):
    lexicon = {f"t{i}": [f"word{i}"] for i in range(10)}
    lines = [message(f"k{k}", f"word{i}") for i in range(10) for k in range(30)]
    (tmp_path / "1.txt").write_text("\n".join(lines))
    keyed = KeyedTable(spark, scratch_path(spark, "live"), "file_name", STREAM_SCHEMA)
    raw = stream_source(spark, "text", path=str(tmp_path))
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    for checkpoint in (scratch_path(spark, "one"), scratch_path(spark, "two")):
        classify_stream(raw, keyed, checkpoint, None, lexicon=lexicon, now=now).awaitTermination()
        assert {r["topic"] for r in keyed.latest().collect()} == {"t9"} and keyed.latest().count() == 30
    assert keyed.batches().count() == 2


def test_rules_come_before_the_models(spark):
    texts = ["", "x" * 99, "y" * 100, None]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file_name string, text_clean string")
    for name in ("content_type", "title", "author", "language", "num_pages"):
        rows = rows.withColumn(name, F.lit(""))
    rows = rows.withColumns({"text_length": F.length("text_clean"), "ingested_at": F.current_timestamp(), "processed_at": F.current_timestamp()})
    model = lambda: lambda values: [f"model {len(v)}" for v in values]
    got = {r["file_name"]: (r["topic"], r["summary"]) for r in gold(rows, summary_model=model, topic_model=lambda: lambda values: ["economia" for _ in values]).collect()}
    assert got["0"] == got["3"] == ("desconhecido", "")
    assert got["1"][1] == "x" * 99 and got["2"][1] == "model 100"


def test_stream_model_hook_and_kafka_options(spark):
    batch = spark.createDataFrame([(message("a", "Alpha"),)], "value string")
    got = stream_classify(batch, clean=False, classify=lambda text: F.upper(text)).first()
    assert got["topic"] == "ALPHA"
    assert kafka_options("h:1", "t")["startingOffsets"] == "latest"


def test_embedding_is_unit_length_and_takes_models(spark):
    df = spark.createDataFrame([("a b b",), ("",), (None,)], "text_clean string").filter("text_clean is not null")
    rows = features.embed_documents(df).collect()
    assert {len(r["embedding"]) for r in rows} == {768}
    assert sorted(round(sum(x * x for x in r["embedding"]), 5) for r in rows) == [1.0, 1.0]

    def factory():
        return lambda texts: [[float(len(t)), 0.0] for t in texts]

    rows = features.embed_documents(df, model=factory, max_chars=2).collect()
    assert sorted(r["embedding"] for r in rows) == [[0.0, 0.0], [1.0, 0.0]]


def test_labels(values):
    labels = ["tecnologia", "economia", "unknown", None]
    assert values(training.encode_labels, labels) == [5, 0, 0, 0]
    assert values(lambda c: training.decode_labels(training.encode_labels(c)), labels)[0] == TOPICS[5]


def test_training_learns_and_is_repeatable(spark):
    silver = spark.createDataFrame(
        [(i, ("juros banco " if i % 2 else "software dados ") * (1 + i % 4)) for i in range(80)],
        "file_name int, text_clean string",
    )
    gold = silver.select(
        "file_name", F.when(F.col("file_name") % 2 == 1, "economia").otherwise("tecnologia").alias("topic")
    )
    data = training.training_set(silver, gold)
    model = training.train_topic_model(data, rounds=10)
    assert training.accuracy(model, data) == 1.0
    losses = training.loss_per_round(model)
    assert losses[-1] < losses[0]
    assert losses == training.loss_per_round(training.train_topic_model(data, rounds=10))
    train, test = training.hold_out(data)
    assert train.count() + test.count() == 80 and 5 < test.count() < 30
    assert train.join(test, "file_name").count() == 0
    assert training.accuracy(training.train_topic_model(train, rounds=10), test) == 1.0
    path = scratch_path(spark, "model")
    training.save_model(model, path)
    predicted = training.predict_topics(training.load_model(path), data)
    assert predicted.filter("topic <> predicted_topic").count() == 0


def test_questions_to_answers(spark):
    docs = spark.createDataFrame(
        [("x.pdf", "preço do imóvel em alta"), ("y.pdf", "taxa de juros do banco"), ("z.pdf", "futebol " * 3000)],
        "file_name string, text_clean string",
    )
    asked = spark.createDataFrame([(1, "Qual a taxa de juros?"), (2, "preço do imóvel")], "question_id int, question string")
    embedded = features.embed_documents(docs)
    hits = answers.with_texts(answers.retrieve(embedded, asked, k=2), docs)
    prompts = answers.build_prompt(hits, asked)
    first = prompts.filter("question_id = 1").first()["prompt"]
    assert first.startswith(PROMPT_HEAD + "[y.pdf]\ntaxa de juros do banco\n\n[x.pdf]\n")
    assert first.endswith("\n\nPergunta: Qual a taxa de juros?\n\nResposta:")
    cut = answers.build_prompt(hits, asked, max_chars=4).filter("question_id = 1").first()["prompt"]
    assert "[y.pdf]\ntaxa\n\n" in cut

    def client():
        return lambda prompt, temperature: json.dumps({"response": f" {temperature} {len(prompt)} "})

    told = answers.generate_answers(prompts, {"ollama": client}, "nobody").filter("question_id = 1").first()
    assert told["answer"] == f"0.1 {len(first)}"


def test_one_call_answers_questions(spark):
    docs = features.embed_documents(
        spark.createDataFrame([("x.pdf", "preço do imóvel"), ("y.pdf", "taxa de juros")], "file_name string, text_clean string")
    )
    asked = spark.createDataFrame([(1, "taxa de juros?")], "question_id int, question string")
    client = lambda: lambda prompt, t: json.dumps({"response": prompt.split("\n[", 1)[1][:5]})
    told = answers.answer_questions(docs, asked, {"ollama": client}, "ollama", k=1).first()
    assert told["answer"] == "y.pdf"


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('k,s,t\n007," say ""hi""\nthere ",2024-01-02 03:04:05\n008,x,never\n')
    rows = scan_csv(spark, str(tmp_path / "t.csv"), "k string, s string, t string", True).orderBy("k").collect()
    assert rows[0]["k"] == "007" and rows[0]["s"] == ' say "hi"\nthere '
    written = ingest_tables(
        spark, str(tmp_path), str(tmp_path / "wh"), "csv_db", {"t": "k string, s string, t string"},
        {"t": ("t.csv", ("t", "absent"))}, multi_line=["t"],
    )
    stored = spark.table("csv_db.t").orderBy("k")
    assert written == {"t": 2} and dict(stored.dtypes)["t"] == "timestamp"
    assert [(r["k"], r["s"]) for r in stored.collect()] == [("007", 'say "hi"\nthere'), ("008", "x")]


def test_layers(spark, folder):
    lake = Lake(spark, scratch_path(spark, "lake"), folder, database="lake_test_db")
    assert run_layers(lake) == {"bronze": 3, "silver": 2, "gold": 2}
    assert run_layers(lake, "gold", "run-b") == {"gold": 2} == run_layers(lake, "gold", "run-b")
    assert lake.enriched().batches().count() == 2
    topics = {r["file_name"]: r["topic"] for r in lake.enriched().latest().collect()}
    assert topics == {"a.txt": "imóveis", "b.HTML": "inflação"}
    checks = run_marts(lake).collect()
    assert len(checks) == 7 and not any(r["failures"] for r in checks)
    assert spark.table("lake_test_db.mart_documents_by_topic").count() == 2
    # a run over other files adds to the table
    os.remove(f"{folder}/a.txt")
    with open(f"{folder}/n.txt", "w") as file:
        file.write("O mercado de imóveis cresce com o crédito, e os preços também sobem. " * 2)
    run_layers(lake)
    assert names(lake.enriched().latest()) == ["a.txt", "b.HTML", "n.txt"]
    with pytest.raises(ValueError, match="no layer"):
        run_layers(lake, "platinum")


def test_text_files_are_those_of_the_writer_and_soon_there(spark, tmp_path):
    import time
    from collections import Counter

    from doclake.checks.queries import _write_files

    rows = [(i % 50, f"text {i}\nä") for i in range(60)] + [(7, None), (None, "no key"), (70, "")]
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id").cache()

    def written(folder):
        files = [f for f in folder.rglob("*.txt") if f.stat().st_size]
        return Counter((f.parent.relative_to(folder).as_posix(), tuple(sorted(f.read_bytes().split(b"\n")))) for f in files)

    _write_files(data, str(tmp_path / "own"), "doc_id")
    data.write.partitionBy("doc_id").text(str(tmp_path / "theirs"))
    assert written(tmp_path / "own") == written(tmp_path / "theirs")
    _write_files(data.select("text"), f"file:{tmp_path}/own_rows")
    data.select("text").write.option("maxRecordsPerFile", 1).text(str(tmp_path / "their_rows"))
    assert written(tmp_path / "own_rows") == written(tmp_path / "their_rows")
    _write_files(data.limit(0), str(tmp_path / "none"), "doc_id")
    assert (tmp_path / "none").is_dir()

    many = spark.range(20_000).selectExpr("id AS doc_id", "'text' AS text").repartition(4, "doc_id")
    begun = time.monotonic()
    _write_files(many, str(tmp_path / "many"), "doc_id")
    assert time.monotonic() - begun < 20  # starting programs for the modes of the files took minutes
    assert len(list((tmp_path / "many").iterdir())) == 20_000
