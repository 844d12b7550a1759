import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from doclake.functions import text as txt
from doclake.operators.cleaning import clean_long_texts, filter_min_length, typed_clean, with_clean_text


def defined_clean(text):
    """The definition of a clean text in five plain steps."""
    kept = (text or "").replace("\xa0", " ")
    for pattern in (r"\s*32;\s*", r"\s+", r"[^\w\s.,;:!?\-]", r"\s+"):
        kept = re.sub(pattern, " ", kept)
    return kept.strip()


def test_clean_text_edges(values):
    cases = {
        None: "",
        "": "",
        "132; 5": "1 5",
        "PIB 32; 3": "PIB 3",
        "x32;y": "x y",
        "É – “ok” 10%": "É ok 10",
        "zero​width": "zero width",
        "a\xa0b": "a b",
        "a" + " " * 50_000 + "b": "a b",
    }
    assert values(txt.clean_text, list(cases)) == list(cases.values())


def test_clean_text_equals_definition_on_every_character(values):
    signs = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    got = values(txt.clean_text, [f"a{s}b" for s in signs])
    differ = [s for s, g in zip(signs, got) if g != defined_clean(f"a{s}b")]
    # Java 17 knows fewer characters than this Python does.
    newer = [s for s in differ if unicodedata.category(s)[0] in "LN"]
    assert differ == newer
    assert all(ord(s) > 0x7FF for s in differ)
    assert len(differ) < 6000


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\xa032;aé%_-.²½", max_size=30), min_size=1, max_size=40))
def test_clean_text_random(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    once = txt.clean_text("x")
    for row in rows.select("x", once.alias("y"), txt.clean_text(once).alias("z")).collect():
        assert row["y"] == defined_clean(row["x"])
        assert row["z"] == defined_clean(row["y"])


def test_cleaning_stays_in_the_jvm(spark):
    df = filter_min_length(with_clean_text(spark.createDataFrame([("x",)], "text_content string")))
    plan = plan_of(df)
    assert "Python" not in plan and "Exchange" not in plan


def test_min_length_is_strict(spark):
    df = spark.createDataFrame([("a" * 50,), ("b" * 51,)], "text_content string")
    assert [r["text_length"] for r in filter_min_length(with_clean_text(df)).collect()] == [51]


def test_long_texts_are_cleaned_once(spark):
    df = spark.createDataFrame([("%" + "a" * 50,), ("B" * 51,), (None,)], "text_content string")
    two_steps = filter_min_length(with_clean_text(df))
    one_step = clean_long_texts(df)
    assert one_step.collect() == two_steps.collect()
    assert plan_of(one_step).count("regexp_replace") == 2


def test_strip_and_collapse(values):
    assert values(txt.strip, ["\n a  b\x85 ", None]) == ["a  b", None]
    assert values(txt.collapse_space, [" a\t\n　b "]) == ["a b"]


def test_keyword_context(values):
    text = "x" * 300 + "PIB Construção subiu" + "y" * 900
    position = lambda c: txt.keyword_position(c, ["pib da construção", "pib constru"])
    assert values(position, [text, "nada", None]) == [300, -1, -1]
    window = lambda c: txt.keyword_context(c, position(c))
    assert values(window, [text, "nada", "PIB construção"]) == [text[100:900], None, "PIB construção"]


def test_truncate(values):
    long = "é" * 3000
    assert [len(v) for v in values(lambda c: txt.truncate_text(c, "embed"), [long])] == [2048]
    assert values(lambda c: txt.truncate_text(c, "chat_preview"), ["abc"]) == ["abc..."]


def test_removed_characters(values):
    removed = lambda c: txt.removed_characters(c, txt.clean_text(c))
    assert values(removed, ["a%b 32; c\U0001f600%"]) == [["%", "2", "3", ";", "\U0001f600"]]


def test_typed_clean(spark):
    df = spark.createDataFrame(
        [(1, " a ", "2024-05-01 10:00:00 "), (2, None, "bad")], "n int, s string, t string"
    )
    got = typed_clean(df, ["t", "absent"])
    assert dict(got.dtypes) == {"n": "int", "s": "string", "t": "timestamp"}
    rows = got.orderBy("n").select("s", F.col("t").cast("string")).collect()
    assert [tuple(r) for r in rows] == [("a", "2024-05-01 10:00:00"), (None, None)]
