"""Personal data: fixed patterns, and terms that give away whose data it is.

Information-theoretic sanitisation. A value that a pattern finds is a protected
entity. Words near its occurrences are weighed by how much they tell of it:
the pointwise mutual information of word and entity as a share of what knowing
the entity itself would tell, estimated from all places in the corpus. Words
that tell too much are generalised, or removed, wherever they occur.

Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm import spans
from doclake.llm.common import near_keys
from doclake.session import cut_lineage

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 8  # words on either side of an entity
REACH = 160  # characters that are searched for those words
CONTEXTS = 3  # different surroundings in which a word has to be met
GENERALISE = 0.80  # shares of the entity's information
REMOVE = 0.95
LEAST_LETTERS = 3
TRIMMED = ".,;:!?()[]{}<>\"'`*#|"
SPACE = r"[\x20\x09-\x0D]+"

# The base patterns. A run is tried at its first character only,
# or where the last match ended (\G), which finds the same matches without
# going through a long run again for each of its characters.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """Spans of the base kinds by start, then kind; matches that fail their test are left out."""
    has_digit = text.rlike("[0-9]")
    email = spans.find_if(F.contains(text, F.lit("@")), text, EMAIL, "email", 0)
    ip = F.filter(
        spans.find_if(has_digit & F.contains(text, F.lit(".")), text, IP, "ip", 1),
        lambda s: F.forall(
            F.split(s["value"], r"\."),
            # a part of any length: its digits without leading zeros
            lambda p: (F.length(F.ltrim(p, F.lit("0"))) < 3)
            | ((F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255")),
        ),
    )
    card = F.filter(
        spans.find_if(has_digit, text, CARD, "card", 2),
        lambda s: F.call_function("luhn_check", digits(s["value"])),
    )
    phone = F.filter(
        spans.find_if(F.contains(text, F.lit("+")), text, PHONE, "phone", 3),
        lambda s: F.length(digits(s["value"])).between(10, 15),
    )
    return F.array_sort(F.concat(email, ip, card, phone))


def term(word: Column) -> Column:
    """A word as it is counted: lower case, without punctuation around it."""
    return F.lower(F.btrim(word, F.lit(TRIMMED)))


def counts_as_term(word: Column) -> Column:
    return (F.length(word) >= LEAST_LETTERS) & word.rlike(r"\p{L}") & ~F.contains(word, F.lit("@"))


def disclosing_terms(
    found: DataFrame,
    contexts: int = CONTEXTS,
    generalise: float = GENERALISE,
) -> DataFrame:
    """``term, disclosure`` of the words that tell too much of some entity.

    ``found`` has ``_text`` and its ``_base`` spans. Windows are of whole words, at
    most `WINDOW` on either side and within `REACH` characters. Probabilities are shares of
    the corpus's word places: those within the windows of the entity, those of
    the word, those of the word within the windows. A word must be met in
    ``contexts`` different windows, so that copies of one text prove nothing.
    """
    near = found.filter(F.size("_base") > 0).select("_text", F.explode("_base").alias("s"))
    before = F.substring(
        F.col("_text"), F.greatest(F.col("s.start") - REACH, F.lit(0)) + 1, F.least(F.col("s.start"), F.lit(REACH))
    )
    after = F.substring(F.col("_text"), F.col("s.end") + 1, F.lit(REACH))
    # what is cut off at the edge of the reach is no word
    left = F.reverse(F.split(before, SPACE))
    left = F.slice(left, F.lit(1), F.least(F.lit(WINDOW), F.size(left) - (F.col("s.start") > REACH).cast("int")))
    right = F.split(after, SPACE)
    cut = F.length("_text") - F.col("s.end") > REACH
    right = F.slice(right, F.lit(1), F.least(F.lit(WINDOW), F.size(right) - cut.cast("int")))
    window = near.select(
        F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity"),
        F.transform(F.concat(left, right), term).alias("words"),
    ).select("entity", "words", F.xxhash64("words").alias("window"))
    places = window.groupBy("entity").agg(F.sum(F.size("words")).alias("entity_places"))
    met = (
        window.select("entity", "window", F.explode("words").alias("term"))
        .filter(counts_as_term(F.col("term")))
        .groupBy("entity", "term", "window")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("windows"))
        .filter(F.col("windows") >= contexts)
    )
    met = cut_lineage(met.join(places, "entity"))
    words = found.select(F.split("_text", SPACE).alias("_words"))
    total = words.agg(F.coalesce(F.sum(F.size("_words")), F.lit(0)).alias("places"))
    # counted by hash and combined before the shuffle: a row per word and task at most
    each = words.select(F.explode("_words").alias("_word")).select(F.xxhash64(term(F.col("_word"))).alias("_term"))
    counted = each.groupBy("_term").agg(F.count(F.lit(1)).alias("term_places"))
    n = total.first()[0]
    # information of the word about the entity, as a share of the entity's own
    share = 1 + F.log(F.least(F.lit(1.0), F.col("both") / F.col("term_places"))) / F.log(
        F.lit(float(max(n, 1))) / F.col("entity_places")
    )
    weighed = (
        met.withColumn("_term", F.xxhash64("term"))
        .join(counted, "_term")
        .filter(F.col("entity_places") < n)
        .select("term", share.alias("share"))
    )
    return (
        weighed.groupBy("term")
        .agg(F.max("share").alias("disclosure"))
        .filter(F.col("disclosure") >= generalise)
    )


def find_personal_data(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    contexts: int = CONTEXTS,
    generalise: float = GENERALISE,
) -> DataFrame:
    """``docs`` with ``pii_base`` and ``pii_spans``, arrays of spans by start, then kind.

    A null text counts as empty and has no spans. Rows stay apart by key and
    text, null keys among them; repeated rows all get their spans. A span of
    kind ``term`` has the disclosure of its word in ``value``.
    """
    kept = [c for c in docs.columns if c.lower() not in ("pii_base", "pii_spans")]
    # the caller's columns stay in one of their own, so that no name can clash
    rows = docs.select(F.struct(*kept).alias("_row"))
    own_text, own_key = F.col("_row").getField(text), F.col("_row").getField(key)
    rows = rows.select("_row", own_text.alias("_text"), F.xxhash64(F.coalesce(own_text, F.lit(""))).alias("_hash"))
    based = rows.withColumn("_base", base_spans(F.coalesce("_text", F.lit(""))))
    terms = cut_lineage(disclosing_terms(based, contexts, generalise))
    each = rows.select(own_key.alias("_key"), "_hash", F.explode(F.split("_text", SPACE)).alias("_word")).select(
        "_key", "_hash", term(F.col("_word")).alias("term")
    )
    # few texts hold such a word: only they are shuffled
    holds = near_keys(each, "term", terms, "term").distinct().join(terms, "term")
    holds = cut_lineage(
        holds.groupBy("_key", F.col("_hash").alias("_own")).agg(
            F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("_terms")
        )
    )
    same = own_key.eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_own"))
    concerned = near_keys(based, "_hash", holds, "_own").join(holds, same, "left")
    words = F.filter(
        spans.find(F.col("_text"), r"[^\x20\x09-\x0D]+", "term", 4),
        lambda w: F.map_contains_key("_terms", term(w["value"])),
    )
    free = F.filter(
        F.transform(words, _trimmed),
        lambda w: ~F.exists("_base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
    )
    added = F.when(F.col("_terms").isNotNull(), F.concat("_base", free)).otherwise(F.col("_base"))
    others = near_keys(based, "_hash", holds, "_own", "left_anti").withColumn("pii_spans", F.col("_base"))
    return (
        concerned.withColumn("pii_spans", F.array_sort(added))
        .select("_row", "_base", "pii_spans")
        .unionByName(others.select("_row", "_base", "pii_spans"))
        .select("_row.*", F.col("_base").alias("pii_base"), "pii_spans")
    )


def _trimmed(w: Column) -> Column:
    """The span of a word without the punctuation around it."""
    inner = F.ltrim(w["value"], F.lit(TRIMMED))
    start = w["start"] + F.length(w["value"]) - F.length(inner)
    return F.struct(
        start.alias("start"),
        w["rank"].alias("rank"),
        (start + F.length(F.rtrim(inner, F.lit(TRIMMED)))).alias("end"),
        w["kind"].alias("kind"),
        F.element_at("_terms", term(w["value"])).cast("string").alias("value"),
    )


def mark(span: Column) -> Column:
    """What stands in for a span: its kind, or nothing for a term that tells nearly all."""
    removed = (span["kind"] == "term") & (span["value"].cast("double") >= REMOVE)
    return F.when(removed, F.lit("")).otherwise(F.concat(F.lit("<"), span["kind"], F.lit(">")))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by its mark; a null text stays null."""
    found = find_personal_data(docs, key, text)
    return found.withColumn(text, spans.replaced(F.col(text), F.col("pii_spans"), mark)).select(*docs.columns)
