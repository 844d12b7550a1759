"""Secrets: fixed patterns, and strings that look random rather than written.

Two Markov models of neighbouring characters, one of random strings and one of
ordinary words and identifiers, are learned from labelled samples: what the
patterns find is random, other words are ordinary. A long token is a secret when
the random model explains it better, by a log-likelihood ratio.

Everything here is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm import spans

KINDS = ("assign", "access", "hex", "random")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
LEAST_LENGTH = 12  # of a token that is weighed
LEAST_RATIO = 10.0  # nats for the whole token by which the random model must be better
LEAST_KINDS = 6  # different characters; a ruled line is no secret
SAMPLE_TEXTS = 3_000  # texts with ordinary words to learn from, about
UNIFORM_WEIGHT = 200.0  # of an even spread, in the random model

# The base patterns. A run is tried at its first character only.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_LENGTH},}}"
WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")


def base_spans(text: Column) -> Column:
    """Spans of the base kinds by start, then kind; matches that fail their test are left out."""
    lower = F.lower(text)
    named = F.lit(False)
    for word in WORDS:
        named = named | F.contains(lower, F.lit(word))
    assign = F.filter(
        spans.find_if(named, text, ASSIGN, "assign", 0, group=2), lambda s: F.length(s["value"]) >= 6
    )
    access = F.filter(
        spans.find_if(F.contains(text, F.lit("AKIA")), text, ACCESS, "access", 1),
        lambda s: s["end"] - s["start"] >= 20,
    )
    hexes = spans.find_if(text.rlike("[0-9a-f]{24}"), text, HEX, "hex", 2)
    return F.array_sort(F.concat(assign, access, hexes))


def pair_counts(tokens: DataFrame, column: str = "token") -> dict[tuple[str, str], int]:
    """How often one character of the alphabet follows another; at most its square of rows."""
    pairs = (
        tokens.filter(F.length(column) > 1)
        .select(
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.length(column) - 1),
                    lambda i: F.substring(F.col(column), i, F.lit(2)),
                )
            ).alias("pair")
        )
        .filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
    )
    return {(r["pair"][0], r["pair"][1]): r["n"] for r in pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect()}


def log_model(counts: dict[tuple[str, str], int], even: float) -> dict[tuple[str, str], float]:
    """log of the chance of each next character, smoothed towards an even spread."""
    out = {}
    for a in ALPHABET:
        total = sum(counts.get((a, b), 0) for b in ALPHABET)
        for b in ALPHABET:
            chance = (counts.get((a, b), 0) + even / len(ALPHABET)) / (total + even)
            out[a, b] = math.log(chance)
    return out


def fit(
    docs: DataFrame, text: str = "text", sample_texts: int = SAMPLE_TEXTS
) -> dict[tuple[str, str], float]:
    """Log-likelihood ratio of random against ordinary, by pair of characters.

    Random strings are those that the patterns find in any text. Ordinary words
    are those of about ``sample_texts`` texts, drawn by a hash of the text, in
    which the patterns find nothing. Without texts both models are even.
    """
    given = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("_text"))
    found = given.select(F.explode(base_spans(F.col("_text"))).alias("s")).select(F.col("s.value").alias("token"))
    random = pair_counts(found.distinct())
    n = given.count()
    share = int(1_000_000 * min(1.0, sample_texts / max(1, n)))
    drawn = given.filter(F.pmod(F.xxhash64("_text"), F.lit(1_000_000)) < share).distinct()
    words = drawn.filter(F.size(base_spans(F.col("_text"))) == 0).select(
        F.xxhash64("_text").alias("_of"), F.explode(F.split("_text", r"[^A-Za-z0-9+/_=-]+")).alias("token")
    )
    # what may be a secret itself counts only if it is in several texts
    long = words.filter(F.length("token") >= LEAST_LENGTH).groupBy("token")
    once = long.agg(F.min("_of").alias("x"), F.max("_of").alias("y")).filter("x = y")
    ordinary = pair_counts(words.join(once.select("token"), "token", "left_anti"))
    first, second = log_model(random, UNIFORM_WEIGHT), log_model(ordinary, 1.0)
    return {pair: first[pair] - second[pair] for pair in first}


def log_ratio(token: Column, model: dict[tuple[str, str], float]) -> Column:
    """Sum of the model's values over the token's pairs of characters.

    The model is a constant array of ``len(ALPHABET)**2`` numbers, and a pair's
    place in it follows from the places of its characters in the alphabet.
    """
    n = len(ALPHABET)
    values = F.split(F.lit(",".join(f"{model[a, b]:.3f}" for a in ALPHABET for b in ALPHABET)), ",").cast("array<double>")
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1))) - 1
    return F.aggregate(
        F.sequence(F.lit(1), F.length(token) - 1),
        F.lit(0.0),
        lambda total, i: total + F.get(values, place(i) * n + place(i + 1)),
    )


def find_secrets(
    docs: DataFrame, model: dict[tuple[str, str], float], text: str = "text", least_ratio: float = LEAST_RATIO
) -> DataFrame:
    """``docs`` with ``secret_base`` and ``secret_spans``, arrays of spans by start, then kind.

    Spans of kind ``random`` are long tokens outside the base spans that the
    random model explains better. A null text counts as empty. Columns of these
    names are replaced; repeated rows and null keys stay rows of their own.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    based = docs.drop("secret_base", "secret_spans").withColumn("secret_base", base_spans(whole))
    long_tokens = spans.find_if(
        whole.rlike(rf"[A-Za-z0-9+/_=-]{{{LEAST_LENGTH}}}"), whole, TOKEN, "random", 3
    )
    weighed = F.filter(
        long_tokens,
        lambda s: ~F.exists("secret_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        & (F.size(F.array_distinct(F.split(s["value"], ""))) >= LEAST_KINDS)
        & (log_ratio(s["value"], model) >= least_ratio),
    )
    return based.withColumn("secret_spans", F.array_sort(F.concat("secret_base", weighed)))
