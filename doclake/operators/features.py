"""Token counts, TF-IDF and text embeddings."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.constants import EMBEDDING_DIMS, TF_BUCKETS
from doclake.functions.text import clean_text, lower_trim
from doclake.functions.vectors import l2_normalise
from doclake.operators.models import BatchModel, embedding_model
from doclake.session import scratch_path

COMMON = 1000  # terms in at least one of so many documents are broadcast


def tokenize(df: DataFrame, text: str = "text_clean", target: str = "words") -> DataFrame:
    """Lower-case tokens between single white-space characters."""
    return Tokenizer(inputCol=text, outputCol=target).transform(df)


def hashing_tf(
    df: DataFrame,
    text: str = "text_clean",
    target: str = "raw_features",
    buckets: int = TF_BUCKETS,
    words: str | None = None,
) -> DataFrame:
    """Term counts in a fixed number of hash buckets; no shuffle.

    ``words`` names a token column that is already there.
    """
    counter = HashingTF(inputCol=words or "_words", outputCol=target, numFeatures=buckets)
    if words:
        return counter.transform(df)
    return counter.transform(tokenize(df, text, "_words")).drop("_words")


def idf_weights(df: DataFrame, counts: str, target: str = "tfidf_features") -> DataFrame:
    """Term counts that are already there weighted by ``ln((N + 1) / (df + 1))``."""
    return IDF(inputCol=counts, outputCol=target).fit(df.select(counts)).transform(df)


def tf_idf(
    df: DataFrame,
    text: str = "text_clean",
    target: str = "tfidf_features",
    buckets: int = TF_BUCKETS,
    words: str | None = None,
) -> DataFrame:
    """Hashed term counts weighted by ``ln((N + 1) / (df + 1))``.

    Fitting reads only the text column and merges one count per bucket, so
    the model is ``buckets`` numbers however large the corpus is.
    """
    counts = hashing_tf(df.select(words or text), text, "_tf", buckets, words)
    model = IDF(inputCol="_tf", outputCol=target).fit(counts)
    return model.transform(hashing_tf(df, text, "_tf", buckets, words)).drop("_tf")


def bucket_rows(df: DataFrame, key: str, vector: str, value: str = "weight") -> DataFrame:
    """The non-zero entries of an ML vector as ``key, bucket, value`` rows."""
    entries = F.filter(
        F.transform(
            vector_to_array(vector), lambda v, i: F.struct(i.alias("bucket"), v.alias(value))
        ),
        lambda e: e[value] != 0,
    )
    return df.select(key, F.inline(entries))


def _tokens(text: str) -> Column:
    """The tokens of ``tokenize`` for a clean text, as an expression.

    Exploded directly, it is evaluated once; a token column would be computed
    again for the filter that Spark infers below an explode.
    """
    return F.split(F.lower(F.col(text)), r"\s")


def term_counts(df: DataFrame, key: str, text: str = "text_clean") -> DataFrame:
    """``key, term, tf``: occurrences of each token in each document."""
    return (
        df.select(key, F.explode(_tokens(text)).alias("term"))
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def doc_frequency(df: DataFrame, text: str = "text_clean") -> DataFrame:
    """``term, df``: documents each token occurs in. Counted before the shuffle."""
    return (
        df.select(F.explode(F.array_distinct(_tokens(text))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def term_tf_idf(df: DataFrame, key: str, text: str = "text_clean") -> DataFrame:
    """``key, term, tf, df, tf_idf`` by token instead of by bucket.

    Texts are dealt by key, so that their terms are counted where they are, and
    the counts stored; the number of documents of a term is the number of its rows
    there. Terms in one document of ``COMMON`` or more are at most ``COMMON`` times
    the terms of an average document; they are broadcast, and only rows of the
    other terms are shuffled.
    """
    spark = df.sparkSession
    path, terms = scratch_path(spark, "terms"), scratch_path(spark, "frequency")
    term_counts(df.select(key, text).repartition(key), key, text).write.parquet(path)
    counts = spark.read.parquet(path)
    counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).write.parquet(terms)
    frequency = spark.read.parquet(terms)
    documents = df.select(F.lit(1)).count()
    common = F.col("df") * COMMON >= documents
    most = F.broadcast(frequency.filter(common))
    rest = counts.join(most, "term", "left_anti").join(frequency.filter(~common), "term")
    idf = F.log(F.lit(documents + 1.0) / (F.col("df") + 1))
    return counts.join(most, "term").unionByName(rest).select(
        key, "term", "tf", "df", (F.col("tf") * idf).alias("tf_idf")
    )


def embed_documents(
    df: DataFrame,
    text: str = "text_clean",
    target: str = "embedding",
    model: BatchModel | None = None,
    dims: int = EMBEDDING_DIMS,
    max_chars: int | None = None,
    words: str | None = None,
) -> DataFrame:
    """Add a unit-length ``array<float>`` for each text.

    Without a ``model`` the vector is the hashed term counts of the whole text
    at unit length, made inside the JVM. ``max_chars`` serves models that read
    only a prefix.
    """
    if model is None:
        if max_chars:
            df = df.withColumn("_text", F.substring(text, 1, max_chars))
            return embed_documents(df, "_text", target, dims=dims).drop("_text")
        counted = hashing_tf(df, text, "_tf", dims, words)
        unit = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(counted)
        return unit.withColumn(target, vector_to_array("_unit", "float32")).drop("_tf", "_unit")
    source = F.col(text) if max_chars is None else F.substring(text, 1, max_chars)
    vector = embedding_model(model)(source)
    # The model runs once per text, in a projection of its own.
    return (
        df.withColumn("_vector", vector)
        .withColumn(target, l2_normalise("_vector").cast("array<float>"))
        .drop("_vector")
    )


def embed_query(questions: DataFrame, text: str = "question", **options) -> DataFrame:
    """The same encoder over a table of questions, cleaned like the documents."""
    cleaned = questions.withColumn("_question", lower_trim(clean_text(text)))
    return embed_documents(cleaned, "_question", **options).drop("_question")
