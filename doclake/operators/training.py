"""Topic model training on Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.constants import TF_BUCKETS, TOPICS
from doclake.functions.text import col_of
from doclake.session import scratch_path

SEED = 42


def encode_labels(label: Column | str, labels: Sequence[str] = TOPICS) -> Column:
    """Place of a label in the list; a missing or unknown label is 0."""
    place = F.array_position(F.array(*[F.lit(name) for name in labels]), col_of(label)) - 1
    return F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)).cast("int")


def decode_labels(number: Column | str, labels: Sequence[str] = TOPICS) -> Column:
    return F.get(F.array(*[F.lit(name) for name in labels]), col_of(number).cast("int"))


def training_set(silver: DataFrame, gold: DataFrame, key: str = "file_name") -> DataFrame:
    """Clean texts with the topic of the same document; both must be present."""
    texts = silver.select(key, "text_clean").filter("text_clean is not null")
    topics = gold.select(key, "topic").filter("topic is not null")
    return texts.join(topics, key)


def hold_out(
    data: DataFrame, key: str = "file_name", percent: int = 20, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Rows to train on and rows to test with, by a hash of the key and the seed.

    The same row falls on the same side in every run, and so do its copies.
    """
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100
    return data.filter(draw >= percent), data.filter(draw < percent)


def train_topic_model(
    data: DataFrame,
    labels: Sequence[str] = TOPICS,
    text: str = "text_clean",
    label: str = "topic",
    rounds: int = 20,
) -> PipelineModel:
    """A multi-class classifier over hashed TF-IDF of the whole texts.

    Each round is one distributed pass; only coefficient sums reach the driver.
    """
    spark = data.sparkSession
    encoded = data.select(text, encode_labels(label, labels).cast("double").alias("label"))
    words = Tokenizer(inputCol=text, outputCol="_words")
    counts = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=TF_BUCKETS)
    # counted once: both fits read the stored counts
    path = scratch_path(spark, "counts")
    counts.transform(words.transform(encoded)).select("_tf", "label").write.parquet(path)
    counted = spark.read.parquet(path)
    idf = IDF(inputCol="_tf", outputCol="features").fit(counted)
    regression = LogisticRegression(maxIter=rounds, regParam=0.01, family="multinomial")
    return PipelineModel([words, counts, idf, regression.fit(idf.transform(counted))])


def predict_topics(
    model: PipelineModel, data: DataFrame, labels: Sequence[str] = TOPICS
) -> DataFrame:
    """Add the predicted topic and drop the model's working columns."""
    scored = model.transform(data).withColumn(
        "predicted_topic", decode_labels("prediction", labels)
    )
    return scored.drop("_words", "_tf", "features", "rawPrediction", "probability", "prediction")


def accuracy(
    model: PipelineModel,
    data: DataFrame,
    labels: Sequence[str] = TOPICS,
    label: str = "topic",
) -> float:
    """Share of rows with the right label; over held-out rows, the metric of a model."""
    scored = model.transform(
        data.withColumn("label", encode_labels(label, labels).cast("double"))
    )
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored)


def loss_per_round(model: PipelineModel) -> list[float]:
    """Loss before training and after each round."""
    return list(model.stages[-1].summary.objectiveHistory)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
