"""A topic model trained by a group of workers in step: mini-batches, epochs, shared gradients.

Each epoch is one barrier stage over the stored features. A hash of the key and
the epoch deals rows to global mini-batches, whatever the number of workers; each
worker has a run of successive mini-batches. Steps follow one another, so workers
take turns: one streams its rows and makes its steps, then all gather the weights
that it reached, and the next goes on from there. A gather takes about a second in
Spark whatever it carries, so their number is that of the workers, not of the
steps. What a worker holds is a mini-batch and the weights. If one is lost, Spark
runs the stage again from the weights that the epoch began with.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.constants import TF_BUCKETS, TOPICS
from doclake.operators.training import SEED, decode_labels, encode_labels
from doclake.session import scratch_path

EPOCHS = 3
BATCH_ROWS = 64
RATE = 0.05
DECAY = 0.01
MOMENTS = (0.9, 0.999)


@dataclass
class TrainedTopics:
    """Feature stages and ``weights``, a row per label with the bias last; ``losses`` by epoch."""

    stages: PipelineModel
    weights: np.ndarray
    labels: Sequence[str]
    text: str
    losses: list[float] = field(default_factory=list)

    def predict(self, data: DataFrame, target: str = "predicted_topic") -> DataFrame:
        """Add the predicted topic; the label of a lower number wins a tie."""
        columns = [c for c in data.columns if c != target]
        features = vector_to_array("features")
        scores = [
            F.aggregate(
                F.zip_with(features, F.lit([float(x) for x in row[:-1]]), lambda x, w: x * w), F.lit(float(row[-1])),
                lambda total, x: total + x,
            )
            for row in self.weights
        ]
        # a null text counts as empty and stays null
        given = data.withColumn("_given", F.col(self.text)).withColumn(self.text, F.coalesce(self.text, F.lit("")))
        scored = self.stages.transform(given).withColumn("_scores", F.array(*scores))
        place = F.array_position("_scores", F.array_max("_scores")) - 1
        kept = [F.col("_given").alias(c) if c == self.text else F.col(c) for c in columns]
        return scored.select(*kept, decode_labels(place, self.labels).alias(target))

    def save(self, spark: SparkSession, path: str) -> None:
        self.stages.write().overwrite().save(f"{path}/stages")
        rows = [(i, name, [float(x) for x in w]) for i, (name, w) in enumerate(zip(self.labels, self.weights))]
        table = spark.createDataFrame(rows, "place int, label string, weights array<double>")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")


def feature_stages(text: str, words: str = "_words", counts: str = "_tf", weighted: str = "_tfidf") -> list:
    return [
        Tokenizer(inputCol=text, outputCol=words),
        HashingTF(inputCol=words, outputCol=counts, numFeatures=TF_BUCKETS),
        IDF(inputCol=counts, outputCol=weighted),
        Normalizer(inputCol=weighted, outputCol="features"),
    ]


def stored_features(
    data: DataFrame, labels: Sequence[str], key: str, text: str, label: str
) -> tuple[PipelineModel, DataFrame]:
    """The fitted stages, and ``key, label, features`` as a table; texts are counted once."""
    spark = data.sparkSession
    tokens, counts, idf, unit = feature_stages(text)
    rows = data.select(
        F.col(key).alias("key"), encode_labels(label, labels).alias("label"), F.coalesce(text, F.lit("")).alias(text)
    )
    path = scratch_path(spark, "counts")
    counts.transform(tokens.transform(rows)).select("key", "label", "_tf").write.parquet(path)
    counted = spark.read.parquet(path)
    if counted.isEmpty():
        raise ValueError("there are no rows to train on")
    weigh = idf.fit(counted)
    features = scratch_path(spark, "features")
    unit.transform(weigh.transform(counted)).select("key", "label", "features").write.parquet(features)
    return PipelineModel([tokens, counts, weigh, unit]), spark.read.parquet(features)


@dataclass
class _State:
    """Weights and the moments of their gradients (Adam, with decay beside the gradient)."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: int = 0

    def update(self, gradient: np.ndarray, rate: float, decay: float) -> None:
        self.steps += 1
        a, b = MOMENTS
        self.first = a * self.first + (1 - a) * gradient
        self.second = b * self.second + (1 - b) * gradient**2
        step = (self.first / (1 - a**self.steps)) / (np.sqrt(self.second / (1 - b**self.steps)) + 1e-8)
        kept = self.weights.copy()
        kept[:, -1] = 0.0  # the bias doesn't decay
        self.weights = self.weights - rate * (step + decay * kept)


def gradient_sums(weights: np.ndarray, features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Sums over rows of the gradient of the cross-entropy, and of the loss."""
    rows = np.hstack([features, np.ones((len(features), 1))])
    scores = rows @ weights.T
    scores -= scores.max(axis=1, keepdims=True, initial=-np.inf) if len(rows) else 0.0
    shares = np.exp(scores)
    total = shares.sum(axis=1, keepdims=True)
    own = np.arange(len(rows)), labels
    loss = float((np.log(total[:, 0]) - scores[own]).sum()) if len(rows) else 0.0
    shares /= total
    shares[own] -= 1.0
    return shares.T @ rows, loss


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of each mini-batch in turn, out of rows in the order of ``step``."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        steps = batch["step"].to_numpy()
        features = batch["features"].flatten().to_numpy().reshape(batch.num_rows, -1)
        marks = batch["label"].to_numpy().astype(np.int64)
        starts = np.flatnonzero(np.diff(steps, prepend=steps[0] - 1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            if held and steps[start] != now:  # all rows of the step before are here
                yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
                held = []
            now = steps[start]
            held.append((features[start:end], marks[start:end]))
    if held:
        yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])


def train_in_step(
    data: DataFrame,
    labels: Sequence[str] = TOPICS,
    key: str = "file_name",
    text: str = "text_clean",
    label: str = "topic",
    epochs: int = EPOCHS,
    batch_rows: int = BATCH_ROWS,
    workers: int | None = None,
    rate: float = RATE,
    decay: float = DECAY,
    seed: int = SEED,
) -> TrainedTopics:
    """A multi-class model over hashed TF-IDF at unit length, trained on all rows.

    ``workers`` tasks have to run at one time. The result is the same for any
    number of them, up to the order in which rows are added. Rows of one
    key share their mini-batches; null texts count as empty ones. No rows are an error.
    """
    spark = data.sparkSession
    workers = workers or spark.sparkContext.defaultParallelism
    stages, features = stored_features(data, labels, key, text, label)
    rows = features.count()
    number = max(1, -(-rows // batch_rows))
    shape = (len(labels), TF_BUCKETS + 1)
    state = _State(np.zeros(shape), np.zeros(shape), np.zeros(shape))
    losses = []
    for epoch in range(epochs):
        dealt = features.select(
            F.pmod(F.xxhash64("key", F.lit(seed), F.lit(epoch)), F.lit(number)).alias("step"),
            F.col("label"),
            vector_to_array("features").alias("features"),
            "key",
        )
        # step k of n goes to worker k * workers / n
        turn = F.floor(F.col("step") * workers / number).cast("int")
        ordered = dealt.repartitionById(workers, turn).sortWithinPartitions("step", "key").drop("key")
        start = spark.sparkContext.broadcast(state)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group = BarrierTaskContext.get()
            own = start.value
            lost = 0.0
            for turn in range(workers):
                sent = b""
                if turn == group.partitionId():
                    for features, marks in _steps(batches):
                        gradient, loss = gradient_sums(own.weights, features, marks)
                        lost += loss
                        own.update(gradient / len(marks), rate, decay)
                    parts = (own.weights, own.first, own.second)
                    sent = np.concatenate([*(p.ravel() for p in parts), [own.steps, lost]]).tobytes()
                gathered = group.allGather(base64.b64encode(sent).decode())[turn]
                values = np.frombuffer(base64.b64decode(gathered))
                weights, first, second = values[:-2].reshape(3, *shape)
                own, lost = _State(weights, first, second, int(values[-2])), values[-1]
            if group.partitionId() == 0:
                parts = [own.weights, own.first, own.second]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p.ravel().tolist() for p in parts], pa.list_(pa.float64())),
                     pa.array(range(3), pa.int32()), pa.array([own.steps] * 3, pa.int32()), pa.array([float(lost)] * 3)],
                    names=["values", "part", "steps", "loss"],
                )

        done = ordered.mapInArrow(run, "values array<double>, part int, steps int, loss double", barrier=True)
        found = sorted(done.collect(), key=lambda r: r["part"])  # three matrices of a fixed size
        weights, first, second = (np.array(r["values"]).reshape(shape) for r in found)
        state = _State(weights, first, second, found[0]["steps"])
        losses.append(found[0]["loss"] / max(1, rows))
    return TrainedTopics(stages, state.weights, list(labels), text, losses)


def load_topics(spark: SparkSession, path: str, text: str = "text_clean") -> TrainedTopics:
    rows = spark.read.parquet(f"{path}/weights").orderBy("place").collect()
    weights = np.array([r["weights"] for r in rows])
    return TrainedTopics(PipelineModel.load(f"{path}/stages"), weights, [r["label"] for r in rows], text)
