import random

import numpy as np
import pyarrow as pa
import pytest

from doclake.operators import barrier_training as training
from doclake.session import scratch_path

LABELS = ("a", "b", "c")
SCHEMA = "file_name string, text_clean string, topic string"


def rows(n=300, seed=1):
    rng = random.Random(seed)
    words = {"a": "alpha beta gamma", "b": "delta eps zeta", "c": "eta theta iota"}
    out = []
    for i in range(n):
        topic = rng.choice("abc")
        text = " ".join(rng.choice((words[topic] + " the of and").split()) for _ in range(rng.randint(5, 30)))
        out.append((f"f{i}", text, topic))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    data = spark.createDataFrame(rows() + [("null", None, "a"), ("unknown", "the of", None)] + [rows()[0]], SCHEMA)
    return data, training.train_in_step(data, LABELS, workers=3)


def test_any_number_of_workers_gives_the_same_weights(trained):
    data, model = trained
    for workers in (1, 2, 4):
        other = training.train_in_step(data.repartition(workers + 3), LABELS, workers=workers)
        assert np.abs(other.weights - model.weights).max() < 1e-10
        assert np.allclose(other.losses, model.losses, rtol=1e-10)


def test_loss_falls_and_held_out_rows_are_told_apart(spark, trained):
    _, model = trained
    assert len(model.losses) == 3 and model.losses[0] > model.losses[1] > model.losses[2]
    test = spark.createDataFrame(rows(200, 7), SCHEMA)
    found = model.predict(test).collect()
    assert sum(r["predicted_topic"] == r["topic"] for r in found) >= 195


def test_weights_equal_plain_numpy(spark, trained):
    data, model = trained
    stages, features = training.stored_features(data, LABELS, "file_name", "text_clean", "topic")
    from pyspark.sql import functions as F

    n = -(-features.count() // training.BATCH_ROWS)
    shape = model.weights.shape
    state = training._State(np.zeros(shape), np.zeros(shape), np.zeros(shape))
    for epoch in range(3):
        step = F.pmod(F.xxhash64("key", F.lit(training.SEED), F.lit(epoch)), F.lit(n))
        table = features.withColumn("step", step).collect()
        for k in range(n):
            own = [r for r in table if r["step"] == k]
            x = np.hstack([np.array([r["features"].toArray() for r in own]), np.ones((len(own), 1))])
            y = np.eye(3)[[r["label"] for r in own]]
            p = np.exp(x @ state.weights.T)
            p /= p.sum(axis=1, keepdims=True)
            state.update((p - y).T @ x / len(own), training.RATE, training.DECAY)
    assert np.abs(state.weights - model.weights).max() < 1e-9


def test_gathers_grow_with_the_workers_not_with_the_steps(spark):
    """A gather takes a second, whatever it carries: 40 steps in each of 3 epochs."""
    import time

    data = spark.createDataFrame(rows(320), SCHEMA)
    training.train_in_step(data.limit(8), LABELS, workers=2)  # starts the workers
    begun = time.monotonic()
    model = training.train_in_step(data, LABELS, workers=2, batch_rows=8)
    assert time.monotonic() - begun < 60
    assert model.losses[0] > model.losses[2]


def test_steps_across_batches_are_whole():
    steps = [0, 0, 2, 2, 2, 5]
    table = pa.table({"step": steps, "label": range(6), "features": [[float(i), 1.0] for i in range(6)]})
    for size in range(1, 7):
        found = [(x[:, 0].tolist(), y.tolist()) for x, y in training._steps(iter(table.to_batches(size)))]
        assert found == [([0, 1], [0, 1]), ([2, 3, 4], [2, 3, 4]), ([5], [5])]
    assert list(training._steps(iter([]))) == []


def test_saved_model_predicts_the_same(spark, trained):
    data, model = trained
    path = scratch_path(spark, "topics")
    model.save(spark, path)
    loaded = training.load_topics(spark, path)
    assert sorted(map(tuple, loaded.predict(data).collect()), key=str) == sorted(map(tuple, model.predict(data).collect()), key=str)


def test_no_rows(spark):
    with pytest.raises(ValueError):
        training.train_in_step(spark.createDataFrame([], SCHEMA), LABELS, workers=2)
