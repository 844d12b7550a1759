"""Quality classifier: naive Bayes features in a linear support vector machine.

n-gram indicators are scaled by the log-count ratio of the two classes, and a
hinge-loss model is fitted to them by dual coordinate descent. The model is
one weight for each of ``2**bits`` hashed n-grams, so its size is fixed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import list_array, mix, slices

BITS = 18
SAMPLE_ROWS = 6_000  # labelled rows to fit on at most, about; see `fit`
SAMPLE_BYTES = 256 << 20  # of their features, about
COST = 1.0
ROUNDS = 20
CUTOFF = 0.3

_WORD = re.compile(r"\S+")
_SEEDS = np.array([11, 13, 17, 19], dtype=np.uint64)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Sorted distinct hashes of a text's n-grams.

    Runs of one to three characters of the whole text, and marks for how common
    words are that repeat the one before them. A null or empty text has none.
    """
    if not text:
        return np.empty(0, dtype=np.uint32)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    one = chars + np.uint64(1)
    grams = [one * np.uint64(0x9E3779B97F4A7C15) + _SEEDS[0]]
    two = one[:-1] * np.uint64(1 << 21) + one[1:]
    grams.append(two * np.uint64(0x9E3779B97F4A7C15) + _SEEDS[1])
    if len(one) > 2:
        three = two[:-1] * np.uint64(1 << 21) + one[2:]
        grams.append(three * np.uint64(0x9E3779B97F4A7C15) + _SEEDS[2])
    words = _WORD.findall(text)
    if len(words) > 1:
        again = sum(a == b for a, b in zip(words, words[1:]))
        # one mark for each doubling of their share
        level = int(np.log2(1 + 64 * again / len(words)))
        marks = np.arange(1, level + 1, dtype=np.uint64)
        grams.append(marks * np.uint64(0xC2B2AE3D27D4EB4F) + _SEEDS[3])
    return np.unique((mix(np.concatenate(grams)) >> np.uint64(64 - bits)).astype(np.uint32))


@dataclass
class Model:
    """Weights by hashed n-gram, the bias, and the line from margins to probabilities."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int

    def margin(self, text: str | None) -> float:
        found = features(text, self.bits)
        scale = 1.0 / np.sqrt(len(found)) if len(found) else 0.0
        return float(self.weights[found].sum(dtype=np.float64) * scale + self.bias)

    def score(self, text: str | None) -> float:
        value = self.slope * self.margin(text) + self.shift
        return float(1.0 / (1.0 + np.exp(-np.clip(value, -500, 500))))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, bits: int) -> np.ndarray:
    """log of how much more common each indicator is among rows of label 1, smoothed by one."""
    counts = np.ones((2, 1 << bits))
    for found, label in zip(rows, labels):
        counts[label, found] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], ratio: np.ndarray, labels: np.ndarray, cost: float, rounds: int, seed: int = 0
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model over scaled indicators.

    One dual variable for each row, kept between 0 and its class's cost; the
    weights follow each change. Classes weigh alike however rare one is.
    """
    values = [(ratio[r] / np.sqrt(max(1, len(r)))).astype(np.float32) for r in rows]
    norms = np.array([float(v @ v) for v in values]) + 1.0
    sign = np.where(labels == 1, 1.0, -1.0)
    share = np.bincount(labels, minlength=2) / len(labels)
    bound = cost / (2 * np.maximum(share[labels], 1e-9))
    alpha = np.zeros(len(rows))
    weights, bias = np.zeros(len(ratio)), 0.0
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        largest = 0.0
        for i in order.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), bound[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return weights, bias


def probability_line(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins (Platt, by Newton steps)."""
    a, b = 1.0, 0.0
    positive, negative = labels.sum(), (1 - labels).sum()
    goal = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - goal) * margins).sum() + 1e-3 * a, (p - goal).sum()])
        h = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-6), float(b)


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS) -> Model:
    """The model of featurised rows; without both classes it gives each row the classes' share."""
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(1 << bits), 0.0, 1.0, float(np.log(share / (1 - share))), bits)
    # Margins for the curve come from rows that the weights have not seen.
    held = np.arange(len(rows)) % 4 == 3
    curve = None
    if held.any() and len(set(labels[~held].tolist())) == 2 and len(set(labels[held].tolist())) == 2:
        kept = [r for r, h in zip(rows, held) if not h]
        ratio = log_count_ratio(kept, labels[~held], bits)
        w, b = dual_coordinate_descent(kept, ratio, labels[~held], COST, ROUNDS)
        scaled = w * ratio
        margins = np.array(
            [scaled[r].sum() / np.sqrt(max(1, len(r))) + b for r, h in zip(rows, held) if h]
        )
        curve = probability_line(margins, labels[held])
    ratio = log_count_ratio(rows, labels, bits)
    w, b = dual_coordinate_descent(rows, ratio, labels, COST, ROUNDS)
    scaled = w * ratio
    if curve is None:
        margins = np.array([scaled[r].sum() / np.sqrt(max(1, len(r))) + b for r in rows])
        curve = probability_line(margins, labels)
    return Model(scaled.astype(np.float32), b, *curve, bits)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "quality",
    key: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
    bits: int = BITS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """A model of the texts whose key has a label of 0 or 1 in ``labels``.

    At most about ``sample_rows`` labels are taken, half of each class, by a
    hash of the key; only those are sent to the texts, and only their features
    reach the driver, at most about ``sample_bytes``: where texts are so long that
    there would be more, the hash takes fewer rows. Rows without a key or label are left out, repeated texts
    count once, a null text is an empty one.
    """
    given = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")
    )
    sizes = {r["_label"]: r["n"] for r in given.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("_key"), F.lit(1_000_000))
    wanted: Column = F.lit(False)
    for value, n in sizes.items():
        share = int(1_000_000 * min(1.0, sample_rows / 2 / n))
        wanted = wanted | ((F.col("_label") == value) & (draw < share))
    drawn = F.broadcast(given.filter(wanted).distinct())  # about `sample_rows` rows
    rows = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    ).join(drawn, "_key")
    # a text has three features a character at most, and no more than there are
    weight = F.least(3 * F.length("_text"), F.lit(1 << bits)).cast("long") * 4
    expected = rows.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    if expected > sample_bytes:
        share = int(1_000_000 * sample_bytes / expected)
        rows = rows.filter(F.pmod(F.xxhash64("_key", F.lit("bytes")), F.lit(1_000_000)) < share)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = [features(t, bits) for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["_label"], list_array([f.astype(np.int32) for f in found], pa.int32())],
                names=["label", "found"],
            )

    sample = rows.select("_label", "_text").mapInArrow(featurise, "label int, found array<int>")
    table = sample.distinct().orderBy(F.xxhash64("found"), "label").toArrow()
    found = [np.asarray(x.values, dtype=np.int32) for x in table["found"]]
    return fit_rows(found, table["label"].to_numpy(), bits)


def score(df: DataFrame, model: Model, text: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """``df`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    Columns of these names are replaced. Null and empty texts have no n-gram
    and get the score of the bias.
    """
    kept = [c for c in df.columns if c not in ("score", "predicted")]
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            value = np.array([shared.value.score(t) for t in batch[text].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in kept]
                + [pa.array(value, pa.float64()), pa.array((value >= cutoff).astype(np.int32))],
                names=kept + ["score", "predicted"],
            )

    return df.select(*kept).mapInArrow(run, f"{fields}, score double, predicted int")
