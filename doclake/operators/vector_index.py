"""A stored vector index that finds exactly what a full scan finds.

Vectors are stored by cell, with their distance to the cell's centre; a small
table holds the centres and radii. A search reads the cell nearest to each
question first. The score of its k-th result bounds how far away a better one can
lie, and by the triangle inequality whole cells, and within the others all
vectors much nearer to the centre or farther from it than the question, can't
reach it. What remains is scored in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from doclake.constants import DEFAULT_TOP_K
from doclake.operators.similarity import (
    SCORE_DIGITS,
    Best,
    arrow_schema,
    matrix,
    question_blocks,
    to_batches,
)
from doclake.session import scratch_path

MOST_CELLS = 4096  # bounds what the driver and each task hold of the centres
SAMPLE_ROWS = 50_000  # vectors, about, that the centres are fitted on
ROWS_A_FILE = 200_000
SHORT = 0.1  # vectors shorter than this lie in a cell of their own, which is always read
UNPLACED = -1
MARGIN = 4 * 10.0**-SCORE_DIGITS  # of a cosine, beyond rounding


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors at unit length, and their lengths; short ones become zero."""
    lengths = np.linalg.norm(vectors, axis=1)
    placed = lengths >= SHORT
    return np.where(placed[:, None], vectors / np.where(placed, lengths, 1.0)[:, None], 0.0), lengths


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * vectors @ centres.T
    return np.sqrt(np.maximum(squares, 0.0))


def fit_centres(
    vectors: DataFrame, vector: str, rows: int, sample_rows: int = SAMPLE_ROWS, seed: int = 42
) -> np.ndarray:
    """Centres of cells, as many as the root of ``rows``, from about ``sample_rows`` vectors drawn by hash. Every vector is stored, in one of them."""
    cells = min(MOST_CELLS, int(rows**0.5))
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda t, x: t + x.cast("double") * x))
    part = 1 << 30
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col(vector)), F.lit(part)) < part * min(1.0, sample_rows / max(1, rows))
    sample = vectors.filter(drawn).select(F.col(vector).alias("v"), length.alias("length")).filter(
        F.col("length") >= SHORT
    )
    unit = sample.select(
        array_to_vector(F.transform("v", lambda x: x.cast("double") / F.col("length"))).alias("features")
    )
    if unit.isEmpty():
        return np.zeros((0, 0))
    model = KMeans(k=max(2, cells), seed=seed, maxIter=8, initSteps=2).fit(unit)
    return np.array(model.clusterCenters())


@dataclass
class VectorIndex:
    """The index stored below ``path``; ``seen`` is filled by searches."""

    spark: SparkSession
    path: str
    key: str
    seen: dict | None = None

    @classmethod
    def build(
        cls,
        documents: DataFrame,
        path: str,
        doc_key: str = "file_name",
        vector: str = "embedding",
        centres: np.ndarray | None = None,
    ) -> "VectorIndex":
        """Store the vectors of ``documents`` by cell. Null vectors, and those with a number that
        is not finite, are found by no question and left out."""
        spark = documents.sparkSession
        finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        rows = documents.select(F.col(doc_key).alias("key"), F.col(vector).alias("v")).filter(finite)
        number, widest, narrowest = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.min(F.size("v"))).first()
        if widest != narrowest:
            raise ValueError(f"document vectors have {narrowest} to {widest} dimensions")
        if centres is None:
            centres = fit_centres(rows, "v", number)
        shared = spark.sparkContext.broadcast(centres)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = np.full(batch.num_rows, UNPLACED, dtype=np.int32)
                away = np.zeros(batch.num_rows)
                if batch.num_rows and len(shared.value):
                    unit, lengths = _unit(matrix(batch["v"], shared.value.shape[1]))
                    distance = _distances(unit, shared.value)
                    placed = lengths >= SHORT
                    cell = np.where(placed, distance.argmin(axis=1), UNPLACED).astype(np.int32)
                    away = np.where(placed, distance.min(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["v"], pa.array(cell), pa.array(away)], names=["key", "v", "cell", "away"]
                )

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        placed = rows.mapInArrow(place, f"{fields}, cell int, away double")
        placed.repartition("cell", F.pmod(F.xxhash64("key"), F.lit(max(1, number // ROWS_A_FILE)))).sortWithinPartitions(
            "cell", "away"
        ).write.partitionBy("cell").parquet(f"{path}/vectors")
        stored = cls._vectors_at(spark, path, rows.schema)
        around = stored.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("rows"))
        middle = spark.createDataFrame(
            [(i, [float(x) for x in c]) for i, c in enumerate(centres)], "cell int, centre array<double>"
        )
        around.join(middle, "cell", "left").coalesce(1).write.parquet(f"{path}/cells")
        return cls(spark, path, doc_key)

    @staticmethod
    def _vectors_at(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}, away double, cell int")
        return reader.parquet(f"{path}/vectors")

    def search(
        self,
        questions: DataFrame,
        k: int = DEFAULT_TOP_K,
        question_key: str = "question_id",
        vector: str = "embedding",
    ) -> DataFrame:
        """``question, document, score, rank``: the same rows as ``topk_similar`` over the same vectors."""
        cells = self.spark.read.parquet(f"{self.path}/cells").orderBy("cell").collect()
        self.seen = {"pairs": 0, "scored": 0}
        placed = [c for c in cells if c["cell"] != UNPLACED]
        always = [c for c in cells if c["cell"] == UNPLACED]
        numbers = np.array([c["cell"] for c in placed], dtype=np.int64)
        radius = np.array([c["radius"] for c in placed])
        rows = np.array([c["rows"] for c in placed], dtype=np.int64)
        centres = np.array([c["centre"] for c in placed])
        documents = self._vectors_at(self.spark, self.path) if cells else None
        name = self.key
        key_type = documents.schema["key"].dataType if cells else questions.schema[question_key].dataType
        result = StructType(
            [
                StructField(question_key, questions.schema[question_key].dataType),
                StructField(name, key_type),
                StructField("score", DoubleType()),
            ]
        )
        paths = [scratch_path(self.spark, "found")]
        self.spark.createDataFrame([], result).write.parquet(paths[0])
        for keys, block in question_blocks(questions, question_key, vector) if cells else []:
            if len(centres) and centres.shape[1] != block.shape[1]:
                raise ValueError(
                    f"vectors of {centres.shape[1]} dimensions meet questions of {block.shape[1]}"
                )
            unit, lengths = _unit(block)
            away = _distances(unit, centres) if len(centres) else np.zeros((len(keys), 0))
            known = np.isfinite(block).all(axis=1)
            # first the nearest cell, and what has no place
            visit = np.zeros(away.shape, dtype=bool)
            if len(centres):
                visit[np.arange(len(keys)), away.argmin(axis=1)] = True
            first = self._scan(documents, keys, block, visit, numbers, away, None, bool(always), k, result)
            paths.append(scratch_path(self.spark, "found"))
            first.write.parquet(paths[-1])
            # how far away a result can lie that is among the best k
            own = Window.partitionBy(question_key).orderBy(F.desc("score"))
            kth = (
                self.spark.read.schema(result).parquet(paths[-1])
                .withColumn("place", F.row_number().over(own))
                .filter(F.col("place") == k)
                .select(question_key, "score")
            )
            bounds = kth.toArrow()
            least = dict(zip(bounds[question_key].to_pylist(), bounds["score"].to_pylist()))
            reach = np.array([self._reach(least.get(key), size) for key, size in zip(keys, lengths)])
            more = (away - radius <= reach[:, None]) & ~visit & known[:, None]
            if more.any():
                rest = self._scan(documents, keys, block, more, numbers, away, reach, False, k, result)
                paths.append(scratch_path(self.spark, "found"))
                rest.write.parquet(paths[-1])
            self.seen["pairs"] += len(keys) * int(rows.sum() + sum(c["rows"] for c in always))
            self.seen["scored"] += int(((visit | more) * rows).sum() + len(keys) * sum(c["rows"] for c in always))
        order = Window.partitionBy(question_key).orderBy(F.desc("score"), F.asc(name))
        best = self.spark.read.schema(result).parquet(*paths).withColumn("rank", F.row_number().over(order))
        return best.filter(F.col("rank") <= k)

    @staticmethod
    def _reach(score: float | None, length: float) -> float:
        """The largest distance of unit vectors that may score as much."""
        if score is None or length < SHORT:
            return np.inf
        return float(np.sqrt(max(0.0, 2 - 2 * (score - MARGIN)))) + 1e-7

    def _scan(self, documents, keys, block, visit, numbers, away, reach, unplaced, k, result) -> DataFrame:
        """The best ``k`` of each question, by task, in the cells that it visits."""
        wanted = numbers[visit.any(axis=0)].tolist() + [UNPLACED] * unplaced
        column = {int(c): i for i, c in enumerate(numbers)}
        schema = arrow_schema(result)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(block, k)
            for batch in batches:
                cells = batch["cell"].to_numpy(zero_copy_only=False)
                names = batch["key"].to_pylist()
                vectors = matrix(batch["v"], block.shape[1])
                apart = batch["away"].to_numpy(zero_copy_only=False)
                for cell in np.unique(cells):
                    own = np.flatnonzero(cells == cell)
                    if cell == UNPLACED:
                        best.add([names[i] for i in own], vectors[own])
                        continue
                    asked = np.flatnonzero(visit[:, column[int(cell)]])
                    if reach is not None:
                        # those within reach of a question by their distance to the centre
                        near = np.abs(apart[own][:, None] - away[asked, column[int(cell)]]) <= reach[asked] + 1e-7
                        own, asked = own[near.any(axis=1)], asked[near.any(axis=0)]
                    if len(own) and len(asked):
                        best.add([names[i] for i in own], vectors[own], asked)
            yield from to_batches(best.rows(keys), schema)

        chosen = documents.filter(F.col("cell").isin(wanted)).select("key", "v", "cell", "away")
        return chosen.mapInArrow(run, result)

    def share(self) -> float:
        """The share of all pairs of vector and question in cells that the last search read."""
        return self.seen["scored"] / max(1, self.seen["pairs"])
