"""Exact vector search in Arrow blocks, without pairing rows in Spark.

Questions go through in blocks of bounded bytes, one after the other, while the
documents stay where they are: each task scores a block of document vectors with
one matrix product and keeps its own best ``k`` per question. Only those few
rows are shuffled. One block or many take the same way.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from doclake.constants import DEFAULT_TOP_K
from doclake.session import scratch_path

# Bytes of question keys and vectors that are sent to the tasks at one time.
BLOCK_BYTES = 64 << 20
# Scores a task holds at one time (32 MB).
MAX_SCORES = 4_000_000
SCORE_DIGITS = 6


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """An ``n x dims`` matrix from a list column; mixed widths are an error."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != dims).any():
        raise ValueError(
            f"vectors of {int(lengths[lengths != dims][0])} dimensions meet questions of {dims}"
        )
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _cosines(documents: np.ndarray, questions: np.ndarray) -> np.ndarray:
    """Rounded cosines; where a vector holds a number that is not finite, minus infinity."""
    with np.errstate(all="ignore"):
        lengths = np.outer(np.linalg.norm(documents, axis=1), np.linalg.norm(questions, axis=1))
        scores = np.round((documents @ questions.T) / (lengths + 1e-9), SCORE_DIGITS) + 0.0
    return np.where(np.isfinite(scores), scores, -np.inf)


class Best:
    """The best ``k`` documents per question seen by one task."""

    def __init__(self, questions: np.ndarray, k: int):
        self.questions = questions
        self.k = k
        self.kept: list[list[tuple]] = [[] for _ in range(len(questions))]
        self.floor = np.full(len(questions), -np.inf)

    def add(self, keys: list, documents: np.ndarray, asked: np.ndarray | None = None) -> None:
        """Score documents for all questions, or those with the numbers ``asked``."""
        step = max(1, MAX_SCORES // max(1, len(keys)))
        asked = np.arange(len(self.questions)) if asked is None else asked
        for part in (asked[i : i + step] for i in range(0, len(asked), step)):
            scores = _cosines(documents, self.questions[part])
            floor = self.floor[part]
            if len(keys) > self.k:
                place = len(keys) - self.k
                floor = np.maximum(floor, np.partition(scores, place, axis=0)[place])
            rows, numbers = np.nonzero((scores >= floor) & (scores > -np.inf))
            found: dict[int, list[tuple]] = {}
            for row, number in zip(rows.tolist(), numbers.tolist()):
                found.setdefault(int(part[number]), []).append((-scores[row, number], keys[row]))
            for number, more in found.items():
                kept = self.kept[number] = heapq.nsmallest(self.k, self.kept[number] + more)
                if len(kept) == self.k:
                    self.floor[number] = -kept[-1][0]

    def rows(self, question_keys: list) -> Iterator[tuple]:
        for key, kept in zip(question_keys, self.kept):
            for score, document in kept:
                yield key, document, float(-score)


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, vector).filter(F.col(vector).isNotNull())


def question_blocks(
    questions: DataFrame, key: str, vector: str
) -> Iterator[tuple[list, np.ndarray]]:
    """Keys and matrix of each block. Questions are stored, so that they are made only once, and
    weighed with their keys before any is fetched."""
    path = scratch_path(questions.sparkSession, "questions")
    _vectors(questions, key, vector).write.parquet(path)
    questions = questions.sparkSession.read.parquet(path)
    size = F.octet_length(F.col(key).cast("string")) + 64 + 8 * F.size(vector)
    weight, widest, narrowest = questions.agg(
        F.sum(F.coalesce(size, F.lit(64))), F.max(F.size(vector)), F.min(F.size(vector))
    ).first()
    if widest != narrowest:
        raise ValueError(f"question vectors have {narrowest} to {widest} dimensions")
    blocks = -(-(weight or 0) // BLOCK_BYTES)
    number = F.pmod(F.xxhash64(key, vector), F.lit(max(1, blocks)))
    for block in range(blocks):
        table = questions.filter(number == block).orderBy(key).toArrow()
        if table.num_rows:
            yield table.column(0).to_pylist(), matrix(table.column(1).combine_chunks(), widest)


def _in_turn(
    documents: DataFrame,
    blocks: Iterator[tuple[list, np.ndarray]],
    score: Callable[[list, np.ndarray], Callable],
    result: StructType,
) -> DataFrame:
    """Rows of all blocks of questions over the same documents, stored block by block."""
    spark = documents.sparkSession
    path = scratch_path(spark, "scores")
    spark.createDataFrame([], result).write.parquet(path)
    for names, block in blocks:
        documents.mapInArrow(score(names, block), result).write.mode("append").parquet(path)
    return spark.read.schema(result).parquet(path)


def _result_schema(documents: DataFrame, questions: DataFrame, doc_key: str, question_key: str):
    return StructType(
        [
            StructField(question_key, questions.schema[question_key].dataType),
            StructField(doc_key, documents.schema[doc_key].dataType),
            StructField("score", DoubleType()),
        ]
    )


def to_batches(rows, schema: pa.Schema, size: int = 10_000):
    chunk: list[tuple] = []

    def batch():
        columns = list(zip(*chunk)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    for row in rows:
        chunk.append(row)
        if len(chunk) == size:
            yield batch()
            chunk.clear()
    yield batch()


def arrow_schema(result: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(result)


def _local_best(documents, questions, doc_key, question_key, vector, k) -> DataFrame:
    """The best ``k`` per question of each task."""
    documents = _vectors(documents, doc_key, vector)
    questions = _vectors(questions, question_key, vector)
    result = _result_schema(documents, questions, doc_key, question_key)
    schema = arrow_schema(result)

    def score(question_keys: list, asked: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(asked, k)
            for batch in batches:
                best.add(batch.column(0).to_pylist(), matrix(batch.column(1), asked.shape[1]))
            yield from to_batches(best.rows(question_keys), schema)

        return run

    return _in_turn(documents, question_blocks(questions, question_key, vector), score, result)


def score_documents(
    documents: DataFrame,
    questions: DataFrame,
    doc_key: str = "file_name",
    question_key: str = "question_id",
    vector: str = "embedding",
    least_score: float = -1.0,
) -> DataFrame:
    """``question, document, score`` of the pairs that score ``least_score`` or more.

    The default keeps all, so it is meant for few questions; a higher score
    bounds what leaves the tasks.
    """
    documents = _vectors(documents, doc_key, vector)
    questions = _vectors(questions, question_key, vector)
    result = _result_schema(documents, questions, doc_key, question_key)
    schema = arrow_schema(result)

    def score(question_keys: list, asked: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = matrix(batch.column(1), asked.shape[1])
                keys = batch.column(0).cast(schema.field(1).type)
                for number, question in enumerate(question_keys):
                    scores = _cosines(vectors, asked[number : number + 1])[:, 0]
                    rows = np.nonzero(scores >= least_score)[0]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(question, schema.field(0).type), len(rows)),
                            keys.take(pa.array(rows)),
                            pa.array(scores[rows]),
                        ],
                        schema=schema,
                    )

        return run

    return _in_turn(documents, question_blocks(questions, question_key, vector), score, result)


def topk_similar(
    documents: DataFrame,
    questions: DataFrame,
    k: int = DEFAULT_TOP_K,
    doc_key: str = "file_name",
    question_key: str = "question_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` most similar documents per question, best first.

    Scores are rounded before ranking and equal scores go to the lower key.
    Vectors with a number that is not finite are found by no question.
    """
    best = _local_best(documents, questions, doc_key, question_key, vector, k)
    order = Window.partitionBy(question_key).orderBy(F.desc("score"), F.asc(doc_key))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def classify_by_prototype(
    documents: DataFrame,
    prototypes: DataFrame,
    doc_key: str = "file_name",
    label_key: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """``document, label, score`` of the most similar prototype; ties to the lower label.

    A document whose vector holds a number that is not finite gets none.
    """
    docs = _vectors(documents, doc_key, vector)
    labels = _vectors(prototypes, label_key, vector)
    result = StructType(
        [
            StructField(doc_key, docs.schema[doc_key].dataType),
            StructField(label_key, labels.schema[label_key].dataType),
            StructField("score", DoubleType()),
        ]
    )
    schema = arrow_schema(result)

    def score(names: list, asked: np.ndarray):
        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, MAX_SCORES // len(names))
            for part in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
                scores = _cosines(matrix(part.column(1), asked.shape[1]), asked)
                place = scores.argmax(axis=1)
                best = scores[np.arange(len(place)), place]
                found = pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(schema.field(0).type),
                        pa.array([names[p] for p in place], schema.field(1).type),
                        pa.array(best, pa.float64()),
                    ],
                    schema=schema,
                )
                yield found.filter(pa.array(best > -np.inf))

        return nearest

    found = _in_turn(docs, question_blocks(labels, label_key, vector), score, result)
    # each block of prototypes has named its own best
    best = F.min(F.struct((-F.col("score")).alias("rank"), label_key))
    return found.groupBy(doc_key).agg(best.alias("_best")).select(
        doc_key, f"_best.{label_key}", (-F.col("_best.rank") + 0.0).alias("score")
    )
