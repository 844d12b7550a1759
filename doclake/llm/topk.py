"""Exact top-k inner products by Fagin's threshold algorithm over sorted lists.

Candidates stay where they are stored. A task takes them in blocks and keeps, for
each dimension of a block, its rows sorted by that component; a query reads those
lists from its better end, scores every row it meets in full, and stops as soon
as no row it has not met can reach its k-th result, of this block and those
before it. Queries come in blocks of bounded bytes, one after the other; the best
k that the tasks have found are merged at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import stored
from doclake.session import scratch_path

K = 5
SCALE = 256
CANDIDATE_BLOCK = 16_384
QUERY_BYTES = 32 << 20  # of the queries that are sent to the tasks at one time
TASK_ROWS = 1 << 20  # candidates of one task
LEAST_TASKS = 16  # small tables still go to several tasks


def sorted_lists(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by ascending component and the components in that order, a column per dimension."""
    order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
    return order, np.take_along_axis(vectors, order, axis=0)


def threshold_top_k(
    query: np.ndarray,
    own: int,
    ids: np.ndarray,
    vectors: np.ndarray,
    lists: tuple[np.ndarray, np.ndarray],
    k: int,
    floor: int | None = None,
    several: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and scores of the k best rows whose id isn't ``own``; ties to the smaller id.

    Rows that score less than ``floor`` may be left out. ``several`` tells whether
    an id may have several rows.
    """
    order, values = lists
    n = len(ids)
    up, down = np.nonzero(query > 0)[0], np.nonzero(query < 0)[0]
    met = ids == own
    best_rows, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    step = max(8, n // 128)
    at = 0
    while True:
        end = min(n, at + step)
        rows = np.concatenate([order[n - end : n - at, up].ravel(), order[at:end, down].ravel()])
        if not len(up) and not len(down):
            rows = np.arange(n)  # every score is zero
            end = n
        rows = np.unique(rows)
        rows = rows[~met[rows]]
        met[rows] = True
        if len(rows):
            best_rows = np.concatenate([best_rows, rows])
            best = np.concatenate([best, vectors[rows] @ query])
            first = np.lexsort((ids[best_rows], -best))
            if several:  # an id counts once
                first = first[np.sort(np.unique(ids[best_rows[first]], return_index=True)[1])]
            best_rows, best = best_rows[first[:k]], best[first[:k]]
        if end == n or met.all():
            return best_rows, best
        bound = values[n - end, up] @ query[up] + values[end - 1, down] @ query[down]
        if (len(best) == k and best[-1] > bound) or (floor is not None and floor > bound):
            return best_rows, best
        at, step = end, 2 * step


def scaled(vector: str | Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, null unless all are finite numbers."""
    column = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(
        column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return F.when(~bad, F.transform(column, lambda x: F.floor(scale * x.cast("double"))))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    candidate_block: int = CANDIDATE_BLOCK,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``query_id, rank, <key>, score``: the k best other ids of each query.

    Vectors that are null or hold a null or non-finite component take no part,
    nor do rows without a key. Vectors of different widths aren't compared. An
    id that has several vectors counts once, by its best score; repeated rows
    change nothing. Scores are exact integers.
    """
    spark = vectors.sparkSession
    clean = (
        vectors.filter(F.col(key).isNotNull())
        .select(F.col(key).alias("id"), scaled(vector).alias("v"), is_query.alias("q"))
        .filter(F.col("v").isNotNull())
        .distinct()
    )
    table = stored(clean, "vectors")
    rows, asked, size = table.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("q"), 16 + 8 * F.size("v"))), F.lit(0)),
    ).first()
    tasks = max(LEAST_TASKS, -(-rows // TASK_ROWS))
    number = F.pmod(F.xxhash64("id", "v"), F.lit(tasks))
    placed = stored(table.select("id", "v", number.alias("part")).repartition(tasks, "part"), "candidates")
    blocks = -(-size // query_bytes) if asked else 0

    def block_of(number: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Ids and vectors of a block of queries, by width."""
        chosen = table.filter(F.col("q") & (F.pmod(F.xxhash64("id", "v", F.lit(1)), F.lit(blocks)) == number))
        return matrices(chosen.select("id", "v").toArrow().combine_chunks().to_batches())

    def search(queries) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = {w: [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(q[0]) for w, q in queries.items()}
            for part in in_blocks(batches, candidate_block):
                for width, (ids, held) in matrices(part).items():
                    if width not in queries:
                        continue
                    lists = sorted_lists(held)
                    several = len(np.unique(ids)) < len(ids)
                    best = found[width]
                    for i, (own, query) in enumerate(zip(*queries[width])):
                        floor = int(best[i][1][-1]) if len(best[i][1]) == k else None
                        at, scores = threshold_top_k(query, own, ids, held, lists, k, floor, several)
                        best[i] = merged(best[i], (ids[at], scores), k)
            for width, (keys, _) in queries.items():
                counts = [len(ids) for ids, _ in found[width]]
                if sum(counts):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(keys, counts)),
                            pa.array(np.concatenate([ids for ids, _ in found[width]])),
                            pa.array(np.concatenate([scores for _, scores in found[width]])),
                        ],
                        names=["query_id", "found", "score"],
                    )

        return run

    path = scratch_path(spark, "found")
    schema = "query_id long, found long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(blocks):
        queries = block_of(block)
        placed.select("id", "v").mapInArrow(search(queries), schema).write.mode("append").parquet(path)
    found = spark.read.schema(schema).parquet(path).groupBy("query_id", "found").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("found").alias(key), "score")
    )


def merged(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The k best of two lists of ids and scores, each id once by its best score."""
    ids, scores = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


def in_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches put together, or cut, to about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            held.append(batch.slice(start, rows))
            if sum(b.num_rows for b in held) >= rows:
                yield held
                held = []
    if held:
        yield held


def matrices(batches: list[pa.RecordBatch]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids, ascending, and vectors of the rows of each width."""
    out: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        sizes = batch["v"].value_lengths().to_numpy(zero_copy_only=False)
        flat = batch["v"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = batch["id"].to_numpy(zero_copy_only=False).astype(np.int64)
        for width in np.unique(sizes):
            chosen = sizes == width
            own = flat[np.repeat(chosen, sizes)].reshape(int(chosen.sum()), int(width))
            out.setdefault(int(width), []).append((ids[chosen], own))
    found = {}
    for width, parts in out.items():
        ids, rows = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(ids, kind="stable")
        found[width] = ids[order], rows[order]
    return found
