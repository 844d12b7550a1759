"""What the operators share: slices of Arrow batches, hashes, small joins, components."""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.session import cut_lineage, scratch_path

SLICE_ROWS = 512
SLICE_CHARS = 4_000_000
KEY_BUCKETS = 1 << 18  # the bound of what `near_keys` broadcasts
FEW_EDGES = 1 << 18  # a graph of up to so many, 4 MB, needs no rounds of joins to find its components
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str) -> str:
    """A public vocabulary file as installed on the machine that runs the task."""
    import public_tokenizers

    return public_tokenizers.path(name)


def one_thread() -> None:
    """A task has one core; tokenizers must not start a thread for each of the machine's."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


def slices(
    batches: Iterator[pa.RecordBatch],
    text: str = "text",
    rows: int = SLICE_ROWS,
    chars: int = SLICE_CHARS,
) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, of bounded rows and bytes of ``text`` (a longer text is alone)."""
    for batch in batches:
        sizes = np.array(
            [0 if n is None else n for n in pa.compute.binary_length(batch[text]).to_pylist()],
            dtype=np.int64,
        )
        start = 0
        while start < batch.num_rows:
            total = np.cumsum(sizes[start : start + rows])
            n = max(1, int(np.searchsorted(total, chars, side="right")))
            yield batch.slice(start, n)
            start += n


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column out of one numpy array per row."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def factorize(words: list) -> tuple[np.ndarray, list]:
    """The number of each word among the distinct ones, and those in order of first use.

    (pandas compares strings up to a zero character only.)
    """
    table = dict.fromkeys(words)
    for i, word in enumerate(table):
        table[word] = i
    return np.fromiter(map(table.__getitem__, words), dtype=np.int64, count=len(words)), list(table)


def hash_words(words: list) -> np.ndarray:
    """64-bit hashes, the same in every process."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    values = np.empty(len(words), dtype=object)
    values[:] = words
    return pd.util.hash_array(values, categorize=False)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of SplitMix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                              0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased (`bytes.lower` is ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words are one shingle, none are none."""
    n = len(words)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    if n < width:
        total = np.uint64(n)
        for k in range(n):
            total = mix(np.array([total ^ words[k]]) * ODD[k])[0]
        return np.array([total], dtype=np.uint64)
    total = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        total += mix(words[k : n - width + 1 + k] + ODD[k]) * ODD[k]
    return mix(total)


def text_shingles(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; words of all texts are hashed at once."""
    words = [lower_words(t) for t in texts]
    flat = hash_words([w for ws in words for w in ws])
    out, start = [], 0
    for ws in words:
        out.append(np.unique(shingle_hashes(flat[start : start + len(ws)], width)))
        start += len(ws)
    return out


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of a number as text, modulo ``divisor``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, ``name`` where possible."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns of the given names, which an operator needs itself, under
    free ones, and a function that gives them their names back."""
    wanted, moved = {n.lower() for n in names}, {}
    for c in df.columns:
        if c.lower() in wanted:
            moved[c] = free_name(df, f"{c}_given")
    back = {v: k for k, v in moved.items()}
    return df.withColumnsRenamed(moved), lambda out: out.withColumnsRenamed(back)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, which outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def removed(*tables: DataFrame) -> None:
    """Remove the files of tables made by `stored` that nothing reads any more, and the shuffle files of finished queries."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        swept(tables[0].sparkSession)


def swept(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished queries, which it does when their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_FIXED = {"Project", "Filter", "Relation", "LocalRelation", "LogicalRDD", "Range", "SubqueryAlias", "View"}


def in_fixed_order(df: DataFrame) -> DataFrame:
    """``df``, stored unless it is a plain reading of files or rows, so that every
    computation of it gives the same rows in the same order in the same tasks."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    names = [re.match(r"[\s:+|-]*([A-Za-z]+)", line) for line in plan.splitlines() if line.strip()]
    if all(n and n.group(1) in _FIXED for n in names) and "rand" not in plan:
        return df
    return stored(df, "fixed")


def near_keys(
    df: DataFrame, column: str | Column, keys: DataFrame, key: str | Column, how: str = "left_semi"
) -> DataFrame:
    """Rows of ``df`` whose key may be among ``keys``, found without a shuffle of ``df``.

    Keys are hashed to ``KEY_BUCKETS`` numbers and only the numbers in use are
    broadcast, so what is sent never exceeds that many rows, whatever the data.
    Some rows too many come through; an exact join has to follow. ``left_anti``
    gives the other rows, none of which has a key in ``keys``.
    """
    number = lambda c: F.pmod(F.xxhash64(c), F.lit(KEY_BUCKETS)).cast("int")
    bucket = free_name(df, "_bucket")
    used = keys.select(number(key).alias(bucket)).distinct()
    return df.withColumn(bucket, number(column)).join(F.broadcast(used), bucket, how).drop(bucket)


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``id, root`` of every id in ``edges``; root is the smallest id it is linked with.

    Large-star and small-star in turn: each id is tied to the smallest of its
    neighbours until nothing changes. A round is a minimum per key, which Spark
    combines before the shuffle, and a join on the same key, whose hot keys
    adaptive execution splits. Each round's edges replace those before it. Up to
    ``FEW_EDGES`` edges between long numbers are gone through by one task instead,
    since each round takes some ten small stages, whatever it holds.
    """
    pairs = cut_lineage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u > v")
        .distinct()
    )
    weight = _weigh(pairs)
    if not weight[0]:
        return pairs.select(F.col("u").alias("id"), F.col("v").alias("root"))
    if weight[0] <= FEW_EDGES and {f.dataType.typeName() for f in pairs.schema} == {"long"}:
        return pairs.coalesce(1).mapInArrow(_few_components, "id long, root long")
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_least, "u")
        small = (
            joined.select("u", F.col("m").alias("v"))
            .unionByName(joined.select(F.col("v").alias("u"), F.col("m").alias("v")))
            .filter("u > v")
            .distinct()
        )
        before, pairs = weight, cut_lineage(small)
        weight = _weigh(pairs)
        if weight == before:
            break
    else:
        raise RuntimeError("components did not settle")
    children = pairs.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return children.unionByName(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )


def _few_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, root`` out of ``u, v``: the larger of two roots that an edge ties gets the smaller one, until all are tied."""
    edges = [np.stack([b["u"].to_numpy(), b["v"].to_numpy()]) for b in batches if b.num_rows]
    if not edges:
        return
    ends = np.concatenate(edges, axis=1)
    ids, numbers = np.unique(ends, return_inverse=True)
    u, v = numbers.reshape(ends.shape)
    root = np.arange(len(ids))
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (further := root[root]).tobytes() != root.tobytes():
            root = further
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], names=["id", "root"])


def _weigh(pairs: DataFrame) -> tuple:
    """Number and checksums of the edges; equal edges weigh the same."""
    mixed = F.xxhash64("u", "v")
    return tuple(
        pairs.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.pmod(mixed, F.lit(1 << 31)))).first()
    )
