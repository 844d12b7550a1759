"""Documents of several sources mixed to target weights.

Words are added up per source. Each source gets a share of all words by its
weight, but no more than `MOST` times its own; what is over goes to the others
by weight until it fits. The share over the source's size is its rate of
repetition: a document comes floor(rate) times, and once more by a draw from its
own key, whose chance is the fraction.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import WORD_PATTERN, free_name, stored

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
ADDED = ("size", "source_size", "target", "copies", "taken")
EXACT = "decimal(38,0)"


def word_count(text: str | Column) -> Column:
    """Words between ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number from 0 to below 1, the same on every run; rows without a key draw by their text."""
    own = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), text, F.lit("")))
    return F.conv(F.substring(F.md5(own.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, their number from 0 by code points, null last.

    Sorted in ranges: a task numbers its own range, and one row a range tells
    where each starts.
    """
    by = F.col("source").asc_nulls_last()
    ranged = sources.repartitionByRange(by).sortWithinPartitions(by)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    own = Window.partitionBy("part").orderBy(by)
    placed = ranged.withColumn("place", F.row_number().over(own) - 1).join(starts, "part")
    return placed.select("source", "source_size", (F.col("place") + F.col("start")).alias("place"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` out of the columns ``source, size``.

    The level of words per weight rises as long as sources stop at their limit.
    Only sums over all sources reach the driver.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1)
    weighed = stored(
        numbered(per_source).select("source", "source_size", weight.cast("long").alias("weight")), "weighed"
    )
    limit = most * F.col("source_size").cast(EXACT)
    total, weight_sum = weighed.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
    ).first()
    words, open_weight = total, weight_sum
    while True:
        share = F.lit(Decimal(words)).cast("decimal(28,0)") * F.col("weight").cast("decimal(9,0)")
        full = share > F.lit(Decimal(open_weight)).cast("decimal(18,0)") * limit.cast("decimal(19,0)")
        at_limit, still_open = weighed.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(Decimal(0))),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if (total - int(at_limit), still_open) == (words, open_weight) or not still_open:
            break
        words, open_weight = total - int(at_limit), still_open
    fair = (F.col("weight") * F.lit(words)).cast("double") / F.lit(float(max(1, open_weight)))
    return weighed.select(
        "source", "source_size", F.when(full, limit.cast("double")).otherwise(fair).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``size`` is the number of words (null and empty texts: 0), ``copies`` how
    often the mix has the document, ``taken`` their product. Sources weigh
    ``weights`` in turn, by code points, a null source last. Rows with one key
    make the same draw, rows without one draw by their text; a source without
    words has the target 0 and none of its documents is taken. An empty table
    gives an empty one. Columns of the added names are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    sized = docs.select(
        F.col(source).alias("source"), word_count(text).alias("size")
    )
    found, of = free_name(docs, "_target"), free_name(docs, "_of")
    targets = source_targets(sized, weights, most).select(
        F.col("source").alias(of), F.struct("source_size", "target").alias(found)
    )
    rate = F.when(
        F.col(f"{found}.source_size") > 0,
        F.least(F.col(f"{found}.target") / F.col(f"{found}.source_size"), F.lit(float(most))),
    ).otherwise(0.0)
    copies = F.floor(rate) + (draw(F.col(key), F.col(text), seed) < rate - F.floor(rate)).cast("long")
    size = word_count(text)
    return docs.join(targets, F.col(source).eqNullSafe(F.col(of))).select(
        *kept,
        size.alias("size"),
        F.col(f"{found}.source_size").alias("source_size"),
        F.col(f"{found}.target").alias("target"),
        copies.alias("copies"),
        (size * copies).alias("taken"),
    )


def emitted(mix: DataFrame) -> DataFrame:
    """The mix itself: each document ``copies`` times, ``copy`` counting from 1."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mix.filter("copies > 0").select(*[c for c in mix.columns if c.lower() != "copy"], times.alias("copy"))
