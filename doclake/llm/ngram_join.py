"""Self-join of texts on the Jaccard similarity of their word n-grams.

A size-aware, heavy-light join. Light sets are small: each enumerates its subsets
of the size that any partner must share with it, and partners meet at an equal
subset. Heavy sets are large: each scans the inverted lists of its prefix, the
first members in one global order of which partners must share one. The boundary
between them is the size at which the expected work of both is least.

Equal sets are one node. Members of one list are not paired with each other: each
meets the leader with which it shares most lists. Where a list still holds several
components, one member of each meets another leader, round by round, and only those
that are still apart then meet the others of their list that their signs allow.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import (
    ODD,
    components,
    list_array,
    mix,
    near_keys,
    removed,
    slices,
    stored,
    swept,
    text_shingles,
)

WIDTH = 4
PERCENT = 85
LARGEST_BOUNDARY = 24  # sizes up to here are counted to choose the boundary
CELLS = 1 << 22  # counters over which n-grams are counted to find frequent ones
CELL_BLOCK = 1 << 16
LEAST_YIELD = 10  # one pair of so many has to link for another round of leaders
LEAST_GAIN = 50  # and one link more for so many that are known
SHORT = 8  # members; all pairs of a list with no more are compared at once
FEW = 4  # members of a component in a list that meet the others before all do
SIGN_BITS = 512  # enough for texts of up to some 1500 n-grams


def least_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """Members that sets of n and m members share at least when they link."""
    return -(-percent * (n + m) // (100 + percent))


def partner_sizes(n: int, percent: int = PERCENT) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def subset_sizes(n: int, boundary: int, percent: int = PERCENT) -> list[int]:
    """Sizes of the subsets that a set of n members enumerates for its light partners."""
    return sorted({least_overlap(n, m, percent) for m in partner_sizes(n, percent) if 0 < m <= boundary})


def choose_boundary(sizes: dict[int, int], list_length: float, percent: int = PERCENT) -> int:
    """The boundary with the least work for sets of the given sizes (size: number of sets).

    A light set costs its subsets. A heavy one costs its prefix, each member of
    which brings a list of ``list_length``; so does a light one that may have a
    heavy partner.
    """

    def cost(boundary: int) -> float:
        total = 0.0
        for n, count in sizes.items():
            scan = prefix_length(n, percent) * (1 + list_length)
            if n > boundary:
                total += count * scan
                continue
            total += count * sum(comb(n, s) for s in subset_sizes(n, boundary, percent))
            if partner_sizes(n, percent)[-1] > boundary:
                total += count * scan
        return total

    return min(range(0, LARGEST_BOUNDARY), key=cost)


def node_of(members: np.ndarray) -> int:
    """One signed 64-bit number for a set, by which equal sets are found."""
    if not len(members):
        return 0
    total = mix(members + ODD[0]).sum(dtype=np.uint64) ^ np.uint64(len(members))
    return int(mix(np.array([total]))[0].astype(np.int64))


def cells(members: np.ndarray) -> np.ndarray:
    return (members & np.uint64(CELLS - 1)).astype(np.int64)


def set_keys(
    members: np.ndarray, boundary: int, late: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """The lists a set belongs to: subsets for light partners, prefix for heavy ones; and the
    place of each in the set's order.

    ``late`` is how frequent the n-grams of a cell are: the global order begins with the rarest.
    """
    n = len(members)
    out = []
    if n <= boundary:
        each = mix(members + ODD[2])
        whole = each.sum(dtype=np.uint64, keepdims=True)
        for size in subset_sizes(n, boundary, percent):
            if size == n:
                sums = whole
            else:
                left_out = np.array(list(itertools.combinations(range(n), n - size)))
                sums = whole - each[left_out].sum(axis=1, dtype=np.uint64)
            out.append(mix(mix(sums ^ ODD[3]) + np.uint64(size)))
        if partner_sizes(n, percent)[-1] <= boundary:
            keys = np.concatenate(out)
            return keys, np.zeros(len(keys), dtype=np.int32)
    subsets = sum(map(len, out))
    order = np.lexsort((members, late[cells(members)]))
    out.append(members[order[: prefix_length(n, percent)]])
    places = np.arange(len(out[-1]), dtype=np.int32)
    return np.concatenate(out), np.concatenate([np.zeros(subsets, dtype=np.int32), places])


def bitmap(members: np.ndarray) -> bytes:
    """Parity of the members that fall on each of at least twice as many bits."""
    bits = max(64, 1 << (2 * max(1, len(members)) - 1).bit_length())
    counts = np.bincount((mix(members ^ ODD[4]) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the members that are in one of two sets only."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) > len(y):
        x, y = y, x
    folded = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ folded).sum())


def sign(members: np.ndarray, bits: int = SIGN_BITS) -> np.ndarray:
    """Parity of the members that fall on each of ``bits`` bits, as 64-bit numbers."""
    counts = np.bincount((mix(members ^ ODD[4]) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def signs_allow(n: str, m: str, x: str, y: str, bits: int, percent: int = PERCENT) -> Column:
    """Whether sets of ``n`` and ``m`` members with the signs ``x`` and ``y`` may link; true without a sign.

    Two sets differ in as many members at least as their signs in bits.
    """
    apart = sum(
        (F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(bits // 64)), F.lit(0)
    )
    return F.coalesce((100 + percent) * apart <= (100 - percent) * (F.col(n) + F.col(m)), F.lit(True))


def overlap(a: bytes, b: bytes) -> tuple[int, int]:
    """Sizes of the intersection and the union of two stored sets."""
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common, len(x) + len(y) - common


def member_lists(parts: list[DataFrame], percent: int = PERCENT) -> DataFrame:
    """``key, n, node, at, b, m, bt``: the members of lists, see `linked_lists`, that aren't alone in theirs, with its leader.

    ``parts`` have no list in common. One after the other is dealt to the lists, so the
    disk holds one's shuffle files at a time.
    """
    # the smallest node, a hash, of a list is its leader; rows are sorted by their list alone, and a long
    # list is held on disk. A list of two with unlike sizes, as most lists of several are, can't link
    own, found = Window.partitionBy("key"), []
    for keyed in parts:
        led = keyed.select(
            "key", "n", "node", "at", F.min("node").over(own).alias("b"), F.min_by("n", "node").over(own).alias("m"),
            F.min_by("at", "node").over(own).alias("bt"), F.count(F.lit(1)).over(own).alias("rows"), F.min("n").over(own).alias("least"), F.max("n").over(own).alias("most"),
        )
        led = led.filter((F.col("node") != F.col("b")) & ((F.col("rows") > 2) | (100 * F.col("least") >= percent * F.col("most"))))
        found.append(stored(led.select("key", "n", "node", "at", "b", "m", "bt"), "lists"))
        swept(keyed.sparkSession)
    return reduce(DataFrame.unionByName, found)


def linked_lists(
    keyed: DataFrame,
    verified: Callable[[DataFrame, str], DataFrame],
    percent: int = PERCENT,
    known: DataFrame | None = None,
    *,
    signs: Callable[[], DataFrame],
    sign_bits: int = SIGN_BITS,
) -> DataFrame:
    """``id, root`` by all links between members of one list.

    ``keyed`` are the lists, rows ``key, n, node, at``; ``at`` is the place of the key
    in the set's own order (0 where it doesn't matter); or what `member_lists` made of
    such lists. ``verified`` tells by pairs
    ``a, b`` and a name which of them link; ``known`` are more links. ``signs`` gives,
    once the first pairs are verified, ``node, sign`` (see `sign`) of the nodes it knows.

    Each member first meets one leader, that with which it shares most lists. Where
    a list still holds several components, and isn't ``SHORT``, so that all of them meet at
    once, each component sends one member to meet another leader, round by round, as long as that links enough, then ``FEW`` members of each
    component meet the others'; only what is left meets all others of its list. Only
    pairs that their signs allow become rows. No
    pair that links within a list but across components is left out, and none is
    verified twice.
    """
    lists = keyed if "bt" in keyed.columns else member_lists([keyed], percent)
    # a leader is the smaller node of a pair
    shared = _may_link(lists, percent).groupBy("a", "b").agg(F.count(F.lit(1)).alias("lists"))
    tested = stored(
        shared.groupBy("b").agg(F.max(F.struct("lists", "a")).alias("x")).select(F.col("x.a").alias("a"), "b"), "pairs"
    )
    links = verified(tested, "first")
    if known is not None:
        links = links.unionByName(known)
    roots = stored(components(links), "roots")
    leaders = lists.select("key", F.col("m").alias("n"), F.col("b").alias("node"), F.col("bt").alias("at"))
    members = lists.select("key", "n", "node", "at").unionByName(leaders).distinct()
    members = stored(_with_partners(members, percent), "partners")
    removed(lists)
    opened = _open_lists(members, roots, "open")
    removed(members)
    if opened.isEmpty():
        return roots
    short, still = opened.filter(F.col("rows") <= SHORT), opened.filter(F.col("rows") > SHORT).drop("rows")
    signed = signs().select("node", "sign")

    def joined(more: DataFrame, name: str) -> DataFrame:
        """The roots with more links: what a component has is known by its root."""
        ties = roots.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
        return stored(components(ties.unionByName(more)), name)

    number, linked = 0, links.count()
    while not number or not still.isEmpty():
        number += 1
        order = F.xxhash64("node", F.lit(number))
        member = F.struct(order.alias("chance"), "node", "n", "at")
        sent = still
        if number == 1:
            # members with most links first: copies are often alike to one of them, if not to each other
            ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
            degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
            sent = still.join(degree, "node", "left")
            member = F.struct((-F.coalesce("degree", F.lit(0))).alias("degree"), order.alias("chance"), "node", "n", "at")
        sent = stored(sent.groupBy("key", "root").agg(F.min(member).alias("x")), f"sent-{number}")
        leader = sent.groupBy("key").agg(F.min(F.struct("x", "root")).alias("y")).select(
            "key", F.col("y.x.node").alias("b"), F.col("y.x.n").alias("m"), F.col("y.x.at").alias("bt"),
            F.col("y.root").alias("other"),
        )
        met = sent.select("key", "root", "x.node", "x.n", "x.at").join(leader, "key").filter("root <> other")
        met = _may_link(met, percent, "an", "bn")
        if number == 1:
            right = short.select(
                "key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("at").alias("bt"), F.col("root").alias("other")
            )
            across = short.join(right, "key").filter("root < other")
            met = met.unionByName(_may_link(across, percent, "an", "bn"))
        met = met.distinct().join(tested, ["a", "b"], "left_anti")
        allowed = (
            met.join(signed.select(F.col("node").alias("a"), F.col("sign").alias("x")), "a", "left")
            .join(signed.select(F.col("node").alias("b"), F.col("sign").alias("y")), "b", "left")
            .filter(signs_allow("an", "bn", "x", "y", sign_bits, percent))
        )
        fresh = stored(allowed.select("a", "b"), f"pairs-{number}")
        removed(sent)
        met_now = fresh.count()
        if not met_now:
            break
        more = verified(fresh, f"round-{number}")
        found = more.count()
        tested, linked = tested.unionByName(fresh), linked + found
        if found:
            roots = joined(more, f"roots-{number}")
            before, still = still, _open_lists(still.drop("root"), roots, f"open-{number}")
            removed(before)
        # the first round is also that of the short lists, and tells nothing of the others
        if number > 1 and (found * LEAST_YIELD < met_now or found * LEAST_GAIN < linked):
            break
    if still.isEmpty():
        return roots
    # sizes that may link are in one class or in neighbouring ones
    size_class = F.floor(F.log("n") / math.log(100 / percent) + 1e-9)
    order = Window.partitionBy("key", "root").orderBy(F.xxhash64("node", F.lit(0)), "node")
    for some in (True, False):
        sent = still
        if some:
            # a few members of each component first: what they link has not to meet all the others
            sent = still.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= FEW).drop("place")
        left = sent.withColumn("class", size_class).join(signed.withColumnRenamed("sign", "x"), "node", "left")
        right = left.select(
            "key", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class"),
            F.col("node").alias("b"), F.col("n").alias("m"), F.col("at").alias("bt"), F.col("root").alias("other"),
            F.col("x").alias("y"),
        )
        across = left.join(right, ["key", "class"]).filter("root < other")
        across = across.filter(signs_allow("n", "m", "x", "y", sign_bits, percent))
        name = "some" if some else "left"
        rest = stored(_may_link(across, percent).distinct().join(tested, ["a", "b"], "left_anti"), f"pairs-{name}")
        if not some:
            removed(still)
        if rest.isEmpty():
            continue
        more = verified(rest, name)
        tested = tested.unionByName(rest)
        if more.isEmpty():
            continue
        roots = joined(more, f"roots-{name}")
        if some:
            before, still = still, _open_lists(still.drop("root"), roots, f"open-{name}")
            removed(before)
            if still.isEmpty():
                break
    return roots


def _may_link(met: DataFrame, percent: int, n_of_a: str = "", n_of_b: str = "") -> DataFrame:
    """Pairs ``a < b`` out of ``node, n, at`` and ``b, m, bt`` that met in a list and may link by it,
    with their sizes where these have a name.

    Sets share nothing before the first list they have in common, so at most what
    comes from there on in either.
    """
    sizes = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    rest = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("bt"))
    places = (100 + percent) * rest >= percent * (F.col("n") + F.col("m"))
    ends = [F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")]
    if n_of_a:
        first = F.col("node") < F.col("b")
        ends += [F.when(first, F.col("n")).otherwise(F.col("m")).alias(n_of_a)]
        ends += [F.when(first, F.col("m")).otherwise(F.col("n")).alias(n_of_b)]
    return met.filter(sizes & places).select(*ends)


def _with_partners(members: DataFrame, percent: int) -> DataFrame:
    """The members that a list has with another one of a size with which they may link, the next in size, if any;
    ``rows`` is how many the list has."""
    order = Window.partitionBy("key").orderBy("n", "node")
    sized = members.select(
        "*", F.count(F.lit(1)).over(Window.partitionBy("key")).alias("rows"),
        F.lag("n").over(order).alias("less"), F.lead("n").over(order).alias("more"),
    )
    near = (100 * F.col("less") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("more"))
    return sized.filter(near).drop("less", "more")


def _open_lists(members: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """The members, with their ``root``, of the lists that hold several components."""
    rooted = members.join(roots.withColumnRenamed("id", "node"), "node", "left").select(
        *members.columns, F.coalesce("root", "node").alias("root")
    )
    several = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y")
    return stored(rooted.join(several.select("key"), "key"), name)


def link_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """``<key>, n_shingles, component_id`` of each row.

    Two texts link when their sets of ``width``-word shingles have a Jaccard
    similarity of ``percent`` or more. A text with fewer words has one shingle;
    one without words, or null, has none and links with nothing.
    ``component_id`` is the smallest key that can be reached by links, the row's
    own included. Rows of one key are one document; a row without a key keeps
    its count and has no component. Every link between different texts is found,
    up to chance hits of 64-bit hashes.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("_text"))

    def sets(batch: pa.RecordBatch) -> list[np.ndarray]:
        return text_shingles(batch["_text"].to_pylist(), width)

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of n-grams by cell, of each set that is new to the task, and of sizes."""
        counters = np.zeros(CELLS, dtype=np.uint16)
        sizes = np.zeros(LARGEST_BOUNDARY + 2, dtype=np.int64)
        seen: set[int] = set()
        for batch in slices(batches, "_text"):
            for found in sets(batch):
                node = node_of(found)
                if len(found) and node not in seen:
                    seen.add(node)
                    at = cells(found)
                    counters[at] += counters[at] < np.iinfo(np.uint16).max
                    sizes[min(len(found), LARGEST_BOUNDARY + 1)] += 1
        parts = [zlib.compress(p.tobytes(), 1) for p in counters.reshape(-1, CELL_BLOCK) if p.any()]
        used = np.nonzero(counters.reshape(-1, CELL_BLOCK).any(axis=1))[0].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(used + [-1], pa.int32()), pa.array(parts + [sizes.tobytes()], pa.binary())],
            names=["block", "counts"],
        )

    def add_up(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        if block < 0:
            total = sum(np.frombuffer(x, dtype=np.int64) for x in table["counts"].to_pylist())
            return pa.table({"block": pa.array([block], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})
        total = np.zeros(CELL_BLOCK, dtype=np.int64)
        for packed in table["counts"].to_pylist():
            total += np.frombuffer(zlib.decompress(packed), dtype=np.uint16)
        packed = zlib.compress(np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32).tobytes(), 1)
        return pa.table({"block": pa.array([block], pa.int32()), "counts": pa.array([packed], pa.binary())})

    # at most CELLS counters reach the driver, however many texts there are
    surveyed = {
        r["block"]: bytes(r["counts"])
        for r in rows.mapInArrow(survey, "block int, counts binary")
        .groupBy("block")
        .applyInArrow(add_up, "block int, counts binary")
        .collect()
    }
    sizes = np.frombuffer(surveyed.pop(-1, b""), dtype=np.int64)
    unpack = lambda x: np.frombuffer(zlib.decompress(x), dtype=np.uint32)
    # Cells that hold more than chance would bring together have a frequent n-gram.
    # A block at a time, so the driver holds little more than a byte for each cell.
    mean = sum(int(unpack(x).sum(dtype=np.int64)) for x in surveyed.values()) / CELLS
    late = np.zeros(CELLS, dtype=np.uint8)
    pairs = usual = 0.0
    for block, packed in surveyed.items():
        part = unpack(packed)
        above = part > mean + 6 * np.sqrt(mean) + 2
        level = 1 + 4 * np.log2(np.maximum(part, 1) / max(1.0, mean))
        late[block * CELL_BLOCK : (block + 1) * CELL_BLOCK] = np.where(above, np.clip(level, 1, 255), 0)
        rest = part[~above].astype(np.float64)
        pairs += float(rest @ rest)
        usual += float(rest.sum())
    list_length = max(0.0, pairs / max(1.0, usual) - 1 - mean)
    boundary = choose_boundary({n: int(c) for n, c in enumerate(sizes) if n and c}, list_length, percent)
    order = docs.sparkSession.sparkContext.broadcast(late)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = sets(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array([len(f) for f in found], pa.int32()),
                    pa.array([node_of(f) for f in found], pa.int64()),
                    pa.array([bitmap(f) for f in found], pa.binary()),
                    list_array([sign(f) for f in found], pa.int64()),
                ],
                names=["id", "n", "node", "bitmap", "sign"],
            )

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys of each set, once in a task however many copies it meets."""
        seen: set[int] = set()
        for batch in slices(batches, "_text"):
            keys, nodes, n, at = [], [], [], []
            for found in sets(batch):
                node = node_of(found)
                if len(found) and node not in seen:
                    seen.add(node)
                    own, places = set_keys(found, boundary, order.value, percent)
                    keys.append(own)
                    at.append(places)
                    nodes.append(node)
                    n.append(len(found))
            if keys:
                each = [len(k) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(np.repeat(np.array(n, dtype=np.int32), each)),
                        pa.array(np.repeat(np.array(nodes, dtype=np.int64), each)),
                        pa.array(np.concatenate(at)),
                    ],
                    names=["key", "n", "node", "at"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    described = stored(rows.mapInArrow(describe, f"id {id_type}, n int, node long, bitmap binary, sign array<long>"), "sets")
    keyed = rows.filter(F.col("id").isNotNull()).select("_text").mapInArrow(lists, "key long, n int, node long, at int")
    nodes = described.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    # every round looks nodes up
    one = stored(
        nodes.groupBy("node").agg(
            F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", "bitmap", "sign")]
        ),
        "nodes",
    )
    signs = lambda: one

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs that link: a bound from their bitmaps first, then their sets."""
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        known = one.join(ends, "node")
        left = known.select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("bitmap").alias("am"))
        right = known.select(F.col("node").alias("b"), F.col("n").alias("bn"), F.col("bitmap").alias("bm"))

        def may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, m = batch["an"].to_pylist(), batch["bn"].to_pylist()
                x, y = batch["am"].to_pylist(), batch["bm"].to_pylist()
                # 100 * intersection >= percent * union, in terms of the difference
                ok = [
                    (100 + percent) * least_difference(p, q) <= (100 - percent) * (i + j)
                    for i, j, p, q in zip(n, m, x, y)
                ]
                yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(ok))

        likely = stored(
            pairs.join(left, "a").join(right, "b").mapInArrow(may_link, "a long, b long"), f"{name}-likely"
        )
        ends = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
        wanted = stored(one.join(ends, "node").select("node", "id"), f"{name}-wanted")

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "_text"):
                found = sets(batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"],
                        pa.array([node_of(f) for f in found], pa.int64()),
                        pa.array([f.tobytes() for f in found], pa.binary()),
                    ],
                    names=["id", "node", "members"],
                )

        read = near_keys(rows, "id", wanted, "id").mapInArrow(members, f"id {id_type}, node long, members binary")
        held = read.join(wanted, ["id", "node"]).dropDuplicates(["node"]).drop("id")

        def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = []
                for x, y in zip(batch["am"].to_pylist(), batch["bm"].to_pylist()):
                    common, union = overlap(x, y)
                    ok.append(100 * common >= percent * union)
                yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(ok))

        found = stored(
            likely.join(held.select(F.col("node").alias("a"), F.col("members").alias("am")), "a")
            .join(held.select(F.col("node").alias("b"), F.col("members").alias("bm")), "b")
            .mapInArrow(link, "a long, b long"),
            f"{name}-links",
        )
        removed(likely, wanted)
        return found

    # One document may have several rows: its nodes are linked.
    several = nodes.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b")
    own = nodes.join(several.select("id", "a"), "id").select("a", F.col("node").alias("b")).filter("a <> b")
    roots = linked_lists(keyed, verified, percent, own, signs=signs)

    labelled = described.select("id", "n", "node").join(
        roots.withColumnRenamed("id", "node"), "node", "left"
    ).select(
        "id",
        "n",
        F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.coalesce("root", "node")).alias("root"),
    )
    smallest = labelled.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("smallest"))
    return labelled.join(smallest, "root", "left").select(
        F.col("id").alias(key),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("smallest", "id").alias("component_id"),
    )
