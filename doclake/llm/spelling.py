"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words form two tries, of their letters from the left and from the right, each a
table of edges (node, label, child) between nodes where words part or end. The
search is a frontier of states (word, position, node, edits) joined with the
edges level by level. One edit leaves one half of a word as it is: a state starts
at the word's own node at the end of that half and looks for the edit in the
other. A state that reaches the end of a word of the trie with one edit is a
pair of neighbours.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import slices, stored

LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2  # how many times as frequent a form is as its variant, at least
TYPO_EVERY = 97
FLUSH_WORDS = 200_000  # distinct words that a task holds before it sends its counts

# A letter from U+00C0 to U+00FF is the byte C3 and one of 80 to BF.
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")


def without_letter(word: bytes, place: int) -> bytes:
    """The word without the code point at ``place``."""
    letters = word.decode("utf-8")
    return (letters[:place] + letters[place + 1 :]).encode("utf-8")


def text_words(key: object, text: str, typo_every: int = TYPO_EVERY) -> Counter:
    """Counts of the runs of Latin letters in a text, A-Z lower-cased.

    Runs whose crc32 with the text's key is a multiple of ``typo_every`` lose the
    code point that it points at.
    """
    begin = zlib.crc32(f"{'' if key is None else key}:".encode())
    found = Counter(_RUN.findall(text.encode("utf-8", "surrogatepass").lower()))
    if typo_every:
        drawn = [w for w in found if zlib.crc32(w, begin) % typo_every == 0]
        # taken out before any result goes in: a result is not drawn again
        for word, count in [(w, found.pop(w)) for w in drawn]:
            letters = len(word.decode("utf-8"))
            found[without_letter(word, zlib.crc32(word, begin) % letters)] += count
    return found


def count_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    typo_every: int = TYPO_EVERY,
) -> DataFrame:
    """``word, n`` of all texts. Null and empty texts have no words; a null key counts as ''."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL")

    def packed(counts: Counter) -> pa.RecordBatch:
        words = [w.decode("utf-8") for w in counts]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches):
            for own, value in zip(batch["key"].to_pylist(), batch["text"].to_pylist()):
                for word, n in dict.items(text_words(own, value, typo_every)):
                    held[word] += n
            if len(held) > FLUSH_WORDS:
                yield packed(held)
                held = Counter()
        yield packed(held)

    return (
        rows.mapInArrow(count, "word string, n long")
        .filter(F.length("word") >= least_letters)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least_count)
    )


def unsent(table: DataFrame) -> DataFrame:
    """``table`` to be joined by sorting, never sent whole to every task.

    Spark sizes rows behind an explode, and stored tables, by the files they come
    from: ten MB of distinct words are more than a GB of prefixes.
    """
    return table.hint("merge")


def letters(word: Column, start: Column, count: Column | None = None) -> Column:
    """``count`` letters from ``start`` (from 0), or all of them."""
    return F.substr(word, start + 1, count) if count is not None else F.substr(word, start + 1)


def kept_letters(side: Column, size: Column) -> Column:
    """Letters of the half of a word of ``size`` letters that the edit leaves as it is: none of up to three."""
    half = F.floor(size / 2)
    return F.when(size <= 3, 0).when(side == 0, half).otherwise(size - half).cast("int")


def bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("int"))


def length_bit(rest: Column) -> Column:
    """A bit for the number of letters that are left, one for all from 62 on."""
    return bit(F.least(rest, F.lit(62)))


def pair_bit(word: Column, start: Column) -> Column:
    """A bit for the two letters from ``start``."""
    return bit(F.pmod(F.xxhash64(letters(word, start, F.lit(2))), F.lit(63)))


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Starting states and edges of the tries of ``word, n``.

    A node is the hash of its trie and prefix; only nodes where words part, end or
    start their search are kept, and none before any search starts. Edges are
    ``node, label, child, ended, ended_n, sizes, pairs``: the word that ends at the
    child, if one does, and bits for how many letters words have behind it and
    for their next two. A chance hit of two hashes only adds edges and bits, and
    what is found is compared letter by letter.
    """
    spelled = words.select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("word").alias("s")),
                F.struct(F.lit(1).alias("side"), F.reverse("word").alias("s")),
            )
        ).alias("x"),
        "n",
    ).select("x.*", "n")
    s, pos, size = F.col("s"), F.col("pos"), F.length("s")
    start = kept_letters(F.col("side"), size)
    # the first place at which words with a letter less start
    first = kept_letters(F.col("side"), size - 1)
    node = lambda at: F.xxhash64("side", letters(s, F.lit(0), at))
    prefixes = spelled.select("side", "s", "n", F.explode(F.sequence(first, size)).alias("pos"))
    prefixes = prefixes.withColumn("node", node(pos))
    # the code of the next letter, 0 behind the last
    following = F.ascii(letters(s, pos, F.lit(1)))
    nodes = (
        prefixes.select(
            "node", following.alias("next"), (pos == start).cast("int").alias("start"),
            length_bit(size - pos).alias("size"), F.when(pos < size, pair_bit(s, pos)).otherwise(0).alias("pair"),
        )
        .groupBy("node")
        .agg(
            F.min("next").alias("low"), F.max("next").alias("high"), F.max("start").alias("start"),
            F.bit_or("size").alias("sizes"), F.bit_or("pair").alias("pairs"),
        )
        .filter("low < high OR low = 0 OR start = 1")
        .select("node", (F.col("low") == 0).alias("ends"), "sizes", "pairs")
    )
    steps = (
        prefixes.join(unsent(nodes), "node")
        .groupBy("side", "s", "n")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "node", "ends", "sizes", "pairs"))).alias("steps"))
    )
    paths = stored(steps, "paths")

    def edge(step: Column, i: Column) -> Column:
        before = F.get("steps", i - 1)
        ended = letters(s, F.lit(0), step["pos"])
        return F.struct(
            before["node"].alias("node"),
            letters(s, before["pos"], step["pos"] - before["pos"]).alias("label"),
            step["node"].alias("child"),
            F.when(step["ends"], ended).alias("ended"),
            F.when(step["ends"] & (step["pos"] == size), F.col("n")).alias("ended_n"),
            step["sizes"].alias("sizes"),
            step["pairs"].alias("pairs"),
        )

    own = F.filter(F.transform("steps", edge), lambda x: x["node"].isNotNull())
    edges = (
        paths.select(F.explode(own).alias("x"))
        .select("x.*")
        .groupBy("node", "label", "child", "ended", "sizes", "pairs")
        .agg(F.max("ended_n").alias("ended_n"))
    )
    starts = paths.select("side", "s", "n", start.alias("pos"), node(start).alias("node"), F.lit(0).alias("edits"))
    return starts, stored(edges, "edges")


def step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states behind the edges that the given ones can take with one edit at most.

    A state with its edit made stays only where words go on with as many letters
    as the state has left, and with its next two.
    """
    s, pos, label, edits, change = (F.col(c) for c in ("s", "pos", "label", "edits", "change"))
    size = F.length(label)
    starts_alike = letters(s, pos, F.lit(1)) == letters(label, F.lit(0), F.lit(1))
    # one edit within the label makes it use so many letters more of the word
    changes = F.when(edits == 0, F.array(*map(F.lit, (-1, 0, 1)))).otherwise(F.array(F.lit(0)))
    met = (
        states.join(unsent(edges), "node")
        .filter((edits == 0) | starts_alike)
        .select("side", "s", "n", "pos", "edits", "label", "child", "ended", "ended_n", "sizes", "pairs",
                F.explode(changes).alias("change"))
        .withColumn("piece", letters(s, pos, size + change))
        .withColumn("at", pos + size + change)
    )
    same = F.col("piece") == label
    rest = F.length(s) - F.col("at")
    goes_on = (F.col("sizes").bitwiseAND(length_bit(F.greatest(rest, F.lit(0)))) != 0) & (
        (rest == 0) | (F.col("pairs").bitwiseAND(pair_bit(s, F.col("at"))) != 0)
    )
    own = (change == 0) & same
    edited = (edits == 0) & (rest >= 0) & goes_on & (F.levenshtein("piece", label, 1) == 1)
    return met.filter(F.when(own, (edits == 0) | goes_on).otherwise(edited)).select(
        "side", "s", "n", F.col("at").alias("pos"), F.when(own, edits).otherwise(1).alias("edits"),
        F.col("child").alias("node"), "ended", "ended_n", (F.col("sizes") != 1).alias("more"),
    )


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: all pairs of words one edit apart, in both directions."""
    frontier, edges = trie(words)
    found = None
    while True:
        reached = stored(step(frontier, edges), "frontier")
        done = reached.filter("edits = 1 AND pos = length(s) AND ended IS NOT NULL")
        done = done.select("side", "s", "n", "ended", "ended_n")
        found = found.unionByName(done) if found is not None else done
        frontier = reached.filter("more AND (edits = 0 OR pos < length(s))").select(
            "side", "s", "n", "pos", "node", "edits"
        )
        if frontier.isEmpty():
            break
    read = lambda c: F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c))
    return found.select(
        read("s").alias("word"), "n", read("ended").alias("near"), F.col("ended_n").alias("near_n")
    ).distinct()


def follow(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words in ``word, form``, by forms to the last: each round doubles the way."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(roots.join(unsent(ahead), "root", "left").select("word", "root", "further"), "roots")
        roots = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.filter("further IS NOT NULL").isEmpty():
            return roots


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the distinct words in ``word, n``.

    Words are near if one inserted, deleted or replaced code point makes one the
    other. ``form`` is the near word of largest ``n`` (ties: the smallest by code
    points) if that is at least ``ratio`` times the word's own, else null;
    ``root`` is the last of the forms from the word, or the word itself. Rows of
    one word are added up; null and empty words are left out.
    """
    words = stored(
        words.filter("word IS NOT NULL AND word <> ''").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    best = (
        neighbours(words)
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
        )
    )
    joined = words.join(unsent(best), "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    formed = stored(
        joined.select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = follow(formed.filter("form IS NOT NULL"))
    return formed.join(unsent(roots), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
