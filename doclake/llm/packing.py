"""Best-fit packing of documents into sequences, after Martello and Toth's reduction.

Packing needs lengths only, and there are at most ``capacity`` of them. So the
driver packs a histogram with one row per length, and Spark deals the documents
of each length to the places of that length. Work on the driver is bounded by
the capacity, not by the number of documents.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import one_thread, set_aside, slices, tokenizer_path
from doclake.session import cut_lineage

CAPACITY = 4096
PART_ROWS = 1_000_000  # pieces of one length that a task numbers
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 150_000  # some 20 MB in a worker, where texts are in other letters
CACHED_PARTS = 100_000  # some 12 MB, and as much for those before them
PIECE_COLUMNS = "piece int, start long, length long, ids_crc32 long"

# Pre-tokens of the vocabulary's own pattern, for words of printable ASCII and
# the letters of Latin-1: those are in normal form and have one lower case each.
# None holds white space, so a text has the parts of its words in turn.
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-zß-öø-ÿ0-9\x20\x09-\x0D]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ\x20\x09-\x0D]*")
# A word with any other character.
_OTHER = re.compile(
    r"(?<![^\x20\x09-\x0D])[!-~À-ÖØ-öø-ÿ]*+[^!-~À-ÖØ-öø-ÿ\x20\x09-\x0D][^\x20\x09-\x0D]*"
)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PartIds(dict):
    """Ids of a lower-case pre-token as unsigned 32-bit numbers.

    At ``CACHED_PARTS`` the table is begun anew, and those in use come back from the one before it.
    """

    def __init__(self, model):
        self.model = model
        self.letters = byte_letters()
        self.before: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        value = self.before.get(part)
        if value is None:
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            value = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        if len(self) >= CACHED_PARTS:
            self.before = dict(self)
            self.clear()
        self[part] = value
        return value


class WordIds(dict):
    """Ids of a word between white space, as unsigned 32-bit numbers (little-endian, as all machines that run Spark).

    The vocabulary drops white space before it splits, so a text's ids are
    those of its words in turn. Plain words go to the merge model part by part,
    others through the whole tokenizer. The tables of words and parts are
    bounded, and so is their memory.
    """

    def __init__(self, path: str):
        one_thread()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.parts = PartIds(self.tokenizer.model)
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, names)) or "(?!)")

    def plain(self, text: str) -> bytes:
        """Ids of plain words and the white space between them."""
        return b"".join(map(self.parts.__getitem__, _PARTS.findall(text.lower())))

    def text(self, text: str) -> bytes:
        """Ids of a text: stretches of plain words at a time, the others word by word."""
        if self.special.search(text):
            return b"".join(map(self.__getitem__, text.encode().split()))
        if _PLAIN.fullmatch(text):
            return self.plain(text)
        out, at = [], 0
        for m in _OTHER.finditer(text):
            if m.start() > at:
                out.append(self.plain(text[at : m.start()]))
            out.append(self[m.group().encode()])
            at = m.end()
        out.append(self.plain(text[at:]))
        return b"".join(out)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and not self.special.search(text):
            value = self.plain(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            value = array("I", ids).tobytes()
        self[word] = value
        return value


_TABLES: dict[str, WordIds] = {}  # of one Python worker, kept between its tasks


def token_pieces(
    docs: DataFrame,
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """The columns of ``docs`` without the text, and one row per piece.

    Adds ``piece, start, length, ids_crc32`` (columns of these names are
    replaced). A null text counts as empty: one piece that holds the end id.
    """
    docs, named_back = set_aside(docs, ["_text"])
    added = [c.split()[0] for c in PIECE_COLUMNS.split(", ")]
    kept = [c for c in docs.columns if c not in (text, *added)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)
    schema = f"{fields}, {PIECE_COLUMNS}" if kept else PIECE_COLUMNS
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary or tokenizer_path(VOCABULARY)
        table = _TABLES.get(path)
        if table is None:
            table = _TABLES[path] = WordIds(path)
        step = 4 * capacity
        for batch in slices(batches, "_text"):
            rows, piece, start, length, crc = [], [], [], [], []
            for row, value in enumerate(batch["_text"].to_pylist()):
                ids = (table.text(value) if value else b"") + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch[c].take(taken) for c in kept]
                + [pa.array(piece, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, length, crc)],
                names=kept + added,
            )

    return named_back(docs.select(*kept, F.col(text).alias("_text")).mapInArrow(cut, schema))


def reduce_and_pack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, list]]:
    """Pack ``counts`` items of each length; groups of alike sequences.

    A group is ``(first sequence, number of sequences, items)`` and an item
    ``(length, rank of the first sequence's item, offset)``: sequence ``first + i``
    holds the item of that length with rank ``rank + i`` at that offset.

    First the reduction: an item of length l with room r left is fixed for good
    with the largest item that fits, where no other choice can be better: that
    item fills r exactly, or no two items fit into r. It is fixed alone where
    nothing fits. The rest is packed by best fit, longest first.
    """
    left = {int(k): int(v) for k, v in counts.items() if v > 0}
    used = dict.fromkeys(left, 0)
    sizes = sorted(left)
    groups: list[list] = []

    def take(length: int, n: int) -> int:
        rank = used[length]
        used[length] += n
        left[length] -= n
        if not left[length]:
            sizes.pop(bisect.bisect_left(sizes, length))
        return rank

    def smallest_two() -> int:
        if not sizes:
            return 2 * capacity
        return 2 * sizes[0] if left[sizes[0]] > 1 else sizes[0] + (sizes[1] if len(sizes) > 1 else capacity)

    changed = True
    while changed:
        changed = False
        for length in sorted(sizes, reverse=True):
            while left[length]:
                room = capacity - length
                at = bisect.bisect_right(sizes, room) - 1
                if at >= 0 and sizes[at] == length and left[length] == 1:
                    at -= 1  # it can't be its own partner
                if at < 0:
                    n = left[length]
                    groups.append([n, [(length, take(length, n), 0)]])
                    changed = True
                    break
                partner = sizes[at]
                if partner != room and smallest_two() <= room:
                    break
                if partner == length:
                    n = left[length] // 2
                    rank = take(length, 2 * n)
                    groups.append([n, [(length, rank, 0), (length, rank + n, length)]])
                else:
                    # fewer items never make two of them fit, so all go at once
                    n = min(left[length], left[partner])
                    first, second = take(length, n), take(partner, n)
                    groups.append([n, [(length, first, 0), (partner, second, length)]])
                changed = True

    # Best fit: open[r] are groups of sequences with room r.
    open_: dict[int, list[list]] = {}
    rooms: list[int] = []
    done = groups

    def put(group: list, room: int) -> None:
        if not room:
            done.append(group)
            return
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append(group)

    for length in sorted(sizes, reverse=True):
        n, rank = left[length], used[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                # as many new sequences as the items fill, each with all that fit
                each = min(capacity // length, n)
                m = n // each
                items = [(length, rank + k * m, k * length) for k in range(each)]
                put([m, items], capacity - each * length)
                n -= m * each
                rank += m * each
                continue
            room = rooms[at]
            group = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            m = min(n, group[0])
            if m < group[0]:
                rest = [(l, r + m, o) for l, r, o in group[1]]
                put([group[0] - m, rest], room)
            put([m, group[1] + [(length, rank, capacity - room)]], room - length)
            n -= m
            rank += m
    done += [g for gs in open_.values() for g in gs]
    out, first = [], 0
    for m, items in done:
        out.append((first, m, items))
        first += m
    return out


def pack(
    pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, key: tuple[str, ...] = ("doc_id", "piece")
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Pieces of one length are numbered in parts, so that a length that very many
    pieces share isn't numbered in one task; ``key`` only makes the order repeat.
    """
    pieces, named_back = set_aside(pieces, ["_part", "_rank", "_before", "_n"])
    dealt = cut_lineage(pieces.drop("sequence_id", "offset"))
    least = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-dealt.count() // PART_ROWS))
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int"))
    counted = dealt.groupBy(length, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(length).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        length, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # At most `capacity` rows by construction.
    totals = {r[0]: r[1] for r in counted.groupBy(length).agg(F.sum("_n")).collect()}
    groups = reduce_and_pack(totals, capacity)
    places: dict[int, list] = {}
    for first, m, items in groups:
        for size, rank, offset in items:
            places.setdefault(size, []).append((rank, m, first, offset))
    table = {size: np.array(sorted(v), dtype=np.int64) for size, v in places.items()}
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    number = Window.partitionBy(length, "_part").orderBy(*key)
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(number) - 1)
        .join(starts, [length, "_part"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_part", "_before")
    )
    names = [c for c in ranked.columns if c != "_rank"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name in names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch[length].to_numpy(zero_copy_only=False)
            ranks = batch["_rank"].to_numpy(zero_copy_only=False)
            sequence = np.empty(len(sizes), dtype=np.int64)
            offset = np.empty(len(sizes), dtype=np.int64)
            for size in np.unique(sizes):
                rows = np.nonzero(sizes == size)[0]
                runs = shared.value[int(size)]
                at = np.searchsorted(runs[:, 0], ranks[rows], side="right") - 1
                sequence[rows] = runs[at, 2] + ranks[rows] - runs[at, 0]
                offset[rows] = runs[at, 3]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in names] + [pa.array(sequence), pa.array(offset)],
                names=names + ["sequence_id", "offset"],
            )

    return named_back(ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long"))
