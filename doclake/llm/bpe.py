"""BPE encoding and decoding through a table of distinct words.

Texts are split where the tokenizer would split them anyway. A block of texts
keeps its distinct words once, and its texts as positions in that list. Words
of all blocks are dealt by word, so that each distinct word is encoded once. The
ids then go back to the blocks, where they are joined with their pieces, word by
word, and set in by position. Texts themselves are never shuffled.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from doclake.llm.common import factorize, in_fixed_order, list_array, one_thread, slices, tokenizer_path
from doclake.llm.packing import byte_letters

VOCABULARY = "byte_bpe_50k.json"
BLOCK_WORDS = 3_500_000
BLOCK_TEXTS = 40_000

# White space as the tokenizer's pattern has it (Unicode White_Space).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Words such that the tokenizer splits at both ends of each, whatever follows:
# letters before a stop or white space; else all up to white space; a run of
# white space gives its last space to the word after it.
_WORDS = re.compile(
    rf" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[.,;:!?{_SPACE}])| ?[^{_SPACE}]+|[{_SPACE}](?=[^{_SPACE}])"
    rf"|[{_SPACE}]+(?= [^{_SPACE}])|[{_SPACE}]+[^{_SPACE}]+|[{_SPACE}]+"
)


def split_words(text: str, special: re.Pattern | None = None) -> list[str]:
    """Words whose ids, one after the other, are the ids of ``text``."""
    if special is None or not special.search(text):
        return _WORDS.findall(text)
    out: list[str] = []
    for part in special.split(text):
        out += [part] if special.fullmatch(part) else _WORDS.findall(part)
    return out


def load(path: str):
    one_thread()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def special_pattern(tokenizer) -> re.Pattern | None:
    """The special tokens, longest first, which are cut out before anything else."""
    names = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    if not names:
        return None
    return re.compile("(" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + ")")


def piece_bytes(tokenizer) -> dict[int, bytes]:
    """The bytes of each id, from the letters that stand for bytes in the vocabulary."""
    byte = {letter: b for b, letter in byte_letters().items()}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    return {
        i: piece.encode() if piece in special else bytes(byte[c] for c in piece)
        for piece, i in tokenizer.get_vocab(with_added_tokens=True).items()
    }


_LOADED: dict[str, tuple] = {}  # of one Python worker, kept between its tasks


def _loaded(vocabulary: str | None) -> tuple:
    path = vocabulary or tokenizer_path(VOCABULARY)
    if path not in _LOADED:
        tokenizer = load(path)
        _LOADED[path] = tokenizer, special_pattern(tokenizer), piece_bytes(tokenizer)
    return _LOADED[path]


def _id_type(pieces: dict[int, bytes]) -> str:
    return "<u2" if len(pieces) <= 1 << 16 else "<u4"


def _blocks(batches: Iterator[pa.RecordBatch], special) -> Iterator[tuple]:
    """(block, keys, words by how common they are, positions of all texts, words by text).

    Blocks are of bounded size. Their number holds the task, the block's number
    in it and a checksum of its words.
    """
    part, number = TaskContext.get().partitionId(), 0
    keys, sizes, positions, table = [], [], [], {}

    def block():
        code = np.concatenate(positions)
        order = np.argsort(-np.bincount(code, minlength=len(table)), kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        words = list(table)
        check = zlib.crc32("\0".join(words).encode("utf-8", "surrogatepass"))
        return (part << 44) + (number << 32) + check, keys, [words[i] for i in order], rank[code], sizes

    for batch in slices(batches, "_text", 2048):
        if keys and (sum(sizes) >= BLOCK_WORDS or len(keys) >= BLOCK_TEXTS):
            yield block()
            keys, sizes, positions, table, number = [], [], [], {}, number + 1
        words = [split_words(t, special) for t in batch["_text"].to_pylist()]
        code, distinct = factorize([w for ws in words for w in ws])
        places = np.array([table.setdefault(w, len(table)) for w in distinct], dtype=np.int64)
        positions.append(places[code] if len(code) else places)
        sizes += map(len, words)
        keys += batch["_key"].to_pylist()
    if keys:
        yield block()


def pack_positions(code: np.ndarray) -> bytes:
    """Positions byte by byte: the common words' high bytes are all alike."""
    return zlib.compress(code.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_positions(packed: bytes) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(flat.T).view("<u4").ravel()


def encode_decode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, ids: bool = False
) -> DataFrame:
    """``<key>, n_tokens, ids_sha256, decoded_sha256`` of each row; with ``ids``, ids and text too.

    A null text counts as empty; the hashes of an empty text are those of an
    empty string. Repeated rows and null keys stay rows of their own. Texts are split
    twice, so an input that may come in another order, such as one behind a
    shuffle, is stored first.
    """
    rows = in_fixed_order(docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text")))
    key_type = rows.schema["_key"].dataType.simpleString()
    arrow_key = to_arrow_type(rows.schema["_key"].dataType)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, words, _, _ in _blocks(batches, _loaded(vocabulary)[1]):
            # in the order of the words: neighbours are alike and take little room
            order = sorted(range(len(words)), key=words.__getitem__)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(words), block)),
                    pa.array(order, pa.int32()),
                    pa.array([words[i] for i in order], pa.string()),
                ],
                names=["block", "place", "word"],
            )

    def position(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, keys, words, code, sizes in _blocks(batches, _loaded(vocabulary)[1]):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block]),
                    pa.array([len(words)], pa.int64()),
                    pa.array([keys], pa.list_(arrow_key)),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([pack_positions(code)], pa.binary()),
                ],
                names=["block", "n_words", "keys", "sizes", "positions"],
            )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal words lie side by side here, so the last one is all there is to remember.

        A row holds the words of one block: their places, and their ids in a row.
        """
        tokenizer, _, pieces = _loaded(vocabulary)
        kind = _id_type(pieces)
        last, last_ids = None, b""
        for batch in batches:
            words = batch["word"].to_pylist()
            fresh = [w for i, w in enumerate(words) if w != (words[i - 1] if i else last)]
            found = iter(tokenizer.encode_batch_fast(fresh, add_special_tokens=False))
            out = []
            for word in words:
                if word != last:
                    last, last_ids = word, np.array(next(found).ids, dtype=kind).tobytes()
                out.append(last_ids)
            block, place = batch["block"].to_numpy(), batch["place"].to_numpy()
            order = np.lexsort((place, block))
            blocks, first = np.unique(block[order], return_index=True)
            groups = np.split(order, first[1:])
            width = np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(blocks),
                    list_array([place[g] for g in groups], pa.int32()),
                    list_array([np.array([len(out[i]) // width for i in g], np.int32) for g in groups], pa.int32()),
                    pa.array([b"".join([out[i] for i in g]) for g in groups], pa.binary()),
                ],
                names=["block", "places", "counts", "ids"],
            )

    def put_in(left: pa.Table, right: pa.Table) -> pa.Table:
        out, pieces = [], _loaded(vocabulary)[2]
        flat = lambda name: left[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        places = flat("places") if left.num_rows else np.empty(0, np.int32)
        for block in right.to_batches():
            for row in block.to_pylist():
                if len(places) != row["n_words"]:
                    raise RuntimeError("a block of texts was split differently the second time")
                counts = flat("counts").astype(np.int64) if len(places) else np.empty(0, np.int64)
                given = np.frombuffer(b"".join(left["ids"].to_pylist()), dtype=_id_type(pieces))
                begins = np.cumsum(counts) - counts
                order = np.argsort(places)
                counts, begins = counts[order], begins[order]
                joined, decoded = [], []
                for begin, count in zip(begins.tolist(), counts.tolist()):
                    word = given[begin : begin + count].tolist()
                    joined.append(",".join(map(str, word)))
                    decoded.append(b"".join([pieces[i] for i in word]))
                positions, at = unpack_positions(row["positions"]), 0
                for one, size in zip(row["keys"], row["sizes"]):
                    own = positions[at : at + size]
                    where, at = own.tolist(), at + size
                    text_ids = ",".join([joined[p] for p in where])
                    back = b"".join([decoded[p] for p in where]).decode("utf-8", "replace")
                    facts = (
                        one,
                        int(counts[own].sum()),
                        hashlib.sha256(text_ids.encode()).hexdigest(),
                        hashlib.sha256(back.encode()).hexdigest(),
                    )
                    out.append(facts + (([int(i) for i in text_ids.split(",") if i], back) if ids else ()))
        columns = list(zip(*out)) or [[] for _ in result.names]
        return pa.table([pa.array(c, t) for c, t in zip(columns, result.types)], names=result.names)

    schema = f"`{key}` {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    kinds = [(key, arrow_key), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if ids:
        schema += ", ids array<int>, decoded string"
        kinds += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    result = pa.schema(kinds)

    words = rows.mapInArrow(split, "block long, place int, word string")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = (
        words.repartition(partitions, "word")
        .sortWithinPartitions("word")
        .mapInArrow(encode, "block long, places array<int>, counts array<int>, ids binary")
    )
    positions = rows.mapInArrow(
        position, f"block long, n_words long, keys array<{key_type}>, sizes array<int>, positions binary"
    )
    return encoded.groupBy("block").cogroup(positions.groupBy("block")).applyInArrow(put_in, schema)
