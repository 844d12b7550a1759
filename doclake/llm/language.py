"""Language of texts: scripts narrow the candidates, Viterbi labels the spans.

Each word gets a score per language from its character n-grams. A path through
the words pays a penalty wherever it changes language, so a mixed text falls
apart into spans. The text's language is the one with the most letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import factorize, mix, slices

UNKNOWN = "und"
BITS = 16
SAMPLE_ROWS = 8_000  # documents to learn from at most, about
SWITCH_PENALTY = 12.0  # nats
SCRIPT_SHARE = 0.01  # a language uses a script that has this share of its letters
SLICE_ROWS = 4_096
SLICE_BYTES = 8_000_000

# First code point of blocks of letters, and the script of each.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "indic"),
    (0x0E00, "thai"),
    (0x0F00, "tibetan"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x1D00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x2C60, "latin"),
    (0x2E80, "han"),
    (0x3040, "kana"),
    (0x3100, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(n) for _, n in SCRIPTS])
_SPACE = np.uint64(32)


def _is_letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


_LETTERS: list[np.ndarray] = []


def letters(codes: np.ndarray) -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(_is_letter_table())
    return _LETTERS[0][codes]


def word_grams(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of words, the word of each; letters and main script by word.

    n-grams are runs of two and three letters of the lower-cased word between
    marks for its ends. Characters that are no letters are left out.
    """
    joined = " ".join(words).lower() + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    keep = letters(codes) | (codes == 32)
    codes = codes[keep].astype(np.uint64)
    word = np.concatenate([[0], np.cumsum(codes == _SPACE)[:-1]]) if len(codes) else np.empty(0, int)
    is_letter = codes != _SPACE
    count = np.bincount(word[is_letter], minlength=len(words)).astype(np.int64)
    kinds = _SCRIPT[np.searchsorted(_STARTS, codes[is_letter], side="right") - 1]
    table = np.zeros((len(words), len(_NAMES)), dtype=np.int32)
    np.add.at(table, (word[is_letter], kinds), 1)
    script = table.argmax(axis=1)
    padded = np.concatenate([[_SPACE], codes])  # the space before each word is the one after the last
    owner = np.concatenate([[0], word])
    two = padded[:-1] * np.uint64(1 << 21) + padded[1:]
    real = padded[1:] != _SPACE  # a run may begin at a word's start or end at its end
    three = padded[:-2] * np.uint64(1 << 42) + padded[1:-1] * np.uint64(1 << 21) + padded[2:]
    inner = padded[1:-1] != _SPACE
    hashed = np.concatenate([mix(two[real] + np.uint64(1)), mix(three[inner] ^ np.uint64(0x5BD1E995))])
    owners = np.concatenate([owner[1:][real], owner[1:-1][inner]])
    return (hashed >> np.uint64(64 - bits)).astype(np.int64), owners, count, script


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # log-probability by n-gram and language
    scripts: np.ndarray  # whether a language uses a script, by language and script
    bits: int

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score by word and language, and letters by word.

        Languages that don't use the word's script are far behind the others,
        unless none uses it; then, and for words without letters, all are alike.
        """
        n, k = len(words), len(self.languages)
        grams, owners, count, script = word_grams(words, self.bits)
        total = np.empty((n, k))
        for j in range(k):
            total[:, j] = np.bincount(owners, weights=self.weights[grams, j], minlength=n)
        total -= total.max(axis=1, keepdims=True)
        fits = self.scripts[:, script].T
        known = fits.any(axis=1)
        total = np.where(fits, total, -100.0)
        total[~known | (count == 0)] = 0.0
        return np.maximum(total, -100.0), count


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word; texts are runs of words that begin at ``starts``.

    All texts take a step at a time, longest first, so a step is one array
    operation over the texts that are still going on.
    """
    n, k = scores.shape
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")
    begin, size = starts[order], lengths[order]
    size_up = -size
    back = np.zeros((n, k), dtype=np.int16)
    label = np.zeros(n, dtype=np.int16)
    best = np.zeros((len(begin), k))
    longest = int(size[0]) if len(size) else 0
    own = np.arange(k, dtype=np.int16)
    for t in range(longest):
        live = int(np.searchsorted(size_up, -t, side="left"))
        at = begin[:live] + t
        value = best[:live]
        if t:
            top = value.argmax(axis=1)
            switch = value[np.arange(live), top] - penalty
            stays = value >= switch[:, None]
            back[at] = np.where(stays, own, top[:, None])
            value = np.where(stays, value, switch[:, None])
        best[:live] = value + scores[at]
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        live = int(np.searchsorted(size_up, -t, side="left"))
        at = begin[:live] + t
        label[at] = state[:live]
        state[:live] = back[at, state[:live]]
    return label


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS, bits: int = BITS
) -> Model:
    """A model of the languages of ``docs``; rows without text or language are left out.

    About ``sample_rows`` texts are taken, equally many of each language, by a
    hash of the text. Counts are added up in Spark; what reaches the driver is
    a table of ``2**bits`` n-grams for each language.
    """
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang")
    )
    sizes = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    each = sample_rows / max(1, len(languages))
    draw = F.pmod(F.xxhash64("_text"), F.lit(1_000_000))
    wanted: Column = F.lit(False)
    for name, n in sizes.items():
        share = int(1_000_000 * min(1.0, each / n))
        wanted = wanted | ((F.col("_lang") == name) & (draw < share))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            texts: dict[str, list[str]] = {}
            for name, t in zip(batch["_lang"].to_pylist(), batch["_text"].to_pylist()):
                texts.setdefault(name, []).extend(t.split())
            for name, words in texts.items():
                grams, _, letters_, script = word_grams(words, bits)
                used, n = np.unique(grams, return_counts=True)
                share = np.bincount(script, weights=letters_, minlength=len(_NAMES)).astype(np.int64)
                kinds = np.nonzero(share)[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * (len(used) + len(kinds))),
                        pa.array(np.concatenate([used, -1 - kinds]), pa.int64()),
                        pa.array(np.concatenate([n, share[kinds]]), pa.int64()),
                    ],
                    names=["lang", "gram", "n"],
                )

    counted = (
        rows.filter(wanted)
        .mapInArrow(count, "_lang string, gram long, n long".replace("_lang", "lang"))
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    table = np.full((1 << bits, max(1, len(languages))), 0.5)
    scripts = np.zeros((max(1, len(languages)), len(_NAMES)))
    place = {name: j for j, name in enumerate(languages)}
    column = counted["lang"].map(place).to_numpy(dtype=np.int64)
    gram, n = counted["gram"].to_numpy(dtype=np.int64), counted["n"].to_numpy(dtype=np.float64)
    real = gram >= 0
    table[gram[real], column[real]] += n[real]
    scripts[column[~real], -1 - gram[~real]] += n[~real]
    share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
    weights = np.log(table / table.sum(axis=0, keepdims=True))
    return Model(languages, weights, share >= SCRIPT_SHARE, bits)


def identify(
    df: DataFrame, model: Model, text: str = "text", penalty: float = SWITCH_PENALTY, spans: bool = False
) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``; with ``spans``, also the labelled spans.

    ``lang_pred`` has the most letters on the best path (ties: the earlier
    name); ``score`` is its share of the letters. A text that is null or has no
    letter is ``und`` with score 0, as is every text for a model without
    languages. ``spans`` lists runs of words of one language with their first
    word, number of words and letters. Columns of these names are replaced.
    """
    added = ["lang_pred", "score"] + (["lang_spans"] if spans else [])
    kept = [c for c in df.columns if c not in added]
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept)
    schema = (f"{fields}, " if fields else "") + "lang_pred string, score double"
    span_type = pa.list_(
        pa.struct([("lang", pa.string()), ("word", pa.int64()), ("words", pa.int64()), ("letters", pa.int64())])
    )
    if spans:
        schema += ", lang_spans array<struct<lang:string,word:long,words:long,letters:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.languages)
        for batch in slices(batches, text, SLICE_ROWS, SLICE_BYTES):
            words = [t.split() if t else [] for t in batch[text].to_pylist()]
            sizes = np.array([len(w) for w in words], dtype=np.int64)
            code, distinct = factorize([w for ws in words for w in ws])
            names, score, runs = [UNKNOWN] * len(words), np.zeros(len(words)), [[] for _ in words]
            if k and len(code):
                per_word, count = m.word_scores(distinct)
                has = np.nonzero(sizes)[0]
                starts = (np.cumsum(sizes) - sizes)[has]
                label = viterbi(per_word[code], starts, penalty)
                owner = np.repeat(np.arange(len(words)), sizes)
                weight = count[code]
                total = np.bincount(owner * k + label, weights=weight, minlength=len(words) * k)
                total = total.reshape(len(words), k)
                top, every = total.argmax(axis=1), total.sum(axis=1)
                for i in np.nonzero(every)[0]:
                    names[i] = m.languages[top[i]]
                    score[i] = total[i, top[i]] / every[i]
                if spans:
                    first = np.nonzero(
                        np.r_[True, (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])]
                    )[0]
                    length = np.diff(np.append(first, len(label)))
                    letters_ = np.add.reduceat(weight, first)
                    base = np.cumsum(sizes) - sizes
                    for at, n, c in zip(first, length, letters_):
                        i = owner[at]
                        runs[i].append(
                            {"lang": m.languages[label[at]], "word": int(at - base[i]), "words": int(n), "letters": int(c)}
                        )
            arrays = [batch[c] for c in kept] + [pa.array(names, pa.string()), pa.array(score, pa.float64())]
            if spans:
                arrays.append(pa.array(runs, span_type))
            yield pa.RecordBatch.from_arrays(arrays, names=kept + added)

    return df.select(*kept).mapInArrow(run, schema)
