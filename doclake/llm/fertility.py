"""Quality rules on how well a public tokenizer's vocabulary fits a text.

Three figures of a text: characters per token, the share of tokens that are
single bytes (the fallback for characters outside the vocabulary), and the
entropy of its tokens against that of evenly used ones. Texts of one
language (or script, where none is given) lie close together; bands around the
middle of each language, learned from all its texts, reject what lies far off.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.language import _SCRIPT, _STARTS
from doclake.llm.common import factorize, hash_words, set_aside, slices, tokenizer_path
from doclake.session import cut_lineage

VOCABULARY = "piece_bpe_32k.model"
CACHED_WORDS = 250_000
BAND = 6.0  # widths of the middle half on either side of the median
LEAST_WIDTH = {"chars_per_token": 0.08, "byte_share": 0.01, "entropy_share": 0.03}
LEAST_TOKENS = 200  # of the texts that bands are learned from; for shorter ones bands are wider
LEAST_TEXTS = 20  # a language with fewer has the bands of its script, then those of all texts
METRICS = tuple(LEAST_WIDTH)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# The words of the base rules, and symbols.
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_SYMBOL = re.compile(r"[^#*$%&|<>]+")
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20


def repeated_words(words: list[str], hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a run of ``width`` words found twice or more in the text."""
    n = len(words)
    if n <= width:
        return 0
    runs = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - width + 1 + k]
    order = np.argsort(runs, kind="stable")
    same = runs[order[1:]] == runs[order[:-1]]
    if not same.any():
        return 0
    # equal hashes are compared word by word
    seen = Counter(tuple(words[i : i + width]) for i in np.unique(np.r_[order[1:][same], order[:-1][same]]))
    covered = np.zeros(n + 1, dtype=np.int64)
    for i in np.unique(np.r_[order[1:][same], order[:-1][same]]):
        if seen[tuple(words[i : i + width])] > 1:
            covered[i] += 1
            covered[min(n, i + width)] -= 1
    return int((np.cumsum(covered)[:n] > 0).sum())


def base_counts(text: str | None, words: list[str], hashes: np.ndarray) -> tuple[int, ...]:
    """The figures of the base rules; a null text has none of anything."""
    if not text:
        return 0, 0, 0, 0, 0
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(_NOT_SYMBOL.sub("", text)),
        len(lines) - len(set(lines)),
        repeated_words(words, hashes),
    )


class Pieces(dict):
    """Token ids of a word; emptied at ``CACHED_WORDS`` words."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])

    def learn(self, words: list[str]) -> None:
        """Encode the words that are not in the table, all in one call."""
        missing = [w for w in words if w not in self]
        if len(self) + len(missing) > CACHED_WORDS:
            self.clear()
            missing = words
        if missing:
            for word, ids in zip(missing, self.model.encode(missing, num_threads=1)):
                self[word] = np.array(ids, dtype=np.int32)


_TABLES: dict[str, Pieces] = {}  # of one Python worker, kept between its tasks


def token_figures(ids: np.ndarray, chars: int, is_byte: np.ndarray) -> tuple[int, float, float, float]:
    """Number of tokens, characters per token, byte share and entropy share."""
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    counts = np.bincount(ids)
    counts = counts[counts > 0] / n
    entropy = -float((counts * np.log(counts)).sum())
    most = np.log(max(2, len(counts)))
    return n, chars / n, float(is_byte[ids].mean()), entropy / most


def main_script(text: str | None) -> int | None:
    """The number of the script of most letters."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters, n = np.unique(codes, return_counts=True)
    alpha = np.array([chr(c).isalpha() for c in letters], dtype=bool)
    if not alpha.any():
        return None
    kinds = _SCRIPT[np.maximum(0, np.searchsorted(_STARTS, letters[alpha], side="right") - 1)]
    return int(np.bincount(kinds, weights=n[alpha]).argmax())


OWN_COLUMNS = ("_text", "_script", "_own", "_own_by", "_script_band", "_script_band_by", "_all", "_bands", "_n")


def measure(df: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``df`` without the text, with the base counts, ``n_tokens`` and the three figures.

    Columns of these names are replaced.
    """
    added = [*BASE, "n_tokens", *METRICS, "_script"]
    kept = [c for c in df.columns if c not in (text, *added)]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept]
    fields += [f"{c} long" for c in (*BASE, "n_tokens")] + [f"{c} double" for c in METRICS] + ["_script int"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary or tokenizer_path(VOCABULARY)
        pieces = _TABLES.get(path)
        if pieces is None:
            pieces = _TABLES[path] = Pieces(path)
        for batch in slices(batches, "_text"):
            texts = batch["_text"].to_pylist()
            words = [_WORD.findall(t) if t else [] for t in texts]
            code, distinct = factorize([w for ws in words for w in ws])
            hashes = hash_words(distinct)[code] if distinct else np.empty(0, dtype=np.uint64)
            pieces.learn(distinct)
            ids = [pieces[w] for w in distinct]
            rows, start = [], 0
            for t, ws in zip(texts, words):
                own = code[start : start + len(ws)]
                base = base_counts(t, ws, hashes[start : start + len(ws)])
                start += len(ws)
                joined = np.concatenate([ids[i] for i in own]) if len(ws) else np.empty(0, np.int32)
                rows.append(base + token_figures(joined, base[1], pieces.is_byte))
            columns = list(zip(*rows))
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [
                pa.array(c, pa.float64()) for c in columns[6:]
            ]
            arrays.append(pa.array([main_script(t) for t in texts], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch[c] for c in kept] + arrays, names=kept + added)

    return df.select(*kept, F.col(text).alias("_text")).mapInArrow(run, ", ".join(fields))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def judge(measured: DataFrame, group: str = "lang", band: float = BAND) -> DataFrame:
    """``measured`` with ``base_failed``, ``kept`` and the name of the first band missed.

    ``measured`` should be stored, since it is read for the bands and for the
    verdicts. Bands come from all texts of a group that pass the base rules and
    have ``LEAST_TOKENS`` tokens: median and quartiles, which Spark merges from
    partial summaries of bounded size. A group of fewer than ``LEAST_TEXTS`` of
    them has the bands of the text's script, or else those of all texts. Bands of
    texts with fewer tokens are wider by the root of how many they lack. Texts
    without a group form one.
    """
    rows = measured.withColumn("base_failed", base_failed())
    counted = rows.filter(~F.col("base_failed") & (F.col("n_tokens") >= LEAST_TOKENS))

    def bands(level: str, *by: str) -> DataFrame:
        figures = [F.percentile_approx(m, [0.25, 0.5, 0.75], 1000).alias(m) for m in METRICS]
        found = counted.groupBy(*[F.col(c).alias(f"_{level}_by") for c in by]).agg(
            F.count(F.lit(1)).alias("_n"), *figures
        )
        found = found.filter(F.col("_n") >= LEAST_TEXTS)
        return found.select(*[f"_{level}_by" for _ in by], F.struct(*METRICS).alias(f"_{level}"))

    joined = (
        rows.join(bands("own", group), F.col(group).eqNullSafe(F.col("_own_by")), "left")
        .join(bands("script_band", "_script"), F.col("_script").eqNullSafe(F.col("_script_band_by")), "left")
        .join(F.broadcast(bands("all")), F.lit(True), "left")
        .withColumn("_bands", F.coalesce("_own", "_script_band", "_all"))
    )
    wider = F.sqrt(F.greatest(F.lit(1.0), LEAST_TOKENS / F.greatest(F.lit(1), F.col("n_tokens"))))
    reasons = []
    for m in METRICS:
        low, middle, high = (F.col(f"_bands.{m}")[i] for i in range(3))
        width = F.greatest(high - low, F.lit(LEAST_WIDTH[m])) * band * wider
        outside = F.col("_bands").isNotNull() & (F.abs(F.col(m) - middle) > width)
        reasons.append(F.when(outside, F.lit(m)))
    missed = F.when(~F.col("base_failed") & (F.col("n_tokens") > 0), F.coalesce(*reasons))
    return (
        joined.withColumn("band_missed", missed)
        .withColumn("kept", ~F.col("base_failed") & F.col("band_missed").isNull())
        .drop("_own", "_own_by", "_script", "_script_band", "_script_band_by", "_all", "_bands")
    )


def quality_rules(df: DataFrame, text: str = "text", group: str = "lang") -> DataFrame:
    """Measure each text once, store the figures, and judge them."""
    df, named_back = set_aside(df, OWN_COLUMNS)
    return named_back(judge(cut_lineage(measure(df, text)), group))
