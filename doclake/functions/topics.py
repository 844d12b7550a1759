"""Topic choice and extractive summaries as expressions over one text."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from doclake.constants import SHORT_TEXT_CHARS, UNKNOWN_TOPIC
from doclake.functions.text import bind, col_of, words

# Words that speak for each topic label. Only the labels are given; callers
# with better word lists or a model pass their own.
DEFAULT_LEXICON: dict[str, tuple[str, ...]] = {
    "economia": ("economia", "econômico", "econômica", "pib", "crescimento"),
    "imóveis": ("imóveis", "imóvel", "imobiliário", "construção", "residencial"),
    "inflação": ("inflação", "ipca", "incc", "preços", "índice"),
    "mercado financeiro": ("mercado", "financeiro", "juros", "crédito", "bolsa"),
    "política": ("política", "governo", "congresso", "lei", "eleição"),
    "tecnologia": ("tecnologia", "digital", "software", "dados", "internet"),
}


def _one_of(terms: Sequence[str]) -> Callable[[Column], Column]:
    return lambda word: word.isin(*terms)


def classify_topic(
    text: Column | str, lexicon: Mapping[str, Sequence[str]] = DEFAULT_LEXICON
) -> Column:
    """The label whose words occur most often; ties go to the earlier label.

    The text is split once and reduced to lexicon words before the labels
    count them.
    """
    text = col_of(text)
    vocabulary = sorted({w for terms in lexicon.values() for w in terms})

    def best(hits: Column) -> Column:
        ranked = [
            F.struct(
                F.size(F.filter(hits, _one_of(terms))).alias("hits"),
                F.lit(-place).alias("place"),
                F.lit(label).alias("label"),
            )
            for place, (label, terms) in enumerate(lexicon.items())
        ]
        return F.array_max(F.array(*ranked))["label"]

    hits = F.filter(words(text), _one_of(vocabulary))
    return F.when(F.coalesce(text, F.lit("")) == "", UNKNOWN_TOPIC).otherwise(bind(hits, best))


def _sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+")


def _neighbours(items: Column) -> Column:
    """``(cur, prev, next)`` for every place of a list."""

    def with_previous(pairs: Column) -> Column:
        shifted = F.concat(F.array(F.get(pairs, F.lit(-1))), pairs)
        triples = F.zip_with(
            pairs,
            shifted,
            lambda p, before: F.struct(
                p["cur"].alias("cur"), before["cur"].alias("prev"), p["next"].alias("next")
            ),
        )
        return F.filter(triples, lambda t: t["cur"].isNotNull())

    paired = F.zip_with(
        items,
        F.slice(items, 2, F.greatest(F.size(items), F.lit(1))),
        lambda cur, nxt: F.struct(cur.alias("cur"), nxt.alias("next")),
    )
    return bind(paired, with_previous)


def _scores_by_sorting(terms: Column) -> Column:
    """Shared terms of each sentence from sorted (term, sentence) pairs, n log n in the text."""
    pairs = F.sort_array(
        F.flatten(
            F.transform(
                terms,
                lambda own, place: F.transform(
                    own, lambda w: F.struct(w.alias("term"), place.alias("place"))
                ),
            )
        )
    )

    def shared_places(ordered: Column) -> Column:
        shared = F.filter(
            _neighbours(ordered),
            lambda t: F.coalesce(t["prev"]["term"] == t["cur"]["term"], F.lit(False))
            | F.coalesce(t["next"]["term"] == t["cur"]["term"], F.lit(False)),
        )
        return F.transform(shared, lambda t: t["cur"]["place"])

    # Every place is added once, so that sentences without a point are counted.
    places = F.sort_array(
        F.concat(bind(pairs, shared_places), F.sequence(F.lit(0), F.size(terms) - 1, F.lit(1)))
    )

    def run_ends(ordered: Column) -> Column:
        last = F.zip_with(
            ordered,
            F.slice(ordered, 2, F.size(ordered)),
            lambda cur, nxt: nxt.isNull() | (cur != nxt),
        )
        upto = F.zip_with(
            last, F.sequence(F.lit(1), F.size(ordered)), lambda end, n: F.when(end, n)
        )
        return F.filter(upto, lambda n: n.isNotNull())

    return F.transform(
        bind(bind(places, run_ends), _neighbours),
        lambda t: t["cur"] - F.coalesce(t["prev"], F.lit(0)) - 1,
    )


def extractive_summary(text: Column | str, sentences: int = 2) -> Column:
    """The sentences that share most terms with the rest of the text, in order.

    A sentence scores one point for each distinct term that another sentence
    also uses; ties go to the earlier sentence. All work stays inside the row,
    so no token is shuffled, and grows little more than the text.
    """

    def best(parts: Column) -> Column:
        terms = F.transform(parts, lambda s: F.array_distinct(words(s)))
        ranked = F.sort_array(
            F.transform(
                bind(terms, _scores_by_sorting),
                lambda score, place: F.struct((-score).alias("rank"), place.alias("place")),
            )
        )
        chosen = F.sort_array(
            F.transform(F.slice(ranked, 1, sentences), lambda item: item["place"])
        )
        return F.array_join(F.transform(chosen, lambda place: F.get(parts, place)), " ")

    return bind(_sentences(col_of(text)), best)


def summarise(text: Column | str, short: int = SHORT_TEXT_CHARS, sentences: int = 2) -> Column:
    """NULL gives ``""``, a short text itself, any other its extractive summary."""
    text = F.coalesce(col_of(text), F.lit(""))
    return F.when(F.length(text) < short, text).otherwise(extractive_summary(text, sentences))
