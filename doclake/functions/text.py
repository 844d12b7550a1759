"""Text cleaning, trimming, searching and comparing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from doclake.constants import PREFIX_CHARS, WHITE_SPACE

# Everything a cleaned text may not hold: all but letters, numbers, the
# underscore, . , ; : ! ? - and the blank. ASCII comes first, it is tested most.
_NOT_KEPT = r"[^a-zA-Z0-9 \p{L}\p{N}_.,;:!?\-]+"
_KEPT = r"[a-zA-Z0-9 \p{L}\p{N}_.,;:!?\-]+"
_WORD = r"[\p{L}\p{N}]+"


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    Common sub-expressions inside array lambdas are not shared by the
    optimizer; a one-element ``transform`` is.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column | str) -> Column:
    """Drop leading and trailing white space of any kind."""
    return F.btrim(col_of(text), F.lit(WHITE_SPACE))


def collapse_space(text: Column | str) -> Column:
    """Turn every run of white space into one blank and strip the ends."""
    return F.trim(F.regexp_replace(col_of(text), f"[{WHITE_SPACE}]+", " "))


def clean_text(text: Column | str) -> Column:
    """Readable text only; NULL becomes ``""``.

    White space of any kind is among the characters that are not kept, so it
    turns into blanks with them. The ``32;`` artefact is replaced literally:
    the space around it folds away with the rest.
    """
    no_artefact = F.replace(F.coalesce(col_of(text), F.lit("")), F.lit("32;"), F.lit(" "))
    kept = F.regexp_replace(no_artefact, _NOT_KEPT, " ")
    return F.trim(F.regexp_replace(kept, " {2,}", " "))


def lower_trim(text: Column | str) -> Column:
    return F.lower(F.trim(col_of(text)))


def text_length(text: Column | str) -> Column:
    return F.length(col_of(text))


def truncate_text(text: Column | str, purpose: str) -> Column:
    """The prefix a model or preview accepts, by ``purpose`` in ``PREFIX_CHARS``."""
    prefix = F.substring(col_of(text), 1, PREFIX_CHARS[purpose])
    return F.concat(prefix, F.lit("...")) if purpose == "chat_preview" else prefix


def words(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(col_of(text)), F.lit(_WORD), F.lit(0))


def keyword_position(text: Column | str, phrases: Sequence[str]) -> Column:
    """Zero-based position of the first phrase that occurs, ignoring case; -1 if none."""
    folded = F.lower(col_of(text))
    found = [F.nullif(F.locate(p.lower(), folded), F.lit(0)) for p in phrases]
    return F.coalesce(*found, F.lit(0)) - 1


def keyword_context(
    text: Column | str, position: Column | str, before: int = 200, after: int = 600
) -> Column:
    """The window from ``before`` to ``after`` characters around a position."""
    at = col_of(position)
    start = F.greatest(at - before, F.lit(0))
    window = F.substring(col_of(text), start + 1, at + after - start)
    return F.when(at >= 0, window)


def removed_characters(raw: Column | str, cleaned: Column | str) -> Column:
    """Sorted characters of ``raw`` that its ``clean_text`` no longer holds.

    Only a character that is never kept, or one of ``32;`` and the blank, can
    be lost, so the text is reduced to those before it is taken apart.
    """
    raw, cleaned = col_of(raw), col_of(cleaned)
    unkept = F.regexp_replace(raw, _KEPT, "")
    candidates = F.concat(
        F.array_distinct(F.regexp_extract_all(unkept, F.lit("(?s)."), F.lit(0))),
        F.filter(
            F.array(*[F.lit(c) for c in "32; "]), lambda c: F.contains(raw, c)
        ),
    )
    return F.sort_array(F.filter(candidates, lambda c: ~F.contains(cleaned, c)))
