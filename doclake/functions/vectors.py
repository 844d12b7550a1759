"""Vectors stored as arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from doclake.functions.text import bind, col_of


def dot(a: Column | str, b: Column | str) -> Column:
    """The inner product; vectors of different widths are an error."""
    products = F.zip_with(
        col_of(a), col_of(b), lambda x, y: x.cast("double") * y.cast("double")
    )
    alike = F.size(col_of(a)) == F.size(col_of(b))
    total = F.aggregate(products, F.lit(0.0), lambda total, p: total + p)
    return F.when(col_of(a).isNull() | col_of(b).isNull() | alike, total).otherwise(
        F.raise_error(F.lit("vectors of different widths"))
    )


def norm(a: Column | str) -> Column:
    squares = F.aggregate(
        col_of(a), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def cosine_score(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; a zero vector scores 0."""
    return dot(a, b) / (norm(a) * norm(b) + F.lit(1e-9))


def l2_normalise(a: Column | str) -> Column:
    """The vector at unit length; a zero vector stays as it is."""
    return bind(
        norm(a),
        lambda length: F.transform(
            col_of(a),
            lambda x: F.when(length > 0, x.cast("double") / length).otherwise(x.cast("double")),
        ),
    )


def embedding_dims(a: Column | str) -> Column:
    """Number of dimensions, NULL for a missing vector."""
    a = col_of(a)
    return F.when(a.isNotNull(), F.size(a))
