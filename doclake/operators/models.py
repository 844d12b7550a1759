"""Hooks for models and parsers that the caller brings along."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FloatType, StringType

# A factory loads the model and returns a function over a list of texts. It is
# called once per task, never on the driver.
BatchModel = Callable[[], Callable[[list[str]], Sequence]]


def text_model(factory: BatchModel, result: DataType):
    """A vectorised function ``text -> result`` around a caller's model."""

    @F.pandas_udf(result)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = factory()
        for texts in batches:
            yield pd.Series(list(predict(texts.fillna("").tolist())), index=texts.index)

    return apply


def embedding_model(factory: BatchModel):
    return text_model(factory, ArrayType(FloatType()))


def label_model(factory: BatchModel):
    return text_model(factory, StringType())
