"""Retrieval, prompts and answers for a table of questions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.constants import (
    DEFAULT_TOP_K,
    PROMPT_HEAD,
    PROMPT_QUESTION,
    PROMPT_TAIL,
    REPLY_PATHS,
    TEMPERATURE,
)
from doclake.functions.messages import parse_reply
from doclake.operators.features import embed_query
from doclake.operators.similarity import topk_similar
from doclake.operators.vector_index import VectorIndex

# A factory opens a provider's client and returns a function
# (prompt, temperature) -> raw JSON reply.
ClientFactory = Callable[[], Callable[[str, float], str]]


def retrieve(
    documents: DataFrame | VectorIndex,
    questions: DataFrame,
    k: int = DEFAULT_TOP_K,
    question: str = "question",
    question_key: str = "question_id",
    doc_key: str = "file_name",
    **embedding,
) -> DataFrame:
    """The best ``k`` documents for each question text.

    ``documents`` hold ``embedding``, or are a stored index of them; ``embedding``
    options go to the encoder, which must be the one the documents were encoded with.
    """
    asked = embed_query(questions, question, target="embedding", **embedding)
    if isinstance(documents, VectorIndex):
        return documents.search(asked, k, question_key)
    return topk_similar(documents, asked, k, doc_key, question_key)


def with_texts(
    hits: DataFrame, documents: DataFrame, doc_key: str = "file_name", text: str = "text_clean"
) -> DataFrame:
    """Add the text of each hit. Texts are read only here, not while scoring.

    Each question has at most ``k`` hits; adaptive execution broadcasts them
    where they are few, and splits often-hit documents where they are many.
    """
    return hits.join(documents.select(doc_key, text), doc_key)


def build_prompt(
    hits: DataFrame,
    questions: DataFrame,
    question: str = "question",
    question_key: str = "question_id",
    doc_key: str = "file_name",
    text: str = "text_clean",
    max_chars: int | None = None,
) -> DataFrame:
    """One prompt per question from its ranked hits with texts.

    Texts go in whole; ``max_chars`` cuts each one for a model with a bounded
    context. A question has at most ``k`` hits, so its list is short.
    """
    body = F.col(text) if max_chars is None else F.substring(text, 1, max_chars)
    chunk = F.concat(F.lit("["), F.col(doc_key).cast("string"), F.lit("]\n"), body)
    ranked = hits.groupBy(question_key).agg(
        F.sort_array(F.collect_list(F.struct("rank", chunk.alias("chunk")))).alias("_chunks")
    )
    context = F.array_join(
        F.transform(F.coalesce("_chunks", F.array()), lambda c: c["chunk"]), "\n\n"
    )
    prompt = F.concat(
        F.lit(PROMPT_HEAD), context, F.lit(PROMPT_QUESTION), F.col(question), F.lit(PROMPT_TAIL)
    )
    return questions.join(ranked, question_key, "left").select(
        question_key, question, prompt.alias("prompt")
    )


def generate_answers(
    prompts: DataFrame,
    clients: dict[str, ClientFactory],
    provider: str,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """Add ``answer`` from the provider's client, one client per task.

    An unknown provider name uses the first known one.
    """
    provider = provider.lower()
    if provider not in REPLY_PATHS:
        provider = next(iter(REPLY_PATHS))
    factory = clients[provider]

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = factory()
        for texts in batches:
            yield pd.Series([client(t, temperature) for t in texts], index=texts.index)

    replies = prompts.withColumn("_reply", ask("prompt"))
    return replies.withColumn("answer", parse_reply("_reply", provider)).drop("_reply")


def answer_questions(
    documents: DataFrame,
    questions: DataFrame,
    clients: dict[str, ClientFactory],
    provider: str,
    k: int = DEFAULT_TOP_K,
    question: str = "question",
    question_key: str = "question_id",
    doc_key: str = "file_name",
    text: str = "text_clean",
    max_chars: int | None = None,
    temperature: float = TEMPERATURE,
    **embedding,
) -> DataFrame:
    """Questions to answers in one plan: retrieve, prompt, ask the provider.

    ``documents`` hold ``embedding`` and the text. The hits are stored once, so
    the questions are encoded and searched a single time.
    """
    hits = retrieve(documents, questions, k, question, question_key, doc_key, **embedding)
    prompts = build_prompt(
        with_texts(hits, documents, doc_key, text), questions, question, question_key, doc_key, text, max_chars
    )
    return generate_answers(prompts, clients, provider, temperature)
