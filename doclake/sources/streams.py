"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(brokers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def stream_source(
    spark: SparkSession,
    source: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """An unbounded frame with one message per row in ``value``.

    ``source`` is any stream format that yields ``value``: ``kafka`` in
    production, ``text`` over a folder of message files elsewhere.
    """
    reader = spark.readStream.format(source).options(**(options or {}))
    return reader.load(path) if path else reader.load()
