"""JSON messages, provider replies and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from doclake.constants import REPLY_PATHS
from doclake.functions.text import col_of, strip

# The fields of a document message.
MESSAGE_SCHEMA = StructType(
    [
        StructField("file_name", StringType()),
        StructField("text_content", StringType()),
        StructField("content_type", StringType()),
        StructField("title", StringType()),
    ]
)


def parse_json(value: Column | str, schema: StructType = MESSAGE_SCHEMA) -> Column:
    """A struct with the schema's fields; all NULL where the JSON is malformed."""
    return F.from_json(col_of(value).cast("string"), schema)


def parse_reply(raw: Column | str, provider: str) -> Column:
    """The answer inside a provider's JSON reply; unknown providers use the first shape."""
    path = REPLY_PATHS.get(provider.lower(), next(iter(REPLY_PATHS.values())))
    return strip(F.get_json_object(col_of(raw), path))


def ts_to_text(ts: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS``; NULL stays NULL."""
    return F.date_format(col_of(ts), "yyyy-MM-dd HH:mm:ss")


def whole_seconds(ts: Column | str) -> Column:
    return F.date_trunc("second", col_of(ts))


def now_or(now: Column | None) -> Column:
    """The current time unless the caller fixes one."""
    return F.current_timestamp() if now is None else now
