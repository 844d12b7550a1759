from doclake.streaming.documents import (
    arrival,
    classify_stream,
    stream_classify,
    stream_run,
    stream_upsert,
)

__all__ = ["arrival", "classify_stream", "stream_classify", "stream_run", "stream_upsert"]
