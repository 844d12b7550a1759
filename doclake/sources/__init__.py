from doclake.sources.files import scan_files
from doclake.sources.streams import kafka_options, stream_source
from doclake.sources.tables import from_rows, scan_catalog, scan_csv, scan_parquet

__all__ = [
    "from_rows",
    "kafka_options",
    "scan_catalog",
    "scan_csv",
    "scan_files",
    "scan_parquet",
    "stream_source",
]
