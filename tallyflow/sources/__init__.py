"""Sources: driver tables, message adapters, literal rows, stream reader."""

from tallyflow.sources.tables import table, TABLES
from tallyflow.sources import adapters
from tallyflow.sources.literal import literal_rows, request_strings
from tallyflow.sources.streams import StreamSpec, read_stream

__all__ = ["table", "TABLES", "adapters", "literal_rows", "request_strings",
           "StreamSpec", "read_stream"]
