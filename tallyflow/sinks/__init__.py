"""Sinks: daily-index documents, key/value records, keyed snapshots."""

from tallyflow.sinks.documents import (
    index_documents, write_documents, write_documents_batch)
from tallyflow.sinks.records import to_records, write_records, write_records_stream
from tallyflow.sinks.snapshot import KeyedSnapshot

__all__ = ["index_documents", "write_documents", "write_documents_batch",
           "to_records", "write_records", "write_records_stream", "KeyedSnapshot"]
