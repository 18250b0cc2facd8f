"""Structured Streaming forms of ingest and of the question loop."""

from chunkwise.streaming.ingest import (compact_store, delete_from_store, ingest_stream, read_store,
                                        run_to_end)
from chunkwise.streaming.questions import answer_stream, open_questions

__all__ = ["ingest_stream", "read_store", "compact_store", "delete_from_store", "run_to_end", "answer_stream",
           "open_questions"]
