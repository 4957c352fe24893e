"""Incremental ingest of landed payload files with Structured Streaming.

The reference refreshes by re-running collection in full.  Here a refresh
can also run incrementally: new daily-array payload files landing in a
folder are parsed by the same A2 operator and appended to the raw stage
table, exactly once, with the stream's progress kept in the shared folder
(``availableNow`` processes what has landed and stops).
"""

from citytherm.streaming.ingest import start_daily_ingest

__all__ = ["start_daily_ingest"]
