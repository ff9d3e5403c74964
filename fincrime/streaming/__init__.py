"""Streaming: intentionally empty.

The reports this library rebuilds are batch queries over warehouse tables:
no watermark, event-time window, stateful operator or late-data rule appears
in any of them, so no Structured Streaming job is provided.  A report is a
DataFrame function; a caller who needs it on a stream can apply the same
function inside ``foreachBatch``.
"""
