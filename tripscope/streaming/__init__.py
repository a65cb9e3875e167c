"""Streaming forms of the jobs.

The reference runs only static batch reads (no readStream, watermark or
state anywhere), so there are no streaming operators to rebuild; the one
module here runs the preparation job incrementally over arriving raw
files, with the batch operator unchanged.
"""

from tripscope.streaming.ingest import raw_trip_stream, start_prepare_stream

__all__ = ["raw_trip_stream", "start_prepare_stream"]
