"""Incremental pickup of landed files."""

from courtside.streaming.compaction import compact, drop_loads
from courtside.streaming.landing_stream import read_deliveries, read_streamed, stream_landing

__all__ = ["compact", "drop_loads", "read_deliveries", "read_streamed", "stream_landing"]
