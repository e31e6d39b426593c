"""Incremental (Structured Streaming) forms of the layer copies."""

from laminar.streaming.raw_stream import stream_land_to_raw

__all__ = ["stream_land_to_raw"]
