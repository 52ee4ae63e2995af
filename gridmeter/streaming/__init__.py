"""Incremental harvesting driven by a file stream of landed report records."""

from gridmeter.streaming.incremental import harvest_stream

__all__ = ["harvest_stream"]
