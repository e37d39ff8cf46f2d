"""Feeds that keep arriving."""

from rollcall.streaming.feeds import stream_feed, stream_into

__all__ = ["stream_feed", "stream_into"]
