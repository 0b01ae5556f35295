"""Structured Streaming: incremental version history from a change stream."""

from ledgerline.streaming.history_stream import ChangeLogHistory, stream_history

__all__ = ["ChangeLogHistory", "stream_history"]
