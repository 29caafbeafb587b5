"""Bounded Arrow batches over DataFrames, and event-time windows and sessions over tables and streams of files."""

from .batches import arrow_batches, decode_batches, iter_arrow_batches
from .sessions import session_stream, sessions
from .windows import event_windows, file_stream, run_once, written

__all__ = ["arrow_batches", "decode_batches", "event_windows", "file_stream", "iter_arrow_batches", "run_once", "session_stream",
           "sessions", "written"]
