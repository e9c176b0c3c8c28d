"""Structured Streaming: steady-rate insertion of new-user events."""

from keyledger.streaming.live_insert import *  # noqa: F401,F403
