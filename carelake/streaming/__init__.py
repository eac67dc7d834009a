"""Structured Streaming forms of the incremental loads."""

from carelake.streaming.streams import *  # noqa: F401,F403
