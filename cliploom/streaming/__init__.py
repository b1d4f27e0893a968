"""Structured Streaming over frames that arrive in time order, an extension to the batch operators."""

from cliploom.streaming.clips import instants, micros, running_velocity, sessions, settled

__all__ = ["instants", "micros", "running_velocity", "sessions", "settled"]
