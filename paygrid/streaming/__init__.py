"""Structured Streaming trigger for the batch job (the job itself has no streams)."""

from .refresh import refresh_on_arrival

__all__ = ["refresh_on_arrival"]
