"""The late-arrival merge as a stream over the landing folder."""

from revlens.streaming.incremental import merge_arrivals

__all__ = ["merge_arrivals"]
