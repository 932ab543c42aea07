"""Structured Streaming jobs over the ad-click log and over user behaviour."""

from . import adclicks, arrivals, behaviour, sliding

__all__ = ["adclicks", "arrivals", "behaviour", "sliding"]
