"""Importing this module registers every query."""

from tallywork.plans import files, learning, matching, rows, streams, summaries, values  # noqa: F401
from tallywork.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
