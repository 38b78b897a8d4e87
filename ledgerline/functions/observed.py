"""Figures that are gathered while something is written."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation


def figures(seen: Observation, written: Callable[[], DataFrame]) -> dict:
    """What was observed; nothing for a plan that turned out empty while it ran, of which Spark has no figures."""
    try:
        return seen.get
    except Py4JJavaError:
        if not written().isEmpty():
            raise
        return {}
