"""All registered queries."""

from . import documented, forecasts, profiling, relational, series, sources, streams  # noqa: F401
from .core import QUERIES

__all__ = ["QUERIES"]
