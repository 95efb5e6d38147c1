"""Index, explore and follow collections of pages and symbols with Spark DataFrames."""

from . import functions, operators, plans, sources, streaming
from .session import local_session

__all__ = ["functions", "local_session", "operators", "plans", "sources", "streaming"]
