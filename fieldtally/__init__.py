"""Analytics operators on Spark DataFrames: order values, shortest paths and motion."""

from fieldtally.session import build_session

__all__ = ["build_session"]
