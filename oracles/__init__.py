"""The same results in plain SQL, to check the Spark queries against."""

from oracles.queries import ORACLES

__all__ = ["ORACLES"]
