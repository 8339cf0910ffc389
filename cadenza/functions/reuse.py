"""Column lists that are built once.

A column is a plain expression: the same one serves any frame that has its inputs. The
wide models name hundreds of them, and building each costs a round trip to the JVM, so
the lists are kept for the life of the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext


def reusable(build: Callable) -> Callable:
    """Keep what ``build`` returns per arguments, as long as the JVM lives."""
    kept: dict[tuple, tuple] = {}

    @wraps(build)
    def columns(*args):
        jvm = SparkContext._gateway
        known = kept.get(args)
        if known is None or known[0] is not jvm:
            known = kept[args] = (jvm, build(*args))
        return known[1]

    return columns
