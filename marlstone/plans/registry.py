"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Registered(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None = None):
    """Add a query of (spark, folder of the test tables) with the SQL that checks it."""

    def add(run):
        REGISTRY[name] = Registered(run, sql)
        return run

    return add
