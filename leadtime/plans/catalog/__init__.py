"""The registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from leadtime.plans.bindings import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FAMILIES = ("stores", "cleaning", "features", "quality", "evaluation", "registry", "streams", "learning")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with its SQL twin if there is one."""

    def wrap(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build

    return wrap


def load() -> None:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")
