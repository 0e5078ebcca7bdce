"""Query registry: a name, a Spark callable and, where SQL can say it, the oracle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countloom.plans.views import Views

Build = Callable[[Views], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.builders: dict[str, Build] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, build: Build, sql: str | None = None) -> None:
        if name in self.builders:
            raise ValueError(f"query registered twice: {name}")
        self.builders[name] = build
        if sql is not None:
            self.oracles[name] = sql

    def merge(self, other: Registry) -> Registry:
        for name, build in other.builders.items():
            self.add(name, build, other.oracles.get(name))
        return self

    def callables(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        def bind(build: Build) -> Callable[[SparkSession, str], DataFrame]:
            return lambda spark, sf: build(Views(spark, sf))

        return {name: bind(build) for name, build in self.builders.items()}


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round the named double columns, so two engines agree on the last bits."""
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def rounded_sql(names: Sequence[str], digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)
