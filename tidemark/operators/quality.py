"""Data tests: each gives the failing rows, so an empty result passes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that stand more than once; null keys are not compared."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return df.filter(whole).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, with how often; nulls pass."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def violations(df: DataFrame, tests: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """(test, failures) for every test."""
    out = None
    for name, test in tests.items():
        row = test(df).agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures")
        out = row if out is None else out.unionByName(row)
    return out


class ModelGraph:
    """Named models with their inputs and tests; runs in dependency order and
    stops at the first model whose tests find a row."""

    def __init__(self) -> None:
        self.models: dict[str, tuple[list[str], Callable, dict]] = {}

    def add(self, name: str, inputs: list[str], build: Callable[..., DataFrame], tests: dict | None = None) -> None:
        self.models[name] = (inputs, build, tests or {})

    def order(self) -> list[str]:
        done: list[str] = []
        waiting = dict.fromkeys(self.models)
        while waiting:
            ready = [n for n in waiting if all(i in done or i not in self.models for i in self.models[n][0])]
            if not ready:
                raise ValueError(f"models depend on one another: {', '.join(waiting)}")
            for n in ready:
                done.append(n)
                del waiting[n]
        return done

    def run(self, sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
        made = dict(sources)
        for name in self.order():
            inputs, build, tests = self.models[name]
            made[name] = build(*[made[i] for i in inputs])
            for label, test in tests.items():
                if not test(made[name]).isEmpty():
                    raise AssertionError(f"{name}: {label} has failing rows")
        return made
