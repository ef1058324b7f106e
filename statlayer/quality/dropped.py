"""Counts of rows that a step leaves out (P2), taken in the pass that writes what it keeps.

A step names conditions at points of its plan; ``DataFrame.observe`` counts them while the action runs, so
nothing is scanned twice. Points belong into the part of the plan that the action's own tasks run: a range
partitioning samples its input in a job of its own, which would count rows twice, so ``stage`` steps that
need one write their rows first.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "step string, what string, rows bigint"


class Dropped:
    """Counts of one step; ``rows`` waits for the action that runs the observed plan."""

    def __init__(self, step: str):
        self.step, self.points = step, []

    def watch(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """The frame, and in its next action the number of rows for which each condition holds."""
        point = Observation(f"{self.step} {uuid.uuid4().hex}")
        self.points.append((point, list(conditions)))
        return df.observe(point, *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()])

    def tally(self, df: DataFrame, **numbers: Column) -> DataFrame:
        """Like ``watch`` where a row stands for several that are left out: the sum of each whole number."""
        point = Observation(f"{self.step} {uuid.uuid4().hex}")
        self.points.append((point, list(numbers)))
        return df.observe(point, *[F.coalesce(F.sum(n.cast("long")), F.lit(0)).alias(name) for name, n in numbers.items()])

    def rows(self) -> list[tuple[str, str, int]]:
        """(step, what, rows) in the order of the plan; a point whose plan was proven empty counts nothing."""
        return [(self.step, name, int(point.get.get(name, 0))) for point, names in self.points for name in names]


def watched(dropped: Dropped | None, df: DataFrame, **conditions: Column) -> DataFrame:
    """``watch`` if anybody counts, else the frame as it is."""
    return dropped.watch(df, **conditions) if dropped else df


def report(spark: SparkSession, *steps: Dropped) -> DataFrame:
    """The counts of some steps as a table (one row a step and condition)."""
    return spark.createDataFrame([r for s in steps for r in s.rows()], SCHEMA)
