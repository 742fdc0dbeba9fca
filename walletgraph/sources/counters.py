"""Row counters of the steps of a run, filled by the jobs that run anyway."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Counters:
    """Counts rows as they pass a step; a retried task is not counted twice, and no step is run for its count."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def rows(self, df: DataFrame, name: str, **also: Column) -> DataFrame:
        """df, whose next action counts its rows as `name`, and as `name.other` those that a condition in `also` holds for."""
        self._seen[name] = Observation()
        return df.observe(self._seen[name], F.count(F.lit(1)).alias(name), *(F.count_if(c).alias(f"{name}.{x}") for x, c in also.items()))

    def counts(self) -> dict[str, int]:
        """Of all steps, which must have run."""
        return {k: v for o in self._seen.values() for k, v in o.get.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.counts().items()), "name string, n long")
