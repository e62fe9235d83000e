"""A registry of queries with their SQL; rows that were delivered again count once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.dedup import latest
from millrace.session import table

Query = Callable[[SparkSession, str], DataFrame]


class Plans:
    """Queries by name and the SQL that gives the same rows, where SQL can."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(f: Query) -> Query:
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return keep


def runs(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "run_results"), "result_id", "recorded_at")


def steps(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "translated_steps"), "step_id", "loaded_at")


def points(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "rag_points"), "point_id", "ingested_at")


def refs(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "grounded_refs"), "ref_id", "loaded_at")


RUNS = "runs AS (SELECT * FROM run_results QUALIFY row_number() OVER (PARTITION BY result_id ORDER BY recorded_at DESC) = 1)"
STEPS = "steps AS (SELECT * FROM translated_steps QUALIFY row_number() OVER (PARTITION BY step_id ORDER BY loaded_at DESC) = 1)"
POINTS = "points AS (SELECT * FROM rag_points QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY ingested_at DESC) = 1)"
REFS = "refs AS (SELECT * FROM grounded_refs QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY loaded_at DESC) = 1)"
