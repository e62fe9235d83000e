"""Grouped health and profile aggregations over run results, tasks and steps.

All are one partial and one final aggregation; nulls are counted as SQL counts them, rates of nothing are 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """A rounded share with 0 where there is nothing."""
    return F.round(F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0)), digits)


def count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")


def histogram(df: DataFrame, key: Column, name: str, null: str = "None") -> DataFrame:
    """Counts by the text of a key; null is a class of its own, named."""
    return df.groupBy(F.coalesce(key.cast("string"), F.lit(null)).alias(name)).agg(F.count("*").alias("n"))


def shares(df: DataFrame, key: str, digits: int = 6) -> DataFrame:
    """Counts and shares of the whole by a key; the whole is one row that goes to every task."""
    whole = df.agg(F.count("*").alias("_whole"))
    n = df.groupBy(key).agg(F.count("*").alias("n")).crossJoin(F.broadcast(whole))
    return n.select(key, "n", F.round(F.col("n") / F.col("_whole"), digits).alias("share"))


def banded(value: Column, edges: list[tuple[str, float]], above: str) -> Column:
    """The first band whose upper edge holds the value, else ``above``; null stays null."""
    out = F.lit(above)
    for name, edge in reversed(edges):
        out = F.when(value <= edge, name).otherwise(out)
    return F.when(value.isNotNull(), out)


def quantiles(df: DataFrame, group: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles, with least, greatest and count, by group."""
    aggs = [F.percentile(value, F.lit(p)).alias(n) for n, p in points.items()]
    return df.groupBy(*group).agg(F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), *aggs)


def verdict(df: DataFrame, code: str) -> DataFrame:
    """One row: whether missing results (-1) or failing tests (1) dominate among both."""
    c = F.col(code)
    x = df.agg(F.count("*").alias("total"), count_if(c == -1).alias("minus_one"), count_if(c == 1).alias("exit_one"), count_if(c == 0).alias("zero"))
    failed = F.col("minus_one") + F.col("exit_one")
    x = x.withColumn("other", F.col("total") - failed - F.col("zero")).withColumn("failed", failed)
    pct = lambda n: F.expr(f"coalesce({n} * 100 div nullif(failed, 0), 0)")
    x = x.withColumn("minus_one_pct", pct("minus_one")).withColumn("exit_one_pct", pct("exit_one"))
    out = (
        F.when(F.col("total") == 0, "unavailable")
        .when((F.col("failed") == 0) & (F.col("other") == 0), "no failures")
        .when(F.col("failed") == 0, "mixed")
        .when((F.col("minus_one") > F.col("exit_one")) & (F.col("minus_one_pct") >= 50), "infrastructure")
        .when((F.col("exit_one") > F.col("minus_one")) & (F.col("exit_one_pct") >= 50), "quality")
        .otherwise("mixed")
    )
    return x.withColumn("verdict", out)


def running_rate(df: DataFrame, group: str, order: list[Column], hit: Column) -> DataFrame:
    """Hits so far and rows so far of each group in order."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("seen", F.count("*").over(w)).withColumn("hits", F.sum(F.when(hit, 1).otherwise(0)).over(w))
