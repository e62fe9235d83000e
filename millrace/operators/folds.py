"""Ordered folds over the steps of a task: repeats, islands, windows of history, state carried along.

Each task is one window partition, in the order of its steps; a task's steps are bounded by its length. Where state
reaches across kinds of rows (files written earlier), the last value before a row stands for the memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def signature(action: Column, fields: list[str]) -> Column:
    """Canonical JSON of an action: keys in order, nulls left out."""
    return F.to_json(F.struct(*[action[f].alias(f) for f in sorted(fields)]))


def repeats(df: DataFrame, task: str, order: list[str], sig: Column) -> DataFrame:
    """Rows with ``repeated``: whether the row before in the task has an equal signature."""
    w = Window.partitionBy(task).orderBy(*order)
    return df.withColumn("_sig", sig).withColumn("repeated", F.coalesce(F.col("_sig") == F.lag("_sig").over(w), F.lit(False))).drop("_sig")


def islands(df: DataFrame, task: str, order: list[str], kind: Column) -> DataFrame:
    """Runs of rows of one kind: (task, kind, island, first, last, n), first and last by the first order column."""
    w = Window.partitionBy(task).orderBy(*order)
    x = df.withColumn("_k", kind).withColumn("_new", F.when(F.col("_k").eqNullSafe(F.lag("_k").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1))
    x = x.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(task, F.col("_k").alias("kind"), "island").agg(F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count("*").alias("n"))


def carried(df: DataFrame, task: str, order: list[str], value: Column, name: str) -> DataFrame:
    """The last non-null ``value`` of the rows before, within the task."""
    w = Window.partitionBy(task).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def remembered(df: DataFrame, task: str, order: list[str], key: Column, value: Column, name: str) -> DataFrame:
    """The last value stored under the row's own key by a row before, within the task."""
    w = Window.partitionBy(task, "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_key", key).withColumn(name, F.last(value, ignorenulls=True).over(w)).drop("_key")


def trailing(df: DataFrame, task: str, order: list[str], item: Column, before: int, name: str) -> DataFrame:
    """The items of the ``before`` rows in front of each row and of the row itself, as an array."""
    return df.withColumn(name, F.collect_list(item).over(Window.partitionBy(task).orderBy(*order).rowsBetween(-before, 0)))


def history(df: DataFrame, task: str, order: list[str], size: Column, name: str) -> DataFrame:
    """The sum of ``size`` over all rows before, 0 at first: what a prefix of the whole history takes."""
    w = Window.partitionBy(task).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(size).over(w), F.lit(0)).cast("long"))


def breaker(df: DataFrame, task: str, order: list[str], probe: Column, edit: Column, limit: int = 2) -> DataFrame:
    """``probes`` since the last edit and whether they reach ``limit``."""
    w = Window.partitionBy(task).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = df.withColumn("_e", F.sum(F.when(edit, 1).otherwise(0)).over(w))
    v = Window.partitionBy(task, "_e").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("probes", F.sum(F.when(probe, 1).otherwise(0)).over(v).cast("long"))
    return x.withColumn("blocked", F.col("probes") >= limit).drop("_e")


def occurrence(df: DataFrame, task: str, order: list[str], payload: Column, name: str) -> DataFrame:
    """How many times the row's payload came in the task so far, by its digest."""
    w = Window.partitionBy(task, "_d").orderBy(*order)
    return df.withColumn("_d", F.md5(payload)).withColumn(name, F.row_number().over(w).cast("long")).drop("_d")
