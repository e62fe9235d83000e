"""Global orders without a single task: range partitions, counted, then numbered within."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 1 in a total order (its last column must be unique).

    The placed rows are written once: bounds of ranges are sampled, so a second computation might place rows otherwise."""
    parts = df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    parts = stage(parts.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy(*order))), "ordered")
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n"))  # one row per partition
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return parts.join(F.broadcast(before.select("_p", "_before")), "_p").withColumn(name, F.col("_k") + F.col("_before")).drop("_p", "_k", "_before")
