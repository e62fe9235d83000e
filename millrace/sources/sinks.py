"""Sinks: JSON lines, CSV, rejects, checkpoints of ids, metadata. Spark's commit protocol makes them atomic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import _file_system, exists


def json_lines(df: DataFrame, folder: str, order: list[Column] | None = None, mode: str = "overwrite") -> None:
    """JSON lines in the order given: range-partitioned, so the files in name order hold the whole order."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df).write.mode(mode).option("ignoreNullFields", "false").json(folder)


def csv(df: DataFrame, folder: str, order: list[Column] | None = None) -> None:
    (df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df).write.mode("overwrite").option("header", True).csv(folder)


def split_rejects(df: DataFrame, reason: str, accepted: str, rejected: str) -> None:
    """Rows without a reason go to ``accepted``, the others with their reason to ``rejected``; the input is computed once."""
    kept = df.persist()
    try:
        kept.where(F.col(reason).isNull()).drop(reason).write.mode("append").parquet(accepted)
        kept.where(F.col(reason).isNotNull()).write.mode("append").parquet(rejected)
    finally:
        kept.unpersist()


def processed(spark: SparkSession, folder: str, key: str, kind: str = "string") -> DataFrame:
    """Ids that are worked off, empty before the first run."""
    return spark.read.parquet(folder).select(key).distinct() if exists(spark, folder) else spark.createDataFrame([], f"{key} {kind}")


def resume(df: DataFrame, key: str, folder: str) -> DataFrame:
    """Rows whose id isn't worked off yet."""
    return df.join(processed(df.sparkSession, folder, key, df.schema[key].dataType.simpleString()), key, "left_anti")


def mark_processed(df: DataFrame, key: str, folder: str) -> None:
    df.select(key).distinct().write.mode("append").parquet(folder)


def metadata(df: DataFrame, text: str, groups: dict[str, str]) -> DataFrame:
    """One row: rows, greatest length, and per named column a map of counts."""
    out = df.agg(F.count("*").alias("total"), F.coalesce(F.max(F.length(text)), F.lit(0)).alias("most_chars"))
    for name, col in groups.items():
        counts = df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit("None")).alias("k")).agg(F.count("*").alias("n"))
        out = out.join(counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(name)), F.lit(True))
    return out


def artefacts(whole: DataFrame, folder: str, parts: dict) -> None:
    """A table and tables made from it (folder -> function), all from what was written first: nothing is computed twice."""
    whole.write.mode("append").parquet(folder)
    back = whole.sparkSession.read.schema(whole.schema).parquet(folder)
    for path, make in parts.items():
        make(back).write.mode("append").parquet(path)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file of the driver's."""
    p, fs = _file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
