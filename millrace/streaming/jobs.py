"""Structured Streaming: tailing JSON lines, windows with watermarks, keyed state, idempotent sinks.

The reference polls a growing file; here a directory is a stream with a checkpoint, so every line counts once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

RESULT = "task_id string, repo string, resolved boolean, test_exit_code int, tool_calls int, duration_seconds double"


def windowed(events: DataFrame, time: str, width: str, late: str | None = None) -> DataFrame:
    """Counts and sums by tumbling window and type, for tables and streams; ``late`` sets the watermark of a stream."""
    x = events.withWatermark(time, late) if late else events
    out = x.groupBy(F.window(time, width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str) -> DataFrame:
    """Session windows of a stream."""
    x = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key)
    return x.agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")


def json_lines(spark: SparkSession, folder: str, schema: str = RESULT) -> DataFrame:
    """A folder of JSON lines as a stream; blank lines and lines that are no JSON object are left out."""
    raw = spark.readStream.text(folder)
    parsed = raw.where(F.trim("value") != "").select(F.from_json("value", schema).alias("r"), F.expr("try_parse_json(value)").alias("v"))
    return parsed.where(F.expr("schema_of_variant(v) like 'OBJECT%'")).select("r.*")


def tail_summary(results: DataFrame) -> DataFrame:
    """Running totals of results by repository."""
    return results.groupBy("repo").agg(F.count("*").alias("total"), F.sum(F.col("resolved").cast("long")).alias("resolved_n"), F.round(F.avg("duration_seconds"), 4).alias("mean_seconds"))


def run_available(df: DataFrame, sink_folder: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Works off what is there and ends; a second call goes on from the checkpoint."""
    q = df.writeStream.format("parquet").option("path", sink_folder).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def complete_available(df: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Works off what is there; each batch replaces the table by the whole result, so a repeated batch changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(folder)

    q = df.writeStream.foreachBatch(write).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's files as a stream; times without a zone become instants, which event times have to be."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    x = spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")
    return x.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in schema])


def upsert_available(df: DataFrame, folder: str, key: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once table of one row per key: each batch is written under its own number, so a repeated batch
    replaces itself; readers take the last batch of a key with ``read_upserts``."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates([key]).withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    q = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def read_upserts(spark: SparkSession, folder: str, key: str) -> DataFrame:
    from millrace.operators.dedup import latest

    return latest(spark.read.option("recursiveFileLookup", "true").parquet(folder), key, "_batch").drop("_batch")


def probe_breaker(events: DataFrame, key: str, kind: str, probes: int = 2) -> DataFrame:
    """Keyed state on a stream: how many probes came since the last edit, and whether the breaker is open."""

    def step(keys: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        for frame in frames:
            for k in frame[kind]:
                n = 0 if k in ("edit_file", "write_file") else n + 1
        state.update((n,))
        yield pd.DataFrame({key: [keys[0]], "probes": [n], "blocked": [n >= probes]})

    kind_of = events.schema[key].dataType.simpleString()
    return events.groupBy(key).applyInPandasWithState(step, f"{key} {kind_of}, probes long, blocked boolean", "n long", "update", "NoTimeout")
