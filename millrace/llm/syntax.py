"""Problem 4: source files that do not parse.

Each file goes through the recursive-descent recogniser of its language (by the extension of its path, in any case):
statements by descent, expressions by precedence climbing, panic-mode recovery after an error. All errors are stored,
with the first cause. The pass is narrow (no shuffle of texts). Null paths, null contents and other extensions give no
row; an empty text is valid Python, TOML and JavaScript, and no JSON.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.datasyntax import json_errors, toml_errors
from millrace.llm.jssyntax import js_errors
from millrace.llm.pysyntax import python_errors

LANGUAGES = {"py": "python", "pyi": "python", "json": "json", "ipynb": "json", "toml": "toml", "js": "javascript"}
_PARSERS = {"python": python_errors, "json": json_errors, "toml": toml_errors, "javascript": js_errors}
SCHEMA = "id long, repo string, language string, n_errors int, first_line int, first_error string, errors array<struct<line:int,message:string>>"


def errors_of(language: str, text: str) -> list[tuple[int, str]]:
    """All errors of a text as (line, message), in order."""
    return _PARSERS[language](text)


def check_files(df: DataFrame, id_col: str, path_col: str, text_col: str, repo_col: str) -> DataFrame:
    """One row per file of a known language: its errors, their number and the first."""
    ext = F.regexp_extract(F.lower(F.trim(F.col(path_col))), r"\.([a-z0-9]+)$", 1)
    lang = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])[ext]
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(repo_col).alias("repo"), lang.alias("language"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("language").isNotNull() & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("line", pa.int32()), ("message", pa.string())]))
        for batch in batches:
            found = [errors_of(la.as_py(), tx.as_py()) for la, tx in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2), pa.array(map(len, found), pa.int32()),
                    pa.array([e[0][0] if e else None for e in found], pa.int32()), pa.array([e[0][1] if e else None for e in found], pa.string()),
                    pa.array([[{"line": a, "message": b} for a, b in e] for e in found], kind),
                ],
                names=["id", "repo", "language", "n_errors", "first_line", "first_error", "errors"],
            )

    return rows.mapInArrow(run, SCHEMA)


def step_files(steps: DataFrame) -> DataFrame:
    """The checked ``write_file`` actions; rows delivered again are left in."""
    a = F.col("action")
    writes = steps.where(a.action_type == "write_file").select("step_id", "repo", a.filepath.alias("path"), a.content.alias("content"))
    return check_files(writes, "step_id", "path", "content", "repo")


def invalid_steps(steps: DataFrame) -> DataFrame:
    """(step_id) of the actions whose content does not parse."""
    return step_files(steps).where("n_errors > 0").select(F.col("id").alias("step_id")).distinct()


def error_table(steps: DataFrame) -> DataFrame:
    """Every invalid file with its errors and first cause, once for each step."""
    bad = step_files(steps).where("n_errors > 0")
    return bad.dropDuplicates(["id"]).select(F.col("id").alias("step_id"), "repo", "language", "n_errors", "first_line", "first_error", F.to_json("errors").alias("errors"))


def rates(steps: DataFrame) -> DataFrame:
    """Files, invalid files and their share per repository and language; null repositories are one of their own."""
    once = step_files(steps).groupBy("id").agg(F.min("repo").alias("repo"), F.min("language").alias("language"), F.max(F.col("n_errors") > 0).alias("bad"))
    out = once.groupBy("repo", "language").agg(F.count("*").alias("files"), F.sum(F.col("bad").cast("long")).alias("invalid"))
    return out.withColumn("invalid_rate", F.round(F.col("invalid") / F.col("files"), 6))
