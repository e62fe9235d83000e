"""Unified diffs as tables: files, added and removed lines, status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import is_single_python_patch, is_test_file, patch_files


def file_stats(df: DataFrame, key: str, patch: str) -> DataFrame:
    """(key, path, added, removed, status) per file of each diff; status A, D or M by /dev/null on a side.

    Lines are counted inside the file's section, headers aside; a null or empty diff has no files."""
    sections = F.filter(F.split(F.concat(F.lit("\n"), F.col(patch)), r"\ndiff --git "), lambda s: s != "")
    x = df.where(F.col(patch).isNotNull()).select(key, F.explode(sections).alias("s"))
    ls = F.split("s", "\n")
    body = lambda sign, head: F.size(F.filter(ls, lambda l: l.startswith(sign) & ~l.startswith(head))).cast("long")
    x = x.select(
        key,
        F.regexp_extract("s", r"^a/(\S+)", 1).alias("path"),
        body("+", "+++ ").alias("added"),
        body("-", "--- ").alias("removed"),
        F.when(F.col("s").contains("\n--- /dev/null"), "A").when(F.col("s").contains("\n+++ /dev/null"), "D").otherwise("M").alias("status"),
    )
    return x.where("path <> ''")


def readiness(df: DataFrame, key: str, patch: str) -> DataFrame:
    """(key, files, single_python, touches_tests, state): the first that holds of empty, tests only, wide, ready."""
    files = patch_files(F.col(patch))
    x = df.select(key, files.alias("f"), is_single_python_patch(F.col(patch)).alias("single_python"))
    tests = F.filter("f", lambda p: is_test_file(p))
    state = F.when(F.size("f") == 0, "empty").when(F.size(tests) == F.size("f"), "tests_only").when(F.size("f") > 1, "wide").otherwise("ready")
    return x.select(key, F.size("f").cast("long").alias("files"), "single_python", (F.size(tests) > 0).alias("touches_tests"), state.alias("state"))
