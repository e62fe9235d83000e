"""A rule engine: named rules over tables give rows of results; a rule that fails to run is a failure, not a crash."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = "name string, category string, status string, message string, evidence string"


@dataclass(frozen=True)
class Rule:
    """``check`` gives a table of offenders with a column ``offender``; any row fails the rule (or only warns)."""

    name: str
    category: str
    check: Callable[[], DataFrame]
    warn_only: bool = False
    needs_rows: Callable[[], DataFrame] | None = None  # an empty input of these is a failure, not a pass


def run_rules(spark: SparkSession, rules: list[Rule], cap: int = 5) -> DataFrame:
    """One row a rule: PASS, WARN or FAIL with the number of offenders and up to ``cap`` of them, least first."""
    if len({r.name for r in rules}) != len(rules):
        raise ValueError("names of rules must be unique")
    rows = []
    for r in rules:
        try:
            if r.needs_rows is not None and r.needs_rows().isEmpty():
                rows.append((r.name, r.category, "FAIL", "nothing to check", ""))
                continue
            bad = r.check().select(F.col("offender").cast("string"))
            n = bad.count()
            some = [x.offender for x in bad.orderBy("offender").limit(cap).collect()] if n else []
            status = "PASS" if not n else "WARN" if r.warn_only else "FAIL"
            rows.append((r.name, r.category, status, f"{n} offenders", ", ".join(map(str, some)) + (", ..." if n > cap else "")))
        except Exception as e:  # noqa: BLE001  whatever a rule raises is its result
            rows.append((r.name, r.category, "FAIL", f"did not run: {type(e).__name__}", str(e)[:200]))
    return spark.createDataFrame(rows, RESULT)


def exit_code(results: DataFrame, gating: str = "submission") -> int:
    """1 if a rule of the gating category failed."""
    return int(not results.where((F.col("status") == "FAIL") & (F.col("category") == gating)).isEmpty())


def overlapping(ranges: DataFrame, key: str, low: str, high: str, width: int = 64) -> DataFrame:
    """(a, b) of ranges that share a point, a < b: an equi-join on bins, each pair once."""
    cut = ranges.select(key, low, high, F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))).alias("_bin"))
    a = cut.select(F.col(key).alias("a"), F.col(low).alias("al"), F.col(high).alias("ah"), "_bin")
    b = cut.select(F.col(key).alias("b"), F.col(low).alias("bl"), F.col(high).alias("bh"), "_bin")
    both = a.join(b, "_bin").where("a < b and al <= bh and bl <= ah")
    # a pair is kept in the bin where the later of both begins
    return both.where(F.col("_bin") == F.floor(F.greatest("al", "bl") / width)).select("a", "b")
