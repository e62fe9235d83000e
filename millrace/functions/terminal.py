"""Terminal texts, logs and differences: escape sequences, test logs, unified diffs, patterns."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ANSI = r"\x1B\[[0-?]*[ -/]*[@-~]"


def control_counts(t: Column) -> Column:
    """Struct of the numbers of escape sequences, other control characters and invisible characters."""
    return F.struct(
        F.regexp_count(t, F.lit(ANSI)).cast("long").alias("sequences"),
        F.regexp_count(t, F.lit(r"[\x00-\x08\x0B\x0C\x0E-\x1A\x1C-\x1F\x7F]")).cast("long").alias("controls"),
        F.regexp_count(t, F.lit(r"[\x{200B}-\x{200D}\x{2060}\x{FEFF}]")).cast("long").alias("invisible"),
    )


def style_codes(params: str) -> list[tuple[str, ...]]:
    """The codes of a style sequence; 38 and 48 take the numbers of their colour along."""
    out, codes = [], [p or "0" for p in params.split(";")]
    i = 0
    while i < len(codes):
        c = codes[i]
        n = {"5": 3, "2": 5}.get(codes[i + 1] if i + 1 < len(codes) else "", 1) if c in ("38", "48") else 1
        out.append(tuple(codes[i : i + n]))
        i += n
    return out


def test_log(t: Column) -> Column:
    """Struct of passed, failed, errors and skipped from the last summary line of a test log; zeros without one."""
    line = F.element_at(F.regexp_extract_all(F.concat(t, F.lit("\n")), F.lit(r"(=*[^\n]*\b\d+ (?:passed|failed|errors?|skipped)\b[^\n]*)\n"), 1), -1)
    last = F.when(F.size(F.regexp_extract_all(F.concat(t, F.lit("\n")), F.lit(r"(=*[^\n]*\b\d+ (?:passed|failed|errors?|skipped)\b[^\n]*)\n"), 1)) > 0, line).otherwise("")
    n = lambda word: F.coalesce(F.regexp_extract(last, rf"(\d+) {word}", 1).try_cast("long"), F.lit(0))
    return F.struct(n("passed").alias("passed"), n("failed").alias("failed"), n("errors?").alias("errors"), n("skipped").alias("skipped"))


def failure_names(t: Column) -> Column:
    """Names of the failure blocks of a test log, in order."""
    return F.regexp_extract_all(F.concat(F.lit("\n"), t), F.lit(r"\n_{3,} (\S[^\n]*?) _{3,}(?=\n|$)"), 1)


def unified(a: Column, b: Column) -> Column:
    """The unified difference of two texts; empty for equal ones, null with a null."""

    @F.pandas_udf("string")
    def diff(x: pd.Series, y: pd.Series) -> pd.Series:
        one = lambda p, q: None if p is None or q is None else "\n".join(difflib.unified_diff(p.splitlines(), q.splitlines(), lineterm="", n=1))
        return pd.Series([one(p, q) for p, q in zip(x, y)])

    return diff(a, b)


def pattern_fault(pattern: str) -> str | None:
    """What is wrong with a regular expression, None if nothing is."""
    try:
        re.compile(pattern)
    except re.error as e:
        return e.msg
    return None


def tutorial_test_path(p: Column) -> Column:
    """``docs_src/<category>/tutorial<n>[_variant].py`` as the path of its test; null for other paths."""
    m = r"(?:^|/)docs_src/(.+)/(tutorial\d+[a-z]?)(?:_[^/]*)?\.py$"
    category = F.regexp_replace(F.replace(F.regexp_extract(p, m, 1), F.lit("/"), F.lit("_")), "^test_", "")
    return F.when(p.rlike(m), F.concat(F.lit("tests/test_tutorial/test_"), category, F.lit("/test_"), F.regexp_extract(p, m, 2), F.lit(".py")))
