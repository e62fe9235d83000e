"""Row predicates and projections as plain Column expressions. Null in, null or false out as said."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import text as X

# fixed values: folders that a walk leaves out, besides those that begin with a dot or two underscores
SKIPPED_FOLDERS = ("build", "dist", "node_modules", "site-packages", "vendor", "venv", "env", "htmlcov", "target")
PYTHON_PATH = r"[\w\-./]+\.py"


def single_target(patch: Column) -> Column:
    """The one Python file that a patch changes, null if it changes another number of files, another kind or a test."""
    files = X.patch_files(patch)
    path = F.get(files, F.lit(0))
    good = (F.size(files) == 1) & path.endswith(".py") & ~path.startswith("tests/") & ~X.basename(path).startswith("test_")
    return F.when(good, path)


def header_target(patch: Column) -> Column:
    """The Python file that the first ``diff --git`` line of a patch of one file ends with, else null."""
    first = F.get(F.filter(F.split(patch, r"\r\n|\n|\r"), lambda x: x.startswith("diff --git ")), F.lit(0))
    path = F.regexp_replace(F.get(F.split(F.trim(first), r"\s+"), F.lit(3)), "^b/", "")
    return F.when(X.is_single_python_patch(patch) & path.endswith(".py"), path)


def touches(text: Column, target: Column) -> Column:
    """Whether a Python path in the text holds the target or lies in it; no text and no target touch nothing."""
    t = F.regexp_replace(F.trim(target), "^/+", "")
    paths = F.transform(F.regexp_extract_all(text, F.lit(f"({PYTHON_PATH})"), 1), lambda p: F.regexp_replace(p, "^/+", ""))
    return F.coalesce((t != "") & F.exists(paths, lambda p: p.contains(t) | t.contains(p)), F.lit(False))


def glob_pattern(globs: list[str]) -> str:
    """One regular expression for shell patterns whose ``*`` also spans slashes."""
    parts = []
    for g in globs:
        out = ""
        for token in re.findall(r"\[!?\]?[^\]]*\]|.", g, re.S):
            if token == "*":
                out += ".*"
            elif token == "?":
                out += "."
            elif len(token) > 2:
                inner, none = token[1:-1], token[1] == "!"
                out += ("[^" if none else "[") + re.sub(r"([\[\]&\\^])", r"\\\1", inner[none:]) + "]"
            else:
                out += re.escape(token)
        parts.append(out)
    return r"(?s)\A(?:" + "|".join(parts) + r")\z"


def matches_glob(path: Column, globs: list[str]) -> Column:
    return path.rlike(glob_pattern(globs)) if globs else F.lit(False)


def is_skipped(path: Column, folders: tuple[str, ...] = SKIPPED_FOLDERS) -> Column:
    """Whether any part of a path is hidden, private, packaged or one of ``folders``."""
    hit = lambda p: p.startswith(".") | p.startswith("__") | F.lower(p).contains("egg-info") | F.lower(p).isin(*folders)
    return F.exists(F.filter(F.split(path, "/"), lambda p: p != ""), hit)


def has_substance(text: Column, least: int = 5) -> Column:
    """Whether a text keeps ``least`` characters once tags, fences and bracketed ideographs are cleaned; null has none."""
    clean = F.trim(X.latin_first(X.without_fences(X.without_thoughts(text))))
    return F.coalesce(F.length(clean) >= least, F.lit(False))


def compared(left: Column, op: str, right: Column) -> Column:
    """A comparison by the name of its operator. ``is`` and ``is not`` know nulls, ``in`` takes an array; another operator,
    or a null where the operator knows none, is false."""
    known = {
        "==": lambda: left == right, "!=": lambda: left != right, "<": lambda: left < right, "<=": lambda: left <= right, ">": lambda: left > right,
        ">=": lambda: left >= right, "is": lambda: left.eqNullSafe(right), "is not": lambda: ~left.eqNullSafe(right),
        "in": lambda: F.array_contains(right, left), "not in": lambda: ~F.array_contains(right, left),
    }
    return F.coalesce(known[op](), F.lit(False)) if op in known else F.lit(False)


def compared_by(left: Column, op: Column, right: Column) -> Column:
    """The same where the operator's name is a column; ``in`` looks for a part of a text."""
    names = ("==", "!=", "<", "<=", ">", ">=", "is", "is not")
    out = F.when(op == "in", F.coalesce(F.contains(right, left), F.lit(False))).when(op == "not in", F.coalesce(~F.contains(right, left), F.lit(False)))
    for n in names:
        out = out.when(op == n, compared(left, n, right))
    return out.otherwise(F.lit(False))


def definition_targets(schema: Column) -> Column:
    """Names that a JSON schema defines -> where, from ``$defs``, ``definitions`` and ``components.schemas``, later ones first."""
    out = F.create_map().cast("map<string,string>")
    for path, at in (("$['$defs']", "#/$defs/"), ("$.definitions", "#/definitions/"), ("$.components.schemas", "#/components/schemas/")):
        names = F.coalesce(F.json_object_keys(F.get_json_object(schema, path)), F.array().cast("array<string>"))
        found = F.map_from_arrays(names, F.transform(names, lambda n: F.concat(F.lit(at), n)))  # noqa: B023
        out = F.map_concat(F.map_filter(out, lambda k, v: ~F.array_contains(names, k)), found)  # noqa: B023
    return out


def hinted_target(ref: Column, targets: Column) -> Column:
    """(tier, target): what a reference that leads nowhere meant: ``exact`` or ``case`` of its last part, else null; near
    names are a matter of ``search.fuzzy``."""
    name = F.element_at(F.split(F.regexp_replace(ref, "^#", ""), "/"), -1)
    by_case = F.map_entries(F.map_filter(targets, lambda k, v: F.lower(k) == F.lower(name)))
    exact = F.element_at(targets, name)
    return F.when(exact.isNotNull(), F.struct(F.lit("exact").alias("tier"), exact.alias("target"))).when(F.size(by_case) > 0, F.struct(F.lit("case").alias("tier"), F.element_at(F.array_sort(by_case), 1)["value"].alias("target")))
