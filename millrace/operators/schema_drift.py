"""Problem 3: schemas that drift between files.

Lines of JSON become cells (file, id, field, type, digest of the value); what a wrapper or a list holds counts as the
value itself, so a value keeps its digest when only its type changes. Columns of following files are profiled (types,
a bounded sketch of the different values, values that shared ids keep), a maximum-weight bipartite matching of the
fields of both files, weighted by all of these and the names, finds what stayed, moved to another name, came or went, and the matches, chained over the files of
a collection, unify the columns. Cells are spread by collection, file and id, so a hot collection is no hot task; a task
that solves a matching sees only profiles, a few rows for each pair of fields.

Lines that are no JSON object are left out; a key counts as a field even if its values are null; null cells have no
type. Repeated lines count once, late files are placed by their number. Without shared ids nothing counts as renamed.
An empty table gives no changes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage

SKETCH = 7
CELL = "collection string, file_name string, file_no int, id string, field string, kind string, digest long, value string"
CHANGE = "file_name string, change string, field_before string, field_after string"


def _plain(v) -> str | None:
    """A value without its wrapping: lists are joined, objects give their ``value`` or their members in order of keys."""
    if v is None or isinstance(v, str):
        return v
    if isinstance(v, list):
        return "".join(x for x in map(_plain, v) if x is not None)
    if isinstance(v, dict):
        if "value" in v:
            return _plain(v["value"])
        return "".join(f"{k}={_plain(v[k])};" for k in sorted(v))
    if isinstance(v, bool):
        return "true" if v else "false"
    return repr(int(v)) if isinstance(v, float) and v.is_integer() else repr(v)


_KINDS = {str: "string", int: "number", float: "number", bool: "boolean", dict: "object", list: "array"}


def cells(df: DataFrame, collection: str, file_name: str, file_no: str, raw: str, id_key: str = "id", values: bool = False, line_no: str | None = None) -> DataFrame:
    """One row per key of every line, each line once. ``values`` keeps the values themselves, with the lines (by number, or
    by digest without one) of records that have no id, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(9 if values else 8)]
            for c, f, n, line, at in zip(*(batch.column(k).to_pylist() for k in range(5))):
                try:
                    record = json.loads(line)
                except (ValueError, RecursionError):
                    continue
                if not isinstance(record, dict):
                    continue
                own = record.get(id_key)
                own = None if own is None else _plain(own)
                place = at if values and own is None else None
                for k, v in record.items():
                    p = _plain(v)
                    digest = None if p is None else xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) - (1 << 63)
                    for col, x in zip(out, (c, f, n, own, k, _KINDS.get(type(v)), digest, p.encode("utf-8", "replace").decode() if values and p is not None else None, place)):
                        col.append(x)
            kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    schema = CELL + ", line long" * values
    place = F.col(line_no).cast("long") if line_no else F.xxhash64(F.col(raw).cast("string"))
    rows = df.select(F.col(collection).cast("string").alias("collection"), F.col(file_name).cast("string").alias("file_name"), F.col(file_no).cast("int").alias("file_no"), F.col(raw).cast("string").alias("raw"), place.alias("line"))
    return rows.where(F.col("raw").isNotNull()).mapInArrow(run, schema).distinct()


def _profiles(x: DataFrame) -> DataFrame:
    """Per file and field: types and a sketch of the different values, of 2^SKETCH hashes at most, over the file's place ``seq``."""
    p = x.groupBy("collection", "file_name", "seq", "field").agg(F.collect_set("kind").alias("kinds"), F.theta_sketch_agg("digest", SKETCH).alias("sketch"))
    return p.withColumn("kinds", F.sort_array("kinds"))  # there are six kinds


def matching(weights: np.ndarray) -> list[tuple[int, int]]:
    """Maximum-weight bipartite matching (Kuhn and Munkres, by potentials); pairs without weight are left out."""
    n, m = weights.shape
    size = max(n, m)
    cost = np.zeros((size, size))
    cost[:n, :m] = -weights
    u, v, match = np.zeros(size + 1), np.zeros(size + 1), np.full(size + 1, -1)
    for i in range(size):
        row, j0 = i, size
        match[size] = i
        least, used, way = np.full(size, np.inf), np.zeros(size + 1, bool), np.full(size, size)
        while match[j0] >= 0:
            used[j0] = True
            row = match[j0]
            free = ~used[:size]
            cand = cost[row] - u[row] - v[:size]
            better = free & (cand < least)
            least[better] = cand[better]
            way[better] = j0
            j1 = int(np.argmin(np.where(free, least, np.inf)))
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[free] -= delta
            j0 = j1
        while j0 != size:
            j1 = way[j0]
            match[j0] = match[j1]
            j0 = j1
    return [(int(match[j]), j) for j in range(m) if 0 <= match[j] < n and weights[match[j], j] > 0]


MOVED, STAYED, PRIOR = 0.25, 0.2, 2.0


def likeness(x: str, y: str, kinds_x: list[str], kinds_y: list[str], common: float) -> float:
    """What two columns are expected to share before any id is compared: values by their sketches, names and types."""
    same_kind = bool(set(kinds_x) & set(kinds_y)) or not kinds_x or not kinds_y
    return 0.5 * common + 0.3 * SequenceMatcher(None, x, y).ratio() + 0.2 * same_kind


def pair_fields(before: dict[str, list[str]], after: dict[str, list[str]], kept: dict[tuple[str, str], tuple[int, int, float]]) -> dict[str, str]:
    """Fields of the file before -> fields of the file after, from their types. ``kept`` has for pairs of fields how many
    shared ids keep a value, of how many that had one, and what share of the values their sketches have in common.

    A pair's share is estimated from the shared ids and from its likeness, which counts as ``PRIOR`` ids: it decides
    between fields that keep the same values and where few ids are shared. Other names pair only by values that moved; a
    name that stays pairs first by values that stayed, then for want of evidence, and last against the evidence that its
    values went or came elsewhere."""
    a, b = sorted(before), sorted(after)
    share = {p: (same + PRIOR * likeness(*p, before[p[0]], after[p[1]], common)) / (had + PRIOR) for p, (same, had, common) in kept.items() if p[0] in before and p[1] in after}
    moves = {p for p, s in share.items() if p[0] != p[1] and s >= MOVED}
    touched = {x for x, _ in moves}, {y for _, y in moves}
    w = np.zeros((len(a), len(b)))
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            s = share.get((x, y), 0.0)
            if x == y:
                w[i, j] = 1.5 + s if s >= STAYED else 0.1 if x in touched[0] or y in touched[1] else 0.5
            elif (x, y) in moves:
                w[i, j] = 0.3 + s
    return {a[i]: b[j] for i, j in matching(w)} if a and b else {}


def _located(x: DataFrame) -> DataFrame:
    """Cells with the place ``seq`` of their file in the collection, by its number."""
    files = x.select("collection", "file_name", "file_no").distinct()
    files = files.withColumn("seq", F.dense_rank().over(Window.partitionBy("collection").orderBy("file_no", "file_name")))
    return x.join(files, ["collection", "file_name", "file_no"])


def pairings(x: DataFrame) -> DataFrame:
    """Per collection and file (but the first): the matched fields and the changes from the file before it."""
    filled = x.where("digest is not null and id is not null")
    old = filled.select("collection", (F.col("seq") + 1).alias("seq"), "id", F.col("field").alias("x"), "digest")
    new = filled.select("collection", "seq", "id", F.col("field").alias("y"), "digest")
    shared = new.select("collection", "seq", "id").distinct()
    base = old.join(shared, ["collection", "seq", "id"], "left_semi").groupBy("collection", "seq", "x").agg(F.count("*").alias("had"))
    kept = old.join(new, ["collection", "seq", "id", "digest"]).groupBy("collection", "seq", "x", "y").agg(F.count("*").alias("same"))
    kept = kept.join(base, ["collection", "seq", "x"])
    prof = stage(_profiles(x), "profiles")
    old_sketch = prof.select("collection", (F.col("seq") + 1).alias("seq"), F.col("field").alias("x"), F.col("sketch").alias("sketch_x"))
    kept = kept.join(old_sketch, ["collection", "seq", "x"]).join(prof.select("collection", "seq", F.col("field").alias("y"), F.col("sketch").alias("sketch_y")), ["collection", "seq", "y"])
    common = F.theta_sketch_estimate(F.theta_intersection("sketch_x", "sketch_y")) / F.greatest(F.lit(1), F.theta_sketch_estimate(F.theta_union("sketch_x", "sketch_y")))
    kept = kept.select("collection", "seq", "x", "y", "same", "had", common.alias("common"))
    none = F.lit(None)
    side = lambda part, seq: prof.select("collection", seq.alias("seq"), F.lit(part).alias("part"), "file_name", F.col("field").alias("x"), none.cast("string").alias("y"), none.cast("long").alias("same"), none.cast("long").alias("had"), none.cast("double").alias("common"), "kinds")
    rows = side("after", F.col("seq")).unionByName(side("before", F.col("seq") + 1))
    rows = rows.unionByName(kept.select("*", F.lit("kept").alias("part"), none.cast("string").alias("file_name"), none.cast("array<string>").alias("kinds")))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c, seq, parts in zip(*(col.to_pylist() for col in batch.columns)):
                before = {r["x"]: r for r in parts if r["part"] == "before"}
                after = {r["x"]: r for r in parts if r["part"] == "after"}
                if not before or not after:
                    continue
                name = next(iter(after.values()))["file_name"]
                pairs = pair_fields({x: r["kinds"] for x, r in before.items()}, {y: r["kinds"] for y, r in after.items()}, {(r["x"], r["y"]): (r["same"], r["had"], r["common"]) for r in parts if r["part"] == "kept"})
                for x, y in pairs.items():
                    k, m = before[x]["kinds"], after[y]["kinds"]
                    out.append((c, seq, name, "renamed" if x != y else "retyped" if k and m and not set(k) & set(m) else None, x, y))
                out += [(c, seq, name, "removed", x, "") for x in before if x not in pairs]
                out += [(c, seq, name, "added", "", y) for y in after if y not in set(pairs.values())]
            cols = list(zip(*out)) or [()] * 6
            kinds = (pa.string(), pa.int32(), *[pa.string()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds)], names=["collection", "seq", "file_name", "change", "field_before", "field_after"])

    # a pair of files has one row per field of each and per pair of fields that share a value
    parts = rows.groupBy("collection", "seq").agg(F.collect_list(F.struct("part", "file_name", "x", "y", "same", "had", "common", "kinds")).alias("parts"))
    return parts.mapInArrow(solve, "collection string, seq int, " + CHANGE)


def changes(df: DataFrame, collection: str, file_name: str, file_no: str, raw: str) -> DataFrame:
    """(file_name, change, field_before, field_after): every change from the file before it in the same collection."""
    # every later step reads the cells, so they are written once
    x = stage(_located(cells(df, collection, file_name, file_no, raw).drop("value")), "cells")
    return pairings(x).where("change is not null").select("file_name", "change", "field_before", "field_after").distinct()


def unified(df: DataFrame, collection: str, file_name: str, file_no: str, raw: str, fields: list[str], line_no: str | None = None) -> DataFrame:
    """One row per collection and id, and per file and line of a record without id, with the columns ``fields`` and the map
    ``others`` of all other columns: every value as text under the first name that its column had, from the last file that
    has the id. A column that came under another name and later took one of ``fields`` stands there, if no file
    has another column there.
    A name that comes anew while a column of that name goes on under another gets the file's place added (``text@4``)."""
    x = stage(_located(cells(df, collection, file_name, file_no, raw, values=True, line_no=line_no)), "cells")
    moved = pairings(x.drop("value", "line"))
    told = x.groupBy("collection", "seq", "field").agg(F.lit(1).alias("one")).select("collection", "seq", F.col("field").alias("field_after"))
    steps = told.join(moved.where("field_before <> '' and field_after <> ''").select("collection", "seq", "field_before", "field_after"), ["collection", "seq", "field_after"], "left")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        # the fields of a collection's files, in their order: a column keeps the name that it came with
        out, now = [], {}
        for seq, part in pdf.sort_values(["seq", "field_after"]).groupby("seq"):
            kept = {r.field_after: now.get(r.field_before, r.field_before) for r in part.itertuples() if isinstance(r.field_before, str)}
            taken = set(kept.values())
            now = kept | {f: f if f not in taken else f"{f}@{seq}" for f in part.field_after if f not in kept}
            out += [(int(seq), k, v) for k, v in now.items()]
        # a column that came under an odd name may end under a known one, unless a file has both
        files: dict[str, set[int]] = {}
        for s, _, v in out:
            files.setdefault(v, set()).add(s)
        later: dict[str, str] = {}
        for v in list(files):
            for name in sorted({k for _, k, w in out if w == v and k in fields}, reverse=True) if v not in fields else ():
                if not files[v] & files.get(name, set()):
                    later[v] = name
                    files[name] = files.get(name, set()) | files[v]
                    break
        return pd.DataFrame([(pdf.collection.iloc[0], s, k, later.get(v, v)) for s, k, v in out], columns=["collection", "seq", "field", "column"])

    names = steps.groupBy("collection").applyInPandas(chain, "collection string, seq int, field string, column string")
    y = x.join(names, ["collection", "seq", "field"]).withColumn("file_name", F.when(F.col("id").isNull(), F.col("file_name")))
    # the id itself is the row's, not a column of it
    y = y.withColumn("column", F.when(F.col("id").isNull() | (F.col("field") != "id"), F.col("column")))
    last = [F.max_by(F.when(F.col("column") == f, F.col("value")), F.when(F.col("column") == f, F.struct("seq", "digest"))).alias(f) for f in fields]
    cell = F.when(~F.col("column").isin(fields), F.struct("column", "seq", "digest", "value"))
    z = y.groupBy("collection", "id", "file_name", "line").agg(F.countDistinct("seq").alias("files"), *last, F.sort_array(F.collect_set(cell)).alias("cells"))
    newest = F.filter("cells", lambda c, i: (i == F.size("cells") - 1) | (F.get("cells", i + 1)["column"] != c["column"]))
    others = F.map_from_entries(F.transform(newest, lambda c: F.struct(c["column"], c["value"])))
    return z.select("collection", "id", "files", *fields, others.alias("others"), "file_name", "line")
