"""Problem 3: drifting schemas."""

import itertools
import json
import random

import numpy as np

from millrace.operators import schema_drift as D

SCHEMA = "collection_name string, file_name string, file_no int, line_no int, raw string, digest string"
ARGS = ("collection_name", "file_name", "file_no", "raw")


def rows(files, collection="c"):
    out = []
    for n, records in files.items():
        for k, r in enumerate(records):
            out.append((collection, f"{collection}/{n}", n, k, r if isinstance(r, str) or r is None else json.dumps(r, ensure_ascii=False), "extra"))
    return out


def found(spark, files):
    return {tuple(r) for r in D.changes(spark.createDataFrame(rows(files), SCHEMA), *ARGS).collect()}


def test_kinds_of_changes(spark):
    ids = range(1, 6)
    files = {
        1: [{"id": i, "text": f"t{i}", "note": f"n{i}"} for i in ids],
        2: [{"id": i, "body": f"t{i}", "note": f"n{i}"} for i in ids] * 2,  # repeated lines count once
        3: [{"id": i, "body": [f"t{i}"], "note": f"n{i}", "lang": "zh"} for i in ids] + ["no json", "[1]", "", None],
        4: [{"id": i, "body": {"value": f"t{i}", "lang": "zh"}, "lang": "zh"} for i in ids],
    }
    assert found(spark, files) == {
        ("c/2", "renamed", "text", "body"),
        ("c/3", "added", "", "lang"),
        ("c/3", "retyped", "body", "body"),
        ("c/4", "removed", "note", ""),
        ("c/4", "retyped", "body", "body"),
    }


def test_swapped_values_are_renames_and_new_values_are_not(spark):
    a = {1: [{"id": i, "x": f"a{i}", "y": f"b{i}"} for i in range(4)], 2: [{"id": i, "y": f"a{i}", "x": f"b{i}"} for i in range(4)]}
    assert found(spark, a) == {("c/2", "renamed", "x", "y"), ("c/2", "renamed", "y", "x")}
    b = {1: [{"id": i, "x": f"a{i}"} for i in range(4)], 2: [{"id": i, "y": f"c{i}"} for i in range(4)]}
    assert found(spark, b) == {("c/2", "removed", "x", ""), ("c/2", "added", "", "y")}
    copied = {1: [{"id": i, "x": f"a{i}"} for i in range(4)], 2: [{"id": i, "x": f"a{i}", "y": f"a{i}"} for i in range(4)]}
    assert found(spark, copied) == {("c/2", "added", "", "y")}


def test_nulls_have_no_type_and_unshared_ids_no_renames(spark):
    f = {1: [{"id": 1, "x": None}], 2: [{"id": 1, "x": 3}], 3: [{"id": 9, "z": 3}]}
    assert found(spark, f) == {("c/3", "removed", "x", ""), ("c/3", "added", "", "z")}


def test_empty_table(spark):
    assert found(spark, {}) == set()
    assert D.unified(spark.createDataFrame([], SCHEMA), *ARGS, ["text"]).count() == 0


def test_unified_follows_renames(spark):
    f = {1: [{"id": 1, "text": "a"}, {"id": 2, "text": "b"}], 2: [{"id": 1, "body": "a"}, {"id": 2, "body": "b"}, {"id": 3, "body": ["c", "d"]}]}
    out = {(r.id, r.text) for r in D.unified(spark.createDataFrame(rows(f), SCHEMA), *ARGS, ["text"]).collect()}
    assert out == {("1", "a"), ("2", "b"), ("3", "cd")}


def test_matching_is_the_best_one():
    rnd = random.Random(3)
    for _ in range(200):
        n, m = rnd.randint(1, 5), rnd.randint(1, 5)
        w = np.array([[rnd.choice([0, rnd.random()]) for _ in range(m)] for _ in range(n)])
        got = sum(w[i, j] for i, j in D.matching(w))
        small, large = (n, m) if n <= m else (m, n)
        x = w if n <= m else w.T
        best = max(sum(x[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
        assert abs(got - best) < 1e-9


def test_unified_keeps_every_column_and_records_without_id(spark):
    f = {
        1: [{"id": 1, "text": "a", "page": 3}, {"id": 2, "text": "b", "page": 4}, {"text": "x", "page": 9}],
        2: [{"id": 1, "body": "a", "leaf": 3, "lang": "zh"}, {"id": 2, "body": "b", "leaf": 4}, {"body": "x", "note": "n"}, {"body": "x", "note": "n"}],
        3: [{"id": 1, "body": "a", "leaf": 3, "text": "new"}, {"id": 2, "body": "b", "leaf": 5}],
    }
    df = spark.createDataFrame(rows(f) + rows(f)[:3], SCHEMA)
    out = {(r.id, r.file_name, r.line): (r.files, r.text, r.others) for r in D.unified(df, *ARGS, ["text"], "line_no").collect()}
    assert out == {
        ("1", None, None): (3, "a", {"page": "3", "lang": "zh", "text@3": "new"}),
        ("2", None, None): (3, "b", {"page": "5"}),
        (None, "c/1", 2): (1, "x", {"page": "9"}),
        (None, "c/2", 2): (1, "x", {"note": "n"}),
        (None, "c/2", 3): (1, "x", {"note": "n"}),
    }
    assert D.unified(df, *ARGS, ["text"]).count() == 4  # without numbers, equal lines of a file are one


def test_a_later_name_takes_no_other_columns_place(spark):
    ids = range(1, 5)
    f = {1: [{"id": i, "text": f"a{i}", "body": f"b{i}"} for i in ids], 2: [{"id": i, "body": f"a{i}", "text": f"b{i}"} for i in ids]}
    out = {r.id: (r.text, r.others) for r in D.unified(spark.createDataFrame(rows(f), SCHEMA), *ARGS, ["text"]).collect()}
    assert out == {str(i): (f"a{i}", {"body": f"b{i}"}) for i in ids}
    g = {1: [{"id": i, "body": f"a{i}"} for i in ids], 2: [{"id": i, "text": f"a{i}"} for i in ids]}
    out = {r.id: (r.text, r.others) for r in D.unified(spark.createDataFrame(rows(g), SCHEMA), *ARGS, ["text"]).collect()}
    assert out == {str(i): (f"a{i}", {}) for i in ids}


def test_sketches_names_and_types_decide_between_equal_moves():
    from millrace.operators.schema_drift import pair_fields

    kinds = ["string"]
    # both new fields hold the one shared id's value: the sketches say which column it is
    same = {("text", "a"): (1, 1, 0.1), ("text", "b"): (1, 1, 0.9)}
    assert pair_fields({"text": kinds}, {"a": kinds, "b": kinds}, same) == {"text": "b"}
    flat = {("text", "body"): (1, 1, 0.5), ("text", "text_2"): (1, 1, 0.5)}
    assert pair_fields({"text": kinds}, {"body": kinds, "text_2": kinds}, flat) == {"text": "text_2"}
    assert pair_fields({"text": kinds}, {"a": ["number"], "b": kinds}, {("text", "a"): (1, 1, 0.5), ("text", "b"): (1, 1, 0.5)}) == {"text": "b"}
    # many shared ids outweigh them
    assert pair_fields({"text": kinds}, {"body": kinds, "text_2": kinds}, {("text", "body"): (90, 100, 0.0), ("text", "text_2"): (40, 100, 0.9)}) == {"text": "body"}
    # without values of shared ids nothing is renamed, whatever they say
    assert pair_fields({"text": kinds}, {"text_2": kinds}, {}) == {}
