"""Operators of the core on small inputs: what flips a predicate, ties, nulls and empty tables."""

import json
import os
import zipfile

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import arrow, structured
from millrace.functions import text as X
from millrace.operators import analytics, dedup, folds, gates, joins, ordering, patches, search, vectors
from millrace.sources import files, generators, sinks
from millrace.streaming import jobs


def col(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_paths(spark):
    assert col(spark, ["/testbed/src/a.py", "workspace/x/b.py", "owner__name/c.py", None, "//d"], X.workspace_path) == ["src/a.py", "b.py", "c.py", "", "d"]
    assert col(spark, ["/testbed/src/a.py/", "workspace/x/b.py"], X.bare_path) == ["src/a.py", "x/b.py"]
    assert col(spark, ["tests/a.py", "src/repro_x.py", "src/a.py", ""], X.is_scratch) == [True, True, False, False]
    assert col(spark, ["a/Test/b.py", "x_test.py", "conftest.py", "contest.py"], X.is_test_file) == [True, True, True, False]


def test_texts(spark):
    assert col(spark, ["a" * 800, "b" * 900], lambda c: F.length(X.compacted(c))) == [800, 380 * 2 + len(X.TRUNCATED)]
    assert col(spark, ["\x1b[31mred\x1b[0m"], X.without_ansi) == ["red"]
    assert col(spark, ["<think>no</think> yes </thought>"], X.without_thoughts) == ["yes"]
    assert col(spark, ["```py\nx\n```"], X.without_fences) == ["x"]
    assert col(spark, ['ok {"a": {}} end', "none"], X.json_block) == ['{"a": {}}', "none"]
    assert col(spark, ["the 木气 flows", "(木气) stays", "a木b", "（水）"], X.bracketed_han) == ["the (木气) flows", "(木气) stays", "a (木) b", "(水)"]
    assert col(spark, ["三命通会 (San Ming Tong Hui)", "(三命) (San)", "San (三命)"], X.latin_first) == ["San Ming Tong Hui (三命通会)", "San (三命)", "San (三命)"]
    assert col(spark, ["scholar. scholar. the the end"], X.without_repeats) == ["scholar. the end"]
    assert col(spark, ["a & b &amp; &#12; &x"], X.bare_ampersands) == [2]
    assert col(spark, ["1.10.0", "1.9"], X.version_numbers) == [[1, 10, 0], [1, 9]]
    assert col(spark, ["😀a"], X.utf16_units) == [3]


def test_differences(spark):
    df = spark.createDataFrame([("abc", "abd"), ("ab", "abc"), ("x", "x"), ("", "\n"), ("a ", "a"), ("a\nb", "ab"), (None, "a")], "a string, b string")
    out = [(r[0], r[1]) for r in df.select(X.first_difference(F.col("a"), F.col("b")), X.difference_kind(F.col("a"), F.col("b"))).collect()]
    assert out == [(2, "other"), (2, "other"), (None, None), (0, "boundary"), (1, "trailing"), (1, "lines"), (None, None)]


PATCH = "diff --git a/src/a.py b/src/a.py\n--- a/src/a.py\n+++ b/src/a.py\n@@ -1 +1,2 @@\n-x\n+y\n+z\n"
OTHER = "diff --git a/docs/b.md b/docs/b.md\nnew file\n--- /dev/null\n+++ b/docs/b.md\n@@ -0,0 +1 @@\n+hi\n"


def test_patches(spark):
    df = spark.createDataFrame([(1, PATCH), (2, PATCH + OTHER), (3, OTHER), (4, ""), (5, None)], "id int, p string")
    assert {r.id: r.s for r in df.select("id", X.is_single_python_patch(F.col("p")).alias("s")).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert {tuple(r) for r in patches.file_stats(df, "id", "p").where("id = 2").collect()} == {(2, "src/a.py", 2, 1, "M"), (2, "docs/b.md", 1, 0, "A")}
    assert {r.id: r.state for r in patches.readiness(df, "id", "p").collect()} == {1: "ready", 2: "wide", 3: "ready", 4: "empty", 5: "empty"}


def test_json(spark):
    assert col(spark, ['{"b": 1, "a": "x"}', "[1]", "oops", None, ""], structured.canonical) == ['{"a":"x","b":1}', "[1]", None, None, None]
    assert col(spark, ['{"b": [ {"z": 1.50, "y": null} ], "a": "é"}'], structured.canonical) == ['{"a":"é","b":[{"y":null,"z":1.5}]}']
    assert col(spark, ['{"id": 1, "zz": 2}', "no"], lambda c: structured.extra_keys(c, ["id"])) == [["zz"], []]
    assert col(spark, ['{"a": {"b/c": [5, 6]}}', "no"], lambda c: structured.pointer(c, "/a/b~1c/1")) == ["6", None]
    assert col(spark, [[1, 2, 3, 4]], lambda c: structured.masked_labels(c, F.lit(2), 3, 5), "array<int>") == [[-100, 3, 4, -100, -100]]


def test_dedup_and_quotas(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "d", 1)], "k int, v string, t int")
    assert {(r.k, r.v) for r in dedup.latest(df, "k", "t").collect()} == {(1, "b"), (2, "c"), (None, "d")}
    assert {(r.k, r.v) for r in dedup.first_wins(df, "k", [F.col("t")], F.col("v") != "a").collect()} == {(1, "b"), (2, "c"), (None, "d")}
    src = spark.createDataFrame([("a", i) for i in range(3)] + [("b", i) for i in range(9)], "s string, i int")
    count = lambda n: {r.s: r["count"] for r in dedup.backfilled_quota(src, "s", "a", "b", [F.col("i")], n).groupBy("s").count().collect()}
    assert count(8) == {"a": 3, "b": 5}
    assert count(20) == {"a": 3, "b": 9}
    back = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 0)], "s string, i int")
    assert {r.s: r["count"] for r in dedup.backfilled_quota(back, "s", "a", "b", [F.col("i")], 6).groupBy("s").count().collect()} == {"a": 5, "b": 1}
    assert dedup.backfilled_quota(src.limit(0), "s", "a", "b", [F.col("i")], 6).count() == 0
    x = spark.createDataFrame([(f"t{i}", "g") for i in range(10)] + [("solo", "h"), ("p", "k"), ("q", "k")], "t string, g string")
    split = dedup.grouped_split(x, "t", "g")
    assert {(r.g, r.part): r["count"] for r in split.groupBy("g", "part").count().collect()} == {("g", "val"): 2, ("g", "train"): 8, ("h", "train"): 1, ("k", "val"): 1, ("k", "train"): 1}


def test_joins(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "i int, k string")
    held = spark.createDataFrame([("x",), (None,)], "h string")
    assert {r.i for r in joins.exclude(df, "k", held, "h").collect()} == {2, 3}
    m = lambda rows: spark.createDataFrame(rows, "path string, d string")
    cur, allow, exc = m([("a", "1"), ("b", "2"), ("c", "3"), ("e", "5")]), m([("a", "1"), ("b", "9"), ("d", "4")]), m([("e", "5"), ("b", "2"), ("z", "0")])
    assert {tuple(r) for r in joins.manifest_verdicts(cur, allow, exc, "path", "d", "strict").collect()} == {("a", "PASS"), ("b", "FAIL unpromoted"), ("c", "FAIL unapproved"), ("d", "FAIL missing"), ("e", "FAIL unpromoted")}
    assert {tuple(r) for r in joins.manifest_verdicts(cur, allow, exc, "path", "d", "lenient").collect()} == {("a", "PASS"), ("b", "PASS"), ("c", "FAIL unapproved"), ("d", "FAIL missing"), ("e", "PASS"), ("z", "FAIL missing exception")}
    pts = spark.createDataFrame([("f", 5, "p"), ("f", 70, "q"), ("f", 500, "r")], "file string, at int, id string")
    spans = spark.createDataFrame([("f", 1, 100, "outer"), ("f", 4, 6, "inner"), ("f", 60, 90, "late")], "file string, lo int, hi int, name string")
    assert {(r.id, r.name) for r in joins.innermost(pts, spans, ["file"], ["id"], "at", "lo", "hi", "name").collect()} == {("p", "inner"), ("q", "late"), ("r", None)}
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "s string, t string")
    assert {(r.node, r.distance) for r in joins.reachable(e, "s", "t", spark.createDataFrame([("a",)], "n string"), "n", 2).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    left = spark.createDataFrame([("k", 5), ("k", 1)], "k string, t int")
    right = spark.createDataFrame([("k", 2, "v2"), ("k", 5, "v5")], "k string, u int, v string")
    assert {(r.t, r.got) for r in joins.asof(left, right, ["k"], "t", "u", "v", "got").collect()} == {(5, "v5"), (1, None)}


def test_folds(spark):
    df = spark.createDataFrame([("t", 1, "run"), ("t", 2, "run"), ("t", 3, "edit"), ("t", 4, "run"), ("u", 1, "run")], "task string, i int, k string")
    b = folds.breaker(df, "task", ["i"], F.col("k") == "run", F.col("k") == "edit")
    assert [(r.task, r.i, r.probes, r.blocked) for r in b.orderBy("task", "i").collect()] == [("t", 1, 1, False), ("t", 2, 2, True), ("t", 3, 0, False), ("t", 4, 1, False), ("u", 1, 1, False)]
    i = folds.islands(df, "task", ["i"], F.col("k"))
    assert {(r.task, r.kind, r["first"], r["last"], r.n) for r in i.collect()} == {("t", "run", 1, 2, 2), ("t", "edit", 3, 3, 1), ("t", "run", 4, 4, 1), ("u", "run", 1, 1, 1)}
    assert folds.islands(df.limit(0), "task", ["i"], F.col("k")).count() == 0


def test_verdicts(spark):
    v = lambda codes: analytics.verdict(spark.createDataFrame([(c,) for c in codes], "c int"), "c").first().verdict
    assert [v([-1, -1, 1]), v([1, 1, -1, 0]), v([0, 0]), v([2]), v([]), v([-1, 1])] == ["infrastructure", "quality", "no failures", "mixed", "unavailable", "mixed"]


def test_rules(spark):
    bad = spark.createDataFrame([(x,) for x in "abcdefg"], "offender string")
    rules = [gates.Rule("ok", "submission", lambda: bad.limit(0)), gates.Rule("warn", "submission", lambda: bad, warn_only=True), gates.Rule("crash", "docs", lambda: bad.select("nope")), gates.Rule("none", "docs", lambda: bad, needs_rows=lambda: bad.limit(0))]
    out = {r.name: (r.status, r.evidence) for r in gates.run_rules(spark, rules).collect()}
    assert out["ok"][0] == "PASS" and out["warn"] == ("WARN", "a, b, c, d, e, ...") and out["crash"][0] == "FAIL" and out["none"][0] == "FAIL"
    assert gates.exit_code(gates.run_rules(spark, rules)) == 0
    assert gates.exit_code(gates.run_rules(spark, [gates.Rule("x", "submission", lambda: bad)])) == 1


def test_order_and_vectors(spark):
    df = spark.createDataFrame([(i, 999 - i) for i in range(1000)], "i int, v int").repartition(7)
    out = ordering.numbered(df, [F.col("v"), F.col("i")], "place").collect()
    assert all(r.place == r.v + 1 for r in out)
    rnd = np.random.default_rng(1)
    m = rnd.normal(size=(60, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(100, None), (101, []), (102, [0.0] * 8)]
    e = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    got = {}
    for r in vectors.nearest(e, e.where("id < 2"), "id", "v", 3).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.id
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    for q in (0, 1):
        c = u @ u[q]
        c[q] = -9
        assert [got[q][k] for k in (1, 2, 3)] == list(np.argsort(-c)[:3])


def test_search_and_edits(spark):
    f = spark.createDataFrame([(1, "src/text.py", "import os\ndef split_lines(x):\n    return x.split('\\n')\n# end"), (2, "tests/test_a.py", "assert (x)")], "file_id long, path string, text string")
    assert [r.line_no for r in search.matching_lines(f, r"^def \w+").collect()] == [2]
    assert [r.line_no for r in search.matching_lines(f, "(x):").collect()] == [2]  # no regular expression matches, the literal does
    best = search.ranked_lines(f, ["split_lines"], 1).collect()
    # .py 30, definition 60 + 60, name equals the term 75, text in the path 25, term 15
    assert [(r.line_no, r.score) for r in best] == [(2, 265)]
    assert search.edit_text("a b", "a b", "c") == ("c", "exact")
    assert search.edit_text("f( x,\n  y )", "f( x, y )", "g") == ("g", "whitespace")
    assert search.edit_text("f(x,y)", "f( x, y )", "g") == ("g", "delimiters")
    assert search.edit_text("aa", "a", "b")[0] is None and search.edit_text("a", "z", "b") == (None, "not found")


def test_arrow_functions():
    assert sum(map(arrow.char_cells, "a木é😀\u0301")) == 1 + 2 + 1 + 2
    assert arrow.html_problems("<b><i>x</b> & y</p><br>") == [(1, "misnested", "i"), (1, "unescaped", "&"), (1, "end without start", "p")]
    assert [(s[2], s[3], s[4]) for s in arrow.symbols("class A(B):\n  def f(self):\n    g()\nimport os")] == [("base", "B", "A"), ("class", "A", ""), ("function", "f", "A"), ("call", "g", "A.f"), ("import", "os", "")]
    assert arrow.symbols("def (") == []
    bad = {"properties": {"a": {"$ref": "#/defs/x"}, "b": {"type": "strin"}}, "required": ["a", "c"]}
    assert [p for _, p in arrow.schema_problems(bad)] == ["required without property c", "dangling reference #/defs/x", "unknown type strin"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"instance_id": "x"}\n\nbad\n[1]\n{"other": 1}\n{"instance_id": "x"}\n')
    assert [r[0] for r in files.ids_of_json_lines(spark, str(tmp_path / "in")).collect()] == ["x"]
    (tmp_path / "tasks.txt").write_text("b # first\n# none\n\na\nb\n")
    assert [r.task for r in files.task_list(spark, str(tmp_path / "tasks.txt")).orderBy("place").collect()] == ["b", "a"]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("d/one.txt", "1")
    (tmp_path / "broken.zip").write_bytes(b"nope")
    got = {(os.path.basename(r.archive), r.member, r.bytes) for r in files.zip_members(spark, str(tmp_path / "*.zip")).collect()}
    assert got == {("z.zip", "d/one.txt", 1), ("broken.zip", None, None)}
    assert {r.path for r in files.tree_digests(spark, str(tmp_path), ignore=[r"\.zip$"], max_depth=1).collect()} == {"tasks.txt"}
    assert {os.path.basename(r.path) for r in files.text_files(spark, str(tmp_path / "in")).collect()} == {"a.jsonl"}
    assert files.policy("# c\nlimits:\n  size: 10\n  name: 'x'\ntop: true\n") == [("limits", "size", 10), ("limits", "name", "x"), ("", "top", True)]
    (tmp_path / "n.ipynb").write_text(json.dumps({"cells": [{"cell_type": "code", "source": ["a\n", "b"], "outputs": [{"text": "o" * 30}]}]}))
    c = files.notebook_cells(spark, str(tmp_path / "n.ipynb"), 10).first()
    assert (c.source, c.output) == ("a\nb", "o" * 10 + "\n... [cut]")
    stat = files.numstat(spark.createDataFrame([("3\t1\ta.py",), ("-\t-\tb.png",), ("junk",)], "v string"), "v")
    assert {tuple(r) for r in stat.collect()} == {("a.py", 3, 1, False), ("b.png", 0, 0, True)}
    df = spark.createDataFrame([(1, "é", None), (2, "b", "short"), (3, None, None)], "id int, t string, reason string")
    sinks.split_rejects(df, "reason", str(tmp_path / "ok"), str(tmp_path / "no"))
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 2 and spark.read.parquet(str(tmp_path / "no")).first().reason == "short"
    done = str(tmp_path / "done")
    assert sinks.resume(df, "id", done).count() == 3
    sinks.mark_processed(df.limit(2), "id", done)
    assert [r.id for r in sinks.resume(df, "id", done).collect()] == [3]
    sinks.json_lines(df, str(tmp_path / "out"), [F.desc("id")])
    parts = sorted(p for p in os.listdir(tmp_path / "out") if p.endswith(".json"))
    lines = [x for p in parts for x in (tmp_path / "out" / p).read_text().splitlines()]
    assert [json.loads(x)["id"] for x in lines] == [3, 2, 1] and "é" in lines[2]
    assert sinks.metadata(df, "t", {"by_reason": "reason"}).first().by_reason == {"None": 2, "short": 1}
    assert generators.combinations([spark.createDataFrame([(x,) for x in "ab"], "a string"), spark.createDataFrame([(1,), (2,)], "b int")]).count() == 4


def test_streams(spark, tmp_path):
    src, out, ck = tmp_path / "s", str(tmp_path / "o"), str(tmp_path / "c")
    src.mkdir()
    (src / "1.jsonl").write_text('{"task_id": "a", "repo": "r", "resolved": true}\nbad\n\n')
    s = jobs.json_lines(spark, str(src))
    jobs.upsert_available(s, out, "task_id", ck)
    (src / "2.jsonl").write_text('{"task_id": "b", "repo": "r", "resolved": false}\n{"task_id": "a", "repo": "r", "resolved": false}\n')
    jobs.upsert_available(s, out, "task_id", ck)
    rows = {(r.task_id, r.resolved) for r in jobs.read_upserts(spark, out, "task_id").collect()}
    assert rows == {("a", False), ("b", False)}
    q = jobs.tail_summary(s).writeStream.format("memory").queryName("tail").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("tail").first().total == 3


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="ab \n", max_size=12), st.text(alphabet="ab \n", max_size=12))
def test_edit_text_keeps_the_rest(a, b):
    text = f"<{a}|{b}>"
    out, tier = search.edit_text(text, "|", "+")
    assert tier == "exact" and out == f"<{a}+{b}>"


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_calls_are_translated():
    from millrace.operators.trajectories import Translator

    t = Translator()
    run = lambda c: t("bash", {"command": c})
    assert t("read_file", {"path": "/testbed/a.py", "start_line": "3", "end_line": "x"}) == ("read_file", {"filepath": "a.py", "start_line": 3})
    assert t("edit_file", {"path": "a.py", "old_text": ""}) is None
    assert t("write_file", {"path": "repro.py", "content": "assert f() == 1"}) is None  # remembered, not a step
    assert run("python repro.py")[1]["args"] == ["assert f() == 1"]
    assert run("python unknown.py") is None and run("rm -rf x") is None and run("echo hi") is None
    assert run("python -m pytest x")[1] == {"skill_name": "test-gate", "file_path": "gate.py", "args": []}
    assert run("python -c 'print(1)'")[1]["args"] == ["--eval", "print(1)"]
    assert run("cd x && grep -rn 'foo bar' /testbed/src")[1]["args"] == ["foo bar", "src"]
    assert run("grep -rn 'class Foo' .")[1]["args"] == ["--symbol", "Foo"]
    assert run("ls -la /testbed/src")[1]["args"] == ["--file", "src"] and run("git status") == ("get_status", {})
    assert t("str_replace_editor", {"command": "view", "path": "/testbed/src"})[1]["args"] == ["--file", "src"]
    assert t("str_replace_editor", {"command": "str_replace", "path": "a.py", "old_str": "x", "new_str": "y"})[0] == "edit_file"
    assert t("run_skill_script", {"skill_name": "code-map", "file_path": "grep.py"}) is None and t("finish", {}) == ("submit_patch", {})


def test_conversations_fold(spark):
    from millrace.operators import trajectories

    say = lambda *calls: {"role": "assistant", "tool_calls": [{"function": {"name": n, "arguments": json.dumps(a)}} for n, a in calls]}
    tool = lambda c: {"role": "tool", "content": c}
    read = ("read_file", {"filepath": "a.py"})
    talk = [{"role": "user", "content": " fix it "}, say(("think", {})), say(read), say(read), tool("one"), tool("two"), say(("edit_file", {"filepath": "a.py", "old_string": "x", "new_string": "y"})), tool("ok"), say(("finish", {})), tool("late")]
    prompt, steps = trajectories.fold(talk)
    assert prompt == "fix it" and [s["role"] for s in steps] == ["assistant", "tool"] * 3
    assert steps[1]["content"] == "one" and steps[0]["calls"][0]["id"] == "call_0_0" and steps[-1]["content"] == "Patch submitted."
    assert trajectories.fold(talk[:5]) is None and trajectories.fold(talk[1:]) is None
    df = spark.createDataFrame([("t", json.dumps(talk)), ("bad", "{"), ("null", None)], "k string, m string")
    assert [(r.k, r.n_steps) for r in trajectories.build(df, "k", "m").collect()] == [("t", 6)]


def test_terminal_texts(spark):
    from millrace.functions import terminal

    assert terminal.style_codes("1;38;5;200;0") == [("1",), ("38", "5", "200"), ("0",)]
    log = "___ test_a ___\nE boom\n___ test_b[x y] ___\n== 1 failed, 2 passed in 3s ==\n=== 2 failed, 30 passed, 1 skipped in 1.2s ===\n"
    df = spark.createDataFrame([(log,), ("nothing",)], "t string")
    assert [tuple(r[0]) for r in df.select(terminal.test_log(F.col("t"))).collect()] == [(30, 2, 0, 1), (0, 0, 0, 0)]
    assert [r[0] for r in df.select(terminal.failure_names(F.col("t"))).collect()] == [["test_a", "test_b[x y]"], []]
    assert col(spark, ["docs_src/a/b/tutorial001_py310.py", "docs_src/x.py", "src/a.py"], terminal.tutorial_test_path) == ["tests/test_tutorial/test_a_b/test_tutorial001.py", None, None]
    assert terminal.pattern_fault("(a") and terminal.pattern_fault("a+") is None
    d = spark.createDataFrame([("a\nb", "a\nc"), ("a", "a"), (None, "a")], "x string, y string").select(terminal.unified(F.col("x"), F.col("y")).alias("d")).collect()
    assert "-b" in d[0].d and d[1].d == "" and d[2].d is None


def test_stream_state_and_sessions(spark, tmp_path):
    src = tmp_path / "e"
    spark.createDataFrame([("u", "run", "2024-01-01 00:00:00"), ("u", "run", "2024-01-01 00:01:00"), ("v", "edit_file", "2024-01-01 03:00:00")], "user string, kind string, at string").select("user", "kind", F.to_timestamp("at").alias("ts")).write.parquet(str(src))
    stream = lambda: spark.readStream.schema("user string, kind string, ts timestamp").parquet(str(src))
    q = jobs.probe_breaker(stream(), "user", "kind").writeStream.format("memory").queryName("breaker").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("breaker").collect()} == {("u", 2, True), ("v", 0, False)}
    s = jobs.sessions(stream(), "ts", "user", "10 minutes", "1 minute").writeStream.format("memory").queryName("sessions").outputMode("complete").trigger(availableNow=True).start()
    s.awaitTermination()
    assert {(r.user, r.n) for r in spark.table("sessions").collect()} == {("u", 2), ("v", 1)}


def test_prefilter_loses_nothing(spark):
    df = spark.range(5000).withColumn("wide", F.lit("x"))
    wanted = spark.range(0, 5000, 37).select((F.col("id")).alias("id")).union(spark.createDataFrame([(10**9,)], "id long"))
    kept = {r.id for r in joins.prefiltered(df, "id", wanted).collect()}
    assert set(range(0, 5000, 37)) <= kept and len(kept) < 200
    assert joins.prefiltered(df, "id", wanted.limit(0)).count() == 0


CONVERSATION = [
    # task, pos, role, content, calls (name, skill, args)
    ("a", 0, "user", "go", []),
    ("a", 1, "assistant", "", [("read_file", None, "x.py"), ("run_skill_script", "fast-grep", "t")]),
    ("a", 2, "tool", "No matches", []),
    ("a", 3, "tool", "x.py does not exist", []),
    ("a", 4, "user", "more", []),
    ("a", 5, "tool", "not of a turn", []),
    ("a", 6, "assistant", "only words", []),
    ("a", 7, "assistant", "", [("edit_file", None, "x.py")]),
    ("a", 8, "tool", "did not match", []),
    ("a", 9, "assistant", "", [("edit_file", None, "x.py")]),
    ("b", 0, "assistant", "", [("run_skill_script", "test-gate", "")]),
    ("b", 1, "tool", "FAILED", []),
    ("b", 2, "assistant", "", [("edit_file", None, "x.py")]),
    ("b", 3, "tool", None, []),
    ("b", 4, "assistant", "<think>", [("submit_patch", None, "")]),
    ("c", 0, "assistant", "", [("read_file", None, "y.py")]),
]


def test_conversations(spark):
    from millrace.operators import conversations as C

    m = spark.createDataFrame(CONVERSATION, "task_id string, pos int, role string, content string, calls " + C.CALLS)
    out = {r.task_id: tuple(r)[1:] for r in C.classify(m).collect()}
    # a: the read fails, the search finds nothing, one edit fails, the other repeats it; b is good; c ends without an edit
    assert out == {"a": (1, 1, 3, 4, False), "b": (2, 1, 0, 3, True), "c": (1, 0, 0, 1, False)}
    assert C.classify(m.limit(0)).count() == 0
    w = {(r.task_id, r.turn): r for r in C.decision_windows(m, "s", F.lit("u")).collect()}
    assert set(w) == {("a", 1), ("a", 7), ("a", 9), ("b", 0), ("b", 2), ("b", 4), ("c", 0)} - {("b", 4)}
    assert w["a", 7].context == "tool>assistant" and w["b", 0].context == "" and w["b", 2].names == "edit_file"
    assert w["b", 2].prefix == "<system>s\n<user>u\n<assistant>call:run_skill_script{}\n<tool>FAILED\n<assistant>" and w["b", 2].completion == "call:edit_file{x.py}\n"
    assert C.decision_windows(m, "s", F.lit("u"), most=3).count() == 2


def test_observations_are_whole(spark):
    from millrace.operators import conversations as C

    long = "x" * 5000
    actions = spark.createDataFrame([("t", 1, 0, "edit_file", None), ("t", 2, 1, "submit_patch", None), ("t", 3, 2, "run_skill_script", "repro-check"), ("t", 4, 9, "edit_file", None), ("t", 5, 3, "read_file", None)], "task_id string, step_id long, source_step_index int, name string, skill string")
    sources = spark.createDataFrame([("t", 0, long), ("t", 1, "no"), ("t", 2, "AssertionError"), ("t", 3, "")], "task_id string, step_index int, observation string")
    assert {r.step_id: r.observation for r in C.reconciled(actions, sources).collect()} == {1: long, 2: "Patch submitted.", 3: "Assert passed.", 4: "Success.", 5: "Success."}


def test_every_finding_is_reached(spark):
    from millrace.operators import conversations as C

    schema = "task_id string, step_index int, step_id long, source_step_index int, source_steps int, target string, action struct<action_type string, filepath string, old_string string, new_string string, skill_name string, file_path string>"
    e = lambda p, a, b: ("edit_file", p, a, b, None, None)
    rows = [("a", 0, 1, -1, 3, "x.py", e("/x.py ", "1", "2")), ("a", 1, 2, 3, 3, "x.py", e("y.py", "1", "1"))]
    rows += [("b", i, 10 + i, 0, 3, None, ("run_skill_script", None, None, None, "odd" if i else "code-map", "grep.py")) for i in range(17)]
    rows += [("c", 0, 1, 0, 3, "x.py", ("read_file", "x.py", None, None, None, None)), ("c", 1, 2, 0, 3, "x.py", e("x.py", "1", "2")), ("c", 2, 3, 2, 3, "x.py", ("submit_patch", None, None, None, None, None))]
    out = {r.task_id: r.findings for r in C.diagnosis(spark.createDataFrame(rows, schema)).collect()}
    assert out["a"] == ["edit_elsewhere", "edit_without_change", "index_out_of_bounds", "no_discovery", "not_submitted", "too_few_steps"]
    assert out["b"] == ["no_edit", "not_submitted", "repeated_action", "too_many_steps", "unknown_skill", "wrong_script"] and out["c"] == []


def test_hex_rows_are_whole(spark):
    from millrace.functions.text import hex_rows

    texts = ["", "a", "0123456789abcdef", "ab\n\t\x00é水 ~\x7f" * 40, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted(tuple(r) for r in df.select("id", F.inline(hex_rows(F.col("text")))).collect())
    raw = [(i, (t or "").encode()) for i, t in enumerate(texts)]
    assert got == [(i, o, b[o : o + 16].hex().upper(), "".join(chr(x) if 32 <= x < 127 else "." for x in b[o : o + 16])) for i, b in raw for o in range(0, len(b), 16)]


CASES_OF_SIGNALS = [
    ("a/x.py", "pass", [], None, {"python file"}),
    ("x.pyi", "pass", [], None, {"stub or toml file"}),
    ("Tests/x.c", "pass", [], None, {"test path"}),
    ("docs/a.md", "pass", [], None, {"doc path"}),
    ("a.rst", "pass", [], None, {"doc path"}),
    ("docs_src/a.py", "pass", [], None, {"python file"}),
    ("docs_src/a.md", "pass", [], None, {"doc path"}),
    ("examples/x.c", "pass", [], None, {"bench or example path"}),
    ("io/my_text.py", "pass", [], None, {"python file", "text path"}),
    ("x", "def lookup(a):", ["look"], None, {"definition", "definition begins", "name holds a term"}),
    ("x", "  class Lookup:", ["zz", "lookup"], None, {"definition", "definition begins", "name is a term", "term"}),
    ("x", "y(); class A", [], None, {"definition"}),
    ("x", "\t# def a = b", [], None, set()),
    ("x", "'''def a'''", [], None, set()),
    ("x", "  @cached", [], None, {"at sign", "decorator begins"}),
    ("x", "a @ b", [], None, {"at sign"}),
    ("x", "a = 1", [], None, {"equals sign"}),
    ("x", "foo.Strip (a)", [], None, {"string transform"}),
    ("x", "map(line.strip, xs)", [], None, {"string transform"}),
    ("x", "map(other.strip, xs)", [], None, set()),
    ("x", "re.sub(a)", [], None, {"string transform"}),
    ("x", "foo.join(a)", [], None, {"string transform", "verb called"}),
    ("x", "for a in b: split", [], None, {"iteration"}),
    ("x", "yield a", [], None, {"iteration"}),
    ("x", "assert (a)", [], None, {"length or assert"}),
    ("x", "pass", [], "decode_all", {"scope verb", "scope word"}),
    ("x", "pass", [], "buffer", {"scope word"}),
    ("x", "see the_cat a-b", ["cat", "the_cat", "A-B", " "], None, {"term"}),
]


def test_signals_and_weights_of_found_lines(spark):
    from millrace.functions.signals import WEIGHTS, score, signals

    for path, line, words, scope, want in CASES_OF_SIGNALS:
        df = spark.createDataFrame([(path, line, scope)], "p string, l string, s string")
        fired = signals(F.col("p"), F.col("l"), words, F.col("s"))
        got, points = df.select(fired.alias("f"), score(fired).alias("s")).first()
        assert set(got) == want and points == sum(WEIGHTS[x] for x in got), (path, line, got)
    assert {x for *_, want in CASES_OF_SIGNALS for x in want} == set(WEIGHTS)
    df = spark.createDataFrame([("a.py", "x = 1")], "p string, l string")
    assert df.select(score(signals(F.col("p"), F.col("l"), []), {"equals sign": 3}).alias("s")).first().s == 3


def test_predicates(spark):
    from millrace.functions import predicates as Q

    d = lambda *files: "".join(f"diff --git a/{f} b/{f}\n--- a/{f}\n+++ b/{f}\n@@ -1 +1 @@\n-a\n+b\n" for f in files)
    assert col(spark, [d("src/a.py"), d("tests/a.py"), d("a/test_b.py"), d("a.py", "b.py"), d("a.js"), "", None], Q.single_target) == ["src/a.py"] + [None] * 6
    assert col(spark, [d("src/a.py"), d("tests/a.py"), d("a.py", "b.py"), d("a.js"), None], Q.header_target) == ["src/a.py", "tests/a.py", None, None, None]
    assert col(spark, ["see /src/a.py now", "a.py", "b.py", "", None], lambda c: Q.touches(c, F.lit("/src/a.py"))) == [True, True, False, False, False]
    assert col(spark, ["x"], lambda c: Q.touches(c, F.lit(""))) == [False]
    from fnmatch import fnmatchcase

    paths, globs = ["a/b.py", "b.pyc", "x[1].md", "src/ab", "src/zb", "q\nr.md", "a.b"], ["*.py", "src/[!a]b", "?.b", "x[[]*", "q*r.md"]
    assert col(spark, paths, lambda c: Q.matches_glob(c, globs)) == [any(fnmatchcase(p, g) for g in globs) for p in paths]
    assert col(spark, ["a/.git/x", "a/__x/y", "a/Build/c", "a/b.EGG-INFO/c", "a/b/c.py", "", None], Q.is_skipped) == [True, True, True, True, False, False, None]
    assert col(spark, ["<think>abc def</think>", "hello", "```\nabcdef\n```", "abc", None], Q.has_substance)[:2] == [False, True]
    two = spark.createDataFrame([("1", "12"), ("1", None), (None, None)], "a string, b string")
    for op, want in {"==": [False] * 3, "!=": [True, False, False], "<": [True, False, False], "is": [False, False, True], "is not": [True, True, False], "~": [False] * 3}.items():
        assert [r[0] for r in two.select(Q.compared(F.col("a"), op, F.col("b"))).collect()] == want, op
    assert [r[0] for r in two.select(Q.compared(F.col("a"), "in", F.array(F.lit("1")))).collect()] == [True, True, False]
    schema = '{"$defs": {"A": {}, "b": {}}, "definitions": {"b": {}}, "components": {"schemas": {"C": {}}}}'
    targets = col(spark, [schema, "[1]", None], Q.definition_targets)
    assert targets == [{"A": "#/$defs/A", "b": "#/definitions/b", "C": "#/components/schemas/C"}, {}, {}]
    hint = col(spark, ["#/$defs/A", "#/x/c", "B", "#/nowhere", None], lambda c: Q.hinted_target(c, Q.definition_targets(F.lit(schema))))
    assert [h and tuple(h) for h in hint] == [("exact", "#/$defs/A"), ("case", "#/components/schemas/C"), ("case", "#/definitions/b"), None, None]


def test_cascade_and_similar_files(spark):
    from millrace.operators import search

    files = spark.createDataFrame([(1, "a.py", "def load_table(x):\n    return Load"), (2, "b.py", "table_size = 1")], "file_id long, path string, text string")
    terms = spark.createDataFrame([("load_table",), ("LOAD",), ("my_table",), ("zzz",), (None,), ("",)], "term string")
    out = {r.term: tuple(r)[1:] for r in search.cascade(files, terms).collect()}
    assert out == {"load_table": ("exact", 1, 1, 1), "LOAD": ("any case", 1, 1, 2), "my_table": ("part", 2, 1, 1), "zzz": ("none", 0, None, None)}
    asked = spark.createDataFrame([("r", "x/load_table.py"), ("r", "gone.py")], "repo string, path string")
    have = spark.createDataFrame([("r", "y/Load_Table.js"), ("r", "y/load_table_all.py"), ("r", "y/load_tablet.py"), ("r", "x/load_table.py"), ("q", "y/load_table.py"), ("r", "other.py")], "repo string, path string")
    got = [(r.asked, r.tier, r.path, r["rank"]) for r in search.similar_files(asked, have, "repo").orderBy("rank").collect()]
    assert got == [("x/load_table.py", "stem", "y/Load_Table.js", 1), ("x/load_table.py", "part", "y/load_tablet.py", 2), ("x/load_table.py", "part", "y/load_table_all.py", 3)]


def test_cascade_reads_once_and_counts_names_of_several_parts_once(spark, tmp_path, monkeypatch):
    import re
    from collections import Counter

    texts = [(1, "load_table_rows(Load_Table)\nrows_of_table = TABLE"), (2, "load_rows\n\n_table_load, big_load_table_rows_x"), (3, "ab_cd = rows; _load"), (4, "load_load, LOAD_TABLE, loadtable\nother")]
    asked = ["load_table", "rows_table_load", "TABLE", "table_TABLE_new", "rows", "ab_cd", "ab_zz", "big_other_gone", "LOADTABLE", "load-table", "none_here", "_load", "=table"]
    seen, first = Counter(), {}
    for i, text in texts:
        for n, line in enumerate(text.split("\n"), 1):
            for name in re.findall(search.IDENTIFIER, line):
                seen[name] += 1
                first.setdefault(name, (i, n))
    parts = lambda w: {p for p in w.lower().split("_") if len(p) >= 3}
    tests = (("exact", lambda t, w: t == w), ("any case", lambda t, w: t.lower() == w.lower()), ("part", lambda t, w: parts(t) & parts(w)))
    expected = {}
    for term in asked:
        tier, names = next(((tier, names) for tier, test in tests if (names := [w for w in seen if test(term, w)])), ("none", []))
        expected[term] = (tier, sum(seen[w] for w in names), *min((first[w] for w in names), default=(None, None)))
    assert {v[0] for v in expected.values()} == {"exact", "any case", "part", "none"}

    spark.createDataFrame(texts, "file_id long, text string").write.parquet(f"{tmp_path}/files")
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    files = spark.read.parquet(f"{tmp_path}/files").mapInArrow(count, "file_id long, text string").withColumn("path", F.lit("a.py"))
    terms = spark.createDataFrame([(t,) for t in asked], "term string")
    for most in (0, 1, 1_000):
        monkeypatch.setattr(search, "COMMON_PARTS", most)
        reads.value = 0
        assert {r.term: tuple(r)[1:] for r in search.cascade(files, terms).collect()} == expected
        assert reads.value == len(texts)


def test_nearest_vectors_of_several_lengths(spark):
    from millrace.operators.vectors import nearest

    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0, 0.0]), (4, [0.0, 1.0, 0.2]), (5, []), (6, None), (7, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = {(r.query_id, r.id) for r in nearest(df, df, "id", "v", 1).collect()}
    assert {x for x in out if x[0] != 7} == {(1, 2), (2, 1), (3, 4), (4, 3)} and not {i for _, i in out} & {5, 6, 7}


def test_content_digest_is_a_tree(spark, monkeypatch):
    import hashlib

    from millrace.operators import dedup

    monkeypatch.setattr(dedup, "DIGEST_BLOCK", 3)
    texts = {"a": [f"t{i}" for i in range(20)], None: ["x", ""]}
    df = spark.createDataFrame([(g, i, t or None) for g, ts in texts.items() for i, t in enumerate(ts)], "g string, k long, t string").repartition(5)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for g, ts in texts.items():
        level = [sha(t) for t in ts]
        for _ in range(3):  # as many levels as the largest group needs
            level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        want[g] = sha(level[0])
    assert {r.g: r.digest for r in dedup.content_digest(df, ["g"], "k", "t").collect()} == want


def test_cells_of_joined_signs(spark):
    from millrace.functions.arrow import text_cells

    assert [text_cells(x) for x in ("abc", "水", "é", "👨‍👩‍👧", "❤️", "🇩🇪", "🇩🇪🇫🇷", "a‍b", "")] == [3, 2, 1, 2, 2, 2, 4, 1, 0]


def test_the_entry_needs_no_session():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 150 and set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120).returncode == 0


def test_asof_over_days_and_ties(spark):
    import datetime
    import random

    from millrace.operators.joins import asof

    rnd = random.Random(2)
    t = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    left = [(i, rnd.choice(["hot", "hot", "hot", "k", None]), t(rnd.randrange(0, 24 * 12)) if i % 17 else None) for i in range(300)]
    right = [(rnd.choice(["hot", "k", None, "other"]), t(rnd.randrange(24, 24 * 9, 6)), rnd.randrange(100) if n % 9 else None) for n in range(60)]
    a, b = spark.createDataFrame(left, "i int, k string, at timestamp"), spark.createDataFrame(right, "k string, done timestamp, v int")
    want = {}
    for i, k, at in left:
        before = [(d, v) for q, d, v in right if q == k and v is not None and at is not None and d <= at]
        want[i] = max(before)[1] if before else None
    assert {r.i: r.got for r in asof(a, b, ["k"], "at", "done", "v", "got").collect()} == want
