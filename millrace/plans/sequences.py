"""Conversations, budgets, caps, versions, candidate tests and skeletons."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import terminal
from millrace.functions import text as X
from millrace.operators import dedup, trajectories
from millrace.plans.base import STEPS, Plans, steps
from millrace.session import table

P = Plans()


@P.add("f1_trajectories")
def f1(spark, d):
    """Each task's actions as a conversation, folded back into steps: tests hold the fold against worked examples."""
    a = F.col("action")
    args = F.to_json(F.struct(*[a[c].alias(c) for c in ("filepath", "start_line", "old_string", "new_string", "content", "skill_name", "file_path", "args")]))
    call = F.array(F.struct(F.struct(a.action_type.alias("name"), args.alias("arguments")).alias("function")))
    pair = F.array(
        F.struct(F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("content"), call.alias("tool_calls")),
        F.struct(F.lit("tool").alias("role"), F.lit("Success.").alias("content"), F.lit(None).cast(call_type()).alias("tool_calls")),
    )
    x = steps(spark, d).where("task_id is not null").groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("step_index", "step_id", pair.alias("m")))).alias("rows"))
    first = F.array(F.struct(F.lit("user").alias("role"), F.col("task_id").alias("content"), F.lit(None).cast(call_type()).alias("tool_calls")))
    x = x.select("task_id", F.to_json(F.concat(first, F.flatten(F.transform("rows", lambda r: r["m"])))).alias("messages"))
    return trajectories.build(x, "task_id", "messages").select("task_id", "n_steps", F.md5("steps").alias("digest"))


def call_type() -> str:
    return "array<struct<function:struct<name:string,arguments:string>>>"


@P.add("f3_budget", f"""WITH {STEPS}, x AS (SELECT task_id, coalesce(action.action_type, '') AS tool, lower(coalesce(action.new_string, action.content, action.args[1], '')) AS o FROM steps),
y AS (SELECT task_id, CASE WHEN (contains(tool, 'edit') AND regexp_matches(o, 'error|not found|no match|did not match|failed')) OR (contains(tool, 'read') AND regexp_matches(o, 'no such file|does not exist|error')) THEN 'b' WHEN regexp_matches(o, 'traceback|assertionerror|failed|error|no matches|0 matches') THEN 'a' ELSE 'clean' END AS k FROM x),
z AS (SELECT task_id, count(*) AS total, count(*) FILTER (WHERE k = 'clean') AS clean, count(*) FILTER (WHERE k = 'a') AS a, count(*) FILTER (WHERE k = 'b') AS b FROM y GROUP BY 1) SELECT *, b = 0 AND clean < 20 AND a < 20 AND total < 40 AND total >= 2 AS within FROM z""")
def f3(spark, d):
    a = F.col("action")
    x = steps(spark, d).select("task_id", F.coalesce(a.action_type, F.lit("")).alias("tool"), F.coalesce(a.new_string, a.content, F.get(a.args, F.lit(0)), F.lit("")).alias("o"))
    return trajectories.budget(x, "task_id", F.col("tool"), F.col("o"))


@P.add("l7_capped_output", f"""WITH {STEPS}, x AS (SELECT task_id, step_id, step_index, length(coalesce(action.content, action.new_string, '')) AS n FROM steps), y AS (SELECT task_id, sum(n) OVER (PARTITION BY task_id ORDER BY step_index, step_id ROWS UNBOUNDED PRECEDING) AS so_far FROM x) SELECT task_id, count(*) AS kept FROM y WHERE so_far <= 4000 GROUP BY 1""")
def l7(spark, d):
    """Steps of each task whose texts together stay within a cap."""
    a = F.col("action")
    x = steps(spark, d).select("task_id", "step_id", "step_index", F.length(F.coalesce(a.content, a.new_string, F.lit(""))).alias("n"))
    w = Window.partitionBy("task_id").orderBy("step_index", "step_id").rowsBetween(Window.unboundedPreceding, 0)
    return x.withColumn("so_far", F.sum("n").over(w)).where("so_far <= 4000").groupBy("task_id").agg(F.count("*").alias("kept"))


@P.add("w6_best_version", """SELECT package, instance_id FROM (SELECT regexp_extract(instance_id, '^(.*)_\\d+$', 1) AS package, instance_id, row_number() OVER (PARTITION BY regexp_extract(instance_id, '^(.*)_\\d+$', 1) ORDER BY regexp_extract(instance_id, '_(\\d+)$', 1)::BIGINT DESC, instance_id DESC) AS k FROM bench_tasks) WHERE k = 1""")
def w6(spark, d):
    x = table(spark, d, "bench_tasks").select(F.regexp_extract("instance_id", r"^(.*)_\d+$", 1).alias("package"), "instance_id")
    best = F.max_by("instance_id", F.struct(X.version_numbers(F.regexp_extract("instance_id", r"_(\d+)$", 1)).alias("v"), "instance_id"))
    return x.groupBy("package").agg(best.alias("instance_id"))


@P.add("a1_arguments", f"WITH {STEPS}, x AS (SELECT unnest(action.args) AS arg FROM steps) SELECT arg, count(*) AS n FROM x WHERE starts_with(arg, '--') GROUP BY 1")
def a1(spark, d):
    x = steps(spark, d).select(F.explode("action.args").alias("arg")).where(F.col("arg").startswith("--"))
    return x.groupBy("arg").agg(F.count("*").alias("n"))


@P.add("a16_search_totals", f"""WITH {STEPS}, x AS (SELECT step_id, unnest(string_split(action.content, chr(10))) AS line FROM steps WHERE action.action_type = 'write_file') SELECT count(*) AS matches, count(DISTINCT step_id) AS files FROM x WHERE contains(line, 'raise ')""")
def a16(spark, d):
    a = F.col("action")
    x = steps(spark, d).where(a.action_type == "write_file").select("step_id", F.explode(F.split(a.content, "\n")).alias("line")).where(F.col("line").contains("raise "))
    return x.agg(F.count("*").alias("matches"), F.countDistinct("step_id").alias("files"))


@P.add("pred23_foreign_sources", f"WITH {STEPS} SELECT task_id, bool_or(source IS NOT NULL AND source <> 'source_b') AS foreign_source FROM steps GROUP BY 1")
def p23(spark, d):
    return steps(spark, d).groupBy("task_id").agg(F.bool_or(F.col("source").isNotNull() & (F.col("source") != "source_b")).alias("foreign_source"))


@P.add("pred19_flat_actions", f"""WITH {STEPS} SELECT step_id, action.action_type AS kind, coalesce(action.filepath, action.file_path) AS path, CASE WHEN action.args IS NOT NULL THEN array_to_string(action.args, ' ') END AS args FROM steps""")
def p19(spark, d):
    a = F.col("action")
    return steps(spark, d).select("step_id", a.action_type.alias("kind"), F.coalesce(a.filepath, a.file_path).alias("path"), F.array_join(a.args, " ").alias("args"))


@P.add("t15_edit_diffs")
def t15(spark, d):
    a = F.col("action")
    x = steps(spark, d).where(a.action_type == "edit_file").select("step_id", terminal.unified(a.old_string, a.new_string).alias("diff"))
    return x.select("step_id", F.length("diff").cast("long").alias("diff_chars"), F.md5("diff").alias("digest"))


@P.add("t16_control_characters", r"""SELECT doc_id, len(regexp_extract_all(text, '\x1B\[[0-?]*[ -/]*[@-~]'))::BIGINT AS sequences, len(regexp_extract_all(text, '[\x00-\x08\x0B\x0C\x0E-\x1A\x1C-\x1F\x7F]'))::BIGINT AS controls, len(regexp_extract_all(text, '[\x{200B}-\x{200D}\x{2060}\x{FEFF}]'))::BIGINT AS invisible FROM documents""")
def t16(spark, d):
    return table(spark, d, "documents").select("doc_id", terminal.control_counts(F.col("text")).alias("c")).select("doc_id", "c.*")


@P.add("j17_neighbour_tests", f"""WITH {STEPS}, f AS (SELECT DISTINCT repo, action.filepath AS path FROM steps WHERE action.filepath LIKE '%.py'), t AS (SELECT repo, path AS test FROM f WHERE path LIKE 'tests/%'), s AS (SELECT repo, path FROM f WHERE path NOT LIKE 'tests/%'),
x AS (SELECT repo, task_id, action.filepath AS path, action.filepath LIKE 'tests/%' AS is_test FROM steps WHERE action.filepath LIKE '%.py'), c AS (SELECT s.repo, s.path, t.test, 1 AS prio FROM s JOIN t ON s.repo = t.repo AND split_part(s.path, '/', -1) = split_part(t.test, '/', -1)
UNION ALL SELECT a.repo, a.path, b.path, 2 FROM x a JOIN x b ON a.task_id = b.task_id AND a.repo = b.repo WHERE NOT a.is_test AND b.is_test), m AS (SELECT repo, path, test, min(prio) AS prio FROM c GROUP BY 1, 2, 3)
SELECT repo, path, test, prio FROM m QUALIFY row_number() OVER (PARTITION BY repo, path ORDER BY prio, test) <= 8""")
def j17(spark, d):
    """Tests near each source file: same name first, then touched in the same task; at most 8 are listed."""
    a = F.col("action")
    f = steps(spark, d).where(a.filepath.endswith(".py")).select("repo", "task_id", a.filepath.alias("path"))
    tests, src = f.where(F.col("path").startswith("tests/")), f.where(~F.col("path").startswith("tests/"))
    name = lambda x: X.basename(F.col(x))
    t = tests.select("repo", F.col("path").alias("test")).distinct().withColumn("name", name("test"))
    same = src.select("repo", "path").distinct().withColumn("name", name("path")).join(t, ["repo", "name"]).select("repo", "path", "test", F.lit(1).alias("prio"))
    near = src.distinct().join(tests.select("repo", "task_id", F.col("path").alias("test")).distinct(), ["repo", "task_id"]).select("repo", "path", "test", F.lit(2).alias("prio"))
    m = same.unionByName(near).groupBy("repo", "path", "test").agg(F.min("prio").alias("prio"))
    return dedup.top_per_group(m, ["repo", "path"], [F.col("prio"), F.col("test")], 8).drop("rank")


@P.add("c8_skeletons")
def c8(spark, d):
    """Definitions of each file with their lines, as far as a budget of 40 lines of the file's definitions goes."""
    from millrace.functions.arrow import python_symbols

    a = F.col("action")
    x = python_symbols(steps(spark, d).where((a.action_type == "write_file") & a.filepath.endswith(".py")).select("step_id", a.content.alias("content")), "step_id", "content")
    x = x.where("kind in ('function', 'class')")
    w = Window.partitionBy("step_id").orderBy("line", "name").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("so_far", F.sum(F.col("last_line") - F.col("line") + 1).over(w).cast("long"))
    return x.where("so_far <= 40").select("step_id", "kind", "name", "line", "last_line", "so_far")
