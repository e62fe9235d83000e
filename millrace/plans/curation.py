"""Steps of tasks: exclusion, folds, windows, quotas, splits, reconciliation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import dedup, folds, joins
from millrace.plans.base import RUNS, STEPS, Plans, points, refs, runs, steps
from millrace.session import table

P = Plans()
ORDER = ["step_index", "step_id"]
FIELDS = ["action_type", "filepath", "old_string", "new_string", "content", "skill_name", "file_path"]


class _Action:
    """Fields of the action; columns are made when a query runs, as importing needs no session."""

    def __getattr__(self, name: str):
        return F.col("action")[name]

    __getitem__ = __getattr__


ACT = _Action()
SIG_SQL = "concat_ws('|', action.action_type, coalesce(action.filepath, '~'), coalesce(action.old_string, '~'), coalesce(action.new_string, '~'), coalesce(action.content, '~'), coalesce(action.skill_name, '~'), coalesce(action.file_path, '~'))"


@P.add("j1_exclusion_anti_join", f"WITH {STEPS} SELECT step_id, task_id FROM steps WHERE task_id NOT IN (SELECT instance_id FROM bench_tasks WHERE instance_id IS NOT NULL) OR task_id IS NULL")
def j1(spark, d):
    return joins.exclude(steps(spark, d), "task_id", table(spark, d, "bench_tasks"), "instance_id").select("step_id", "task_id")


@P.add("j2_leakage", f"WITH {STEPS} SELECT task_id, count(*) AS leaked_steps FROM steps WHERE task_id IN (SELECT instance_id FROM bench_tasks) GROUP BY 1")
def j2(spark, d):
    return joins.keep_only(steps(spark, d), "task_id", table(spark, d, "bench_tasks"), "instance_id").groupBy("task_id").agg(F.count("*").alias("leaked_steps"))


@P.add("j3_unprocessed", f"WITH {RUNS} SELECT instance_id, repo FROM bench_tasks b WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.instance_id = b.instance_id)")
def j3(spark, d):
    return joins.exclude(table(spark, d, "bench_tasks"), "instance_id", runs(spark, d), "instance_id").select("instance_id", "repo")


@P.add("j4_completed", f"WITH {RUNS} SELECT instance_id FROM bench_tasks WHERE instance_id NOT IN (SELECT instance_id FROM runs WHERE resolved AND instance_id IS NOT NULL UNION SELECT task_id FROM translated_steps WHERE task_id IS NOT NULL)")
def j4(spark, d):
    done = runs(spark, d).where("resolved").select("instance_id").union(table(spark, d, "translated_steps").select("task_id"))
    return joins.exclude(table(spark, d, "bench_tasks"), "instance_id", done, "instance_id").select("instance_id")


@P.add("j5_task_metadata", f"WITH {RUNS} SELECT r.result_id, b.base_commit, length(b.problem_statement) AS statement_chars FROM runs r JOIN bench_tasks b ON r.instance_id = b.instance_id")
def j5(spark, d):
    b = table(spark, d, "bench_tasks").select("instance_id", "base_commit", F.length("problem_statement").cast("long").alias("statement_chars"))
    return runs(spark, d).select("result_id", "instance_id").join(b, "instance_id").select("result_id", "base_commit", "statement_chars")


@P.add("j9_source_steps", f"""WITH {STEPS} SELECT a.step_id, min(b.step_id) AS source_step_id, min(b.step_id) IS NULL AS unmatched FROM steps a LEFT JOIN steps b ON a.task_id = b.task_id AND a.source_step_index = b.step_index GROUP BY a.step_id""")
def j9(spark, d):
    s = steps(spark, d)
    b = s.groupBy("task_id", F.col("step_index").alias("source_step_index")).agg(F.min("step_id").alias("source_step_id"))
    x = s.select("step_id", "task_id", "source_step_index").join(b, ["task_id", "source_step_index"], "left")
    return x.select("step_id", "source_step_id", F.col("source_step_id").isNull().alias("unmatched"))


@P.add("pred4_skip_reasons_by_source", f"""WITH {STEPS}, x AS (SELECT coalesce(source, 'none') AS source, CASE WHEN task_id IS NULL THEN 'no_task' WHEN task_id IN (SELECT instance_id FROM bench_tasks) THEN 'held_out' WHEN action.action_type IS NULL THEN 'no_action' WHEN source IS NULL THEN 'no_source' ELSE 'kept' END AS reason FROM steps)
SELECT source, reason, count(*) AS n FROM x GROUP BY 1, 2""")
def p4_reasons(spark, d):
    held = table(spark, d, "bench_tasks").select(F.col("instance_id").alias("task_id")).distinct().withColumn("_held", F.lit(True))
    x = steps(spark, d).join(held, "task_id", "left")
    x = joins.labelled(x, [("no_task", F.col("task_id").isNotNull()), ("held_out", F.col("_held").isNull()), ("no_action", ACT.action_type.isNotNull()), ("no_source", F.col("source").isNotNull())])
    return x.groupBy(F.coalesce("source", F.lit("none")).alias("source"), F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@P.add("w1_repeated_neighbours", f"WITH {STEPS}, x AS (SELECT step_id, task_id, coalesce({SIG_SQL} = lag({SIG_SQL}) OVER (PARTITION BY task_id ORDER BY step_index, step_id), false) AS repeated FROM steps) SELECT task_id, count(*) AS steps, count(*) FILTER (WHERE repeated) AS repeats FROM x GROUP BY 1")
def w1(spark, d):
    sig = F.md5(F.concat_ws("|", *[F.coalesce(ACT[f], F.lit("~")) for f in FIELDS]))
    x = folds.repeats(steps(spark, d).select("task_id", *ORDER, "action"), "task_id", ORDER, sig)
    return x.groupBy("task_id").agg(F.count("*").alias("steps"), F.sum(F.col("repeated").cast("long")).alias("repeats"))


@P.add("w2_islands", f"""WITH {STEPS}, x AS (SELECT task_id, action.action_type AS kind, step_index, step_id, CASE WHEN action.action_type IS NOT DISTINCT FROM lag(action.action_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS fresh FROM steps WINDOW w AS (PARTITION BY task_id ORDER BY step_index, step_id)),
y AS (SELECT *, sum(fresh) OVER (PARTITION BY task_id ORDER BY step_index, step_id ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM x) SELECT task_id, kind, island, min(step_index) AS first, max(step_index) AS last, count(*) AS n FROM y GROUP BY 1, 2, 3""")
def w2(spark, d):
    return folds.islands(steps(spark, d).select("task_id", *ORDER, ACT.action_type.alias("t")), "task_id", ORDER, F.col("t"))


@P.add("w3_trailing_window", f"""WITH {STEPS} SELECT step_id, array_to_string(list(action.action_type) OVER (PARTITION BY task_id ORDER BY step_index, step_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), '>') AS recent FROM steps""")
def w3(spark, d):
    x = folds.trailing(steps(spark, d).select("task_id", *ORDER, ACT.action_type.alias("t")), "task_id", ORDER, F.col("t"), 2, "recent")
    return x.select("step_id", F.array_join("recent", ">").alias("recent"))


@P.add("w4_history_size", f"""WITH {STEPS} SELECT step_id, coalesce(sum(length(coalesce(action.content, action.new_string, ''))) OVER (PARTITION BY task_id ORDER BY step_index, step_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prefix_chars FROM steps""")
def w4(spark, d):
    size = F.length(F.coalesce(ACT.content, ACT.new_string, F.lit("")))
    x = steps(spark, d).select("task_id", *ORDER, size.alias("s"))
    return folds.history(x, "task_id", ORDER, F.col("s"), "prefix_chars").select("step_id", "prefix_chars")


@P.add("w9_last_action", f"WITH {STEPS} SELECT task_id, arg_max(action.action_type, (step_index, step_id)) AS last_action, arg_min(action.action_type, (step_index, step_id)) AS first_action FROM steps GROUP BY 1")
def w9(spark, d):
    at = F.struct(*ORDER)
    return steps(spark, d).groupBy("task_id").agg(F.max_by(ACT.action_type, at).alias("last_action"), F.min_by(ACT.action_type, at).alias("first_action"))


@P.add("pred17_structure", f"""WITH {STEPS} SELECT task_id, count(*) AS steps, bool_or(action.skill_name IN ('fast-grep', 'code-map')) AS discovers, bool_or(action.action_type = 'edit_file' AND action.filepath LIKE '%.py') AS edits,
 bool_or(action.skill_name IN ('repro-check', 'code-oracle', 'test-gate')) AS verifies, arg_max(action.action_type, (step_index, step_id)) = 'submit_patch' AS submits FROM steps GROUP BY 1""")
def p17(spark, d):
    return steps(spark, d).groupBy("task_id").agg(
        F.count("*").alias("steps"),
        F.bool_or(ACT.skill_name.isin("fast-grep", "code-map")).alias("discovers"),
        F.bool_or((ACT.action_type == "edit_file") & ACT.filepath.endswith(".py")).alias("edits"),
        F.bool_or(ACT.skill_name.isin("repro-check", "code-oracle", "test-gate")).alias("verifies"),
        (F.max_by(ACT.action_type, F.struct(*ORDER)) == "submit_patch").alias("submits"),
    )


@P.add("pred18_argument_contract", f"""WITH {STEPS}, x AS (SELECT action.skill_name AS skill, coalesce(len(action.args), 0) AS k, coalesce(action.args[1], '') AS a FROM steps WHERE action.action_type = 'run_skill_script')
SELECT skill, count(*) AS calls, count(*) FILTER (WHERE CASE skill WHEN 'fast-grep' THEN k BETWEEN 1 AND 2 AND trim(a) <> '' WHEN 'code-map' THEN k = 2 AND a IN ('--symbol', '--file') WHEN 'code-oracle' THEN k = 2 AND a IN ('--eval', '--hex', '--width', '--html-esc', '--schema', '--syntax')
 WHEN 'repro-check' THEN k > 0 AND (contains(a, 'assert ') OR a IN ('--expect-exception', '--b64')) WHEN 'test-gate' THEN k = 0 OR (k = 1 AND a IN ('--diff', '--status')) ELSE false END) AS valid FROM x GROUP BY 1""")
def p18(spark, d):
    skill, k, a = ACT.skill_name, F.coalesce(F.size(ACT.args), F.lit(0)), F.coalesce(F.get(ACT.args, F.lit(0)), F.lit(""))
    k = F.greatest(k, F.lit(0))
    ok = (
        F.when(skill == "fast-grep", k.between(1, 2) & (F.trim(a) != "")).when(skill == "code-map", (k == 2) & a.isin("--symbol", "--file"))
        .when(skill == "code-oracle", (k == 2) & a.isin("--eval", "--hex", "--width", "--html-esc", "--schema", "--syntax"))
        .when(skill == "repro-check", (k > 0) & (a.contains("assert ") | a.isin("--expect-exception", "--b64")))
        .when(skill == "test-gate", (k == 0) | ((k == 1) & a.isin("--diff", "--status"))).otherwise(F.lit(False))
    )
    x = steps(spark, d).where(ACT.action_type == "run_skill_script")
    return x.groupBy(skill.alias("skill")).agg(F.count("*").alias("calls"), F.sum(F.coalesce(ok, F.lit(False)).cast("long")).alias("valid"))


@P.add("pred24_shards", f"WITH {STEPS} SELECT step_id % 7 AS shard, count(*) AS n FROM steps GROUP BY 1")
def p24(spark, d):
    return steps(spark, d).groupBy(F.pmod("step_id", F.lit(7)).alias("shard")).agg(F.count("*").alias("n"))


@P.add("f4_pair_observations", f"""WITH {STEPS}, x AS (SELECT step_id, action.action_type AS kind, lead(action.action_type) OVER w AS next_kind, lead(coalesce(action.content, action.new_string)) OVER w AS next_text FROM steps WINDOW w AS (PARTITION BY task_id ORDER BY step_index, step_id))
SELECT step_id, kind, next_kind, length(next_text) AS observed_chars FROM x""")
def f4(spark, d):
    w = Window.partitionBy("task_id").orderBy(*ORDER)
    x = steps(spark, d).select("task_id", *ORDER, ACT.action_type.alias("kind"), F.length(F.coalesce(ACT.content, ACT.new_string)).cast("long").alias("c"))
    return x.select("step_id", "kind", F.lead("kind").over(w).alias("next_kind"), F.lead("c").over(w).alias("observed_chars"))


@P.add("f5_script_memory", f"""WITH {STEPS}, x AS (SELECT step_id, task_id, step_index, coalesce(action.filepath, '') AS path, CASE WHEN action.action_type = 'write_file' THEN action.content END AS written, action.action_type AS kind FROM steps)
SELECT step_id, md5(last_value(written IGNORE NULLS) OVER (PARTITION BY task_id, path ORDER BY step_index, step_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS remembered FROM x""")
def f5(spark, d):
    """What was written to the row's path before, within the task: the memory of the translator of calls."""
    written = F.when(ACT.action_type == "write_file", F.md5(ACT.content))
    x = steps(spark, d).select("task_id", *ORDER, F.coalesce(ACT.filepath, F.lit("")).alias("path"), written.alias("w"))
    return folds.remembered(x, "task_id", ORDER, F.col("path"), F.col("w"), "remembered").select("step_id", "remembered")


@P.add("f10_circuit_breaker", f"""WITH {STEPS}, x AS (SELECT step_id, task_id, step_index, CASE WHEN action.action_type IN ('edit_file', 'write_file') THEN 1 ELSE 0 END AS e, CASE WHEN action.action_type = 'run_skill_script' THEN 1 ELSE 0 END AS p FROM steps),
y AS (SELECT *, sum(e) OVER (PARTITION BY task_id ORDER BY step_index, step_id ROWS UNBOUNDED PRECEDING) AS g FROM x)
SELECT step_id, (sum(p) OVER w)::BIGINT AS probes, sum(p) OVER w >= 2 AS blocked FROM y WINDOW w AS (PARTITION BY task_id, g ORDER BY step_index, step_id ROWS UNBOUNDED PRECEDING)""")
def f10(spark, d):
    x = steps(spark, d).select("task_id", *ORDER, ACT.action_type.alias("t"))
    x = folds.breaker(x, "task_id", ORDER, F.col("t") == "run_skill_script", F.col("t").isin("edit_file", "write_file"))
    return x.select("step_id", "probes", "blocked")


@P.add("f10_payload_repeats", f"""WITH {STEPS} SELECT step_id, row_number() OVER (PARTITION BY task_id, md5(coalesce(action.args[1], '')) ORDER BY step_index, step_id) AS times FROM steps WHERE action.action_type = 'run_skill_script'""")
def f10b(spark, d):
    x = steps(spark, d).where(ACT.action_type == "run_skill_script").select("task_id", *ORDER, F.coalesce(F.get(ACT.args, F.lit(0)), F.lit("")).alias("a"))
    return folds.occurrence(x, "task_id", ORDER, F.col("a"), "times").select("step_id", "times")


@P.add("a7_first_qualified", f"""WITH {STEPS} SELECT task_id, step_id AS first_edit FROM steps WHERE action.action_type = 'edit_file' AND task_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY step_index, step_id) = 1""")
def a7(spark, d):
    x = steps(spark, d).where("task_id is not null")
    return dedup.first_wins(x, "task_id", [F.col(c) for c in ORDER], ACT.action_type == "edit_file").select("task_id", F.col("step_id").alias("first_edit"))


@P.add("l3_source_quota", f"""WITH {STEPS} SELECT source, step_id, rank FROM (SELECT source, step_id, row_number() OVER (PARTITION BY source ORDER BY step_id) AS rank FROM steps WHERE source IN ('source_a', 'source_b')) WHERE rank <= CASE source WHEN 'source_a' THEN 20 ELSE 30 END""")
def l3(spark, d):
    return dedup.quota(steps(spark, d), "source", [F.col("step_id")], {"source_a": 20, "source_b": 30}).select("source", "step_id", "rank")


@P.add("l4_backfilled_quota", f"""WITH {STEPS}, t AS (SELECT coalesce(source, 'none') AS source, step_id FROM steps), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY step_id) AS rank FROM t WHERE source IN ('source_b', 'source_a')), c AS (SELECT least(count(*) FILTER (WHERE source = 'source_b'), 100) AS a, least(count(*) FILTER (WHERE source = 'source_a'), 100) AS b FROM r),
p AS (SELECT least(a, 100 - least(b, 100 - least(a, 50))) AS ta, least(b, 100 - least(a, 50)) AS tb FROM c) SELECT r.source, r.step_id, r.rank FROM r, p WHERE r.rank <= CASE WHEN r.source = 'source_b' THEN p.ta ELSE p.tb END""")
def l4(spark, d):
    x = steps(spark, d).select(F.coalesce("source", F.lit("none")).alias("source"), "step_id")
    return dedup.backfilled_quota(x, "source", "source_b", "source_a", [F.col("step_id")], 100)


@P.add("m4_grouped_split", f"""WITH t AS (SELECT DISTINCT task_id, repo FROM translated_steps WHERE task_id IS NOT NULL), x AS (SELECT *, count(*) OVER (PARTITION BY repo) AS n, row_number() OVER (PARTITION BY repo ORDER BY md5('42:' || task_id), task_id) AS k FROM t)
SELECT task_id, repo, CASE WHEN k <= CASE WHEN n > 3 THEN greatest(1, round(n * 0.2)) WHEN n > 1 THEN 1 ELSE 0 END THEN 'val' ELSE 'train' END AS part FROM x""")
def m4(spark, d):
    return dedup.grouped_split(table(spark, d, "translated_steps"), "task_id", "repo")


@P.add("u4_disjoint_split", """WITH t AS (SELECT DISTINCT task_id, repo FROM translated_steps WHERE task_id IS NOT NULL), x AS (SELECT *, count(*) OVER (PARTITION BY repo) AS n, row_number() OVER (PARTITION BY repo ORDER BY md5('42:' || task_id), task_id) AS k FROM t),
y AS (SELECT task_id, k <= CASE WHEN n > 3 THEN greatest(1, round(n * 0.2)) WHEN n > 1 THEN 1 ELSE 0 END AS v FROM x) SELECT count(*) AS in_both FROM (SELECT task_id FROM y WHERE v INTERSECT SELECT task_id FROM y WHERE NOT v)""")
def u4(spark, d):
    s = dedup.grouped_split(table(spark, d, "translated_steps"), "task_id", "repo")
    return s.where("part = 'val'").select("task_id").intersect(s.where("part = 'train'").select("task_id")).agg(F.count("*").alias("in_both"))


@P.add("u6_ordered_union", f"WITH {RUNS}, {STEPS} SELECT 1 AS source_ord, instance_id AS task FROM runs UNION ALL SELECT 2, task_id FROM steps")
def u6(spark, d):
    a = runs(spark, d).select(F.lit(1).alias("source_ord"), F.col("instance_id").alias("task"))
    return a.unionByName(steps(spark, d).select(F.lit(2).alias("source_ord"), F.col("task_id").alias("task")))


@P.add("u3_first_of_union", f"""WITH {RUNS}, {STEPS}, x AS (SELECT 1 AS o, instance_id AS task, repo FROM runs UNION ALL SELECT 2, task_id, repo FROM steps) SELECT task, min(o) AS source_ord FROM x WHERE task IS NOT NULL GROUP BY 1""")
def u3(spark, d):
    a = runs(spark, d).select(F.lit(1).alias("o"), F.col("instance_id").alias("task"))
    x = a.unionByName(steps(spark, d).select(F.lit(2).alias("o"), F.col("task_id").alias("task")))
    return x.where("task is not null").groupBy("task").agg(F.min("o").alias("source_ord"))


@P.add("f7_accumulated_history", f"""WITH {STEPS} SELECT task_id, string_agg(action.action_type, '>' ORDER BY step_index, step_id) AS trail, count(*) AS windows FROM steps WHERE action.action_type IS NOT NULL GROUP BY 1""")
def f7(spark, d):
    x = steps(spark, d).where(ACT.action_type.isNotNull())
    trail = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*ORDER, ACT.action_type.alias("t")))), lambda s: s["t"]), ">")
    return x.groupBy("task_id").agg(trail.alias("trail"), F.count("*").alias("windows"))


@P.add("pred9_scratch_paths", rf"""WITH {STEPS}, x AS (SELECT DISTINCT action.filepath AS path FROM steps WHERE action.filepath IS NOT NULL), y AS (SELECT path, ltrim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(path), '^/?testbed/', ''), '^/?workspace/[^/]+/', ''), '^/?workspace/', ''), '^/?[a-zA-Z0-9_\-]+__[^/]+/', ''), '/') AS clean FROM x)
SELECT path, clean, clean <> '' AND (clean LIKE 'tests/%' OR contains(clean, '/tests/') OR regexp_matches(clean, '(?i)(?:^|/)(?:repro[^/]*|reproduce[^/]*|test_[^/]*|[^/]*_test|verify[^/]*|check_[^/]*|debug[^/]*|bug[^/]*|poc[^/]*|tmp[^/]*|temp[^/]*|scratch[^/]*|issue[^/]*)\.py$')) AS scratch FROM y""")
def p9_scratch(spark, d):
    x = steps(spark, d).select(ACT.filepath.alias("path")).where("path is not null").distinct()
    return x.select("path", X.workspace_path(F.col("path")).alias("clean"), X.is_scratch(F.col("path")).alias("scratch"))


@P.add("pred10_test_files", f"""WITH {STEPS}, x AS (SELECT DISTINCT action.filepath AS path FROM steps WHERE action.filepath IS NOT NULL) SELECT path, regexp_matches(lower(path), '(^|/)(tests|test|testing)(/|$)') OR starts_with(split_part(lower(path), '/', -1), 'test_') OR ends_with(lower(path), '_test.py') OR split_part(lower(path), '/', -1) IN ('conftest.py', 'pytest.ini') AS is_test FROM x""")
def p10(spark, d):
    x = steps(spark, d).select(ACT.filepath.alias("path")).where("path is not null").distinct()
    return x.select("path", X.is_test_file(F.col("path")).alias("is_test"))


@P.add("v3_fallback_citation", """WITH REFS SELECT ref_id, coalesce(nullif(source, ''), 'unknown source') AS source, coalesce(search_query, '(none)') AS query FROM refs""".replace("REFS", "refs AS (SELECT * FROM grounded_refs QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY loaded_at DESC) = 1)"))
def v3(spark, d):
    x = refs(spark, d)
    return x.select("ref_id", F.coalesce(F.when(F.col("source") != "", F.col("source")), F.lit("unknown source")).alias("source"), F.coalesce("search_query", F.lit("(none)")).alias("query"))


@P.add("v2_query_budget", """WITH r AS (SELECT * FROM grounded_refs QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY loaded_at DESC) = 1), x AS (SELECT cell_id, search_query, count(*) AS k FROM r WHERE search_query IS NOT NULL GROUP BY 1, 2) SELECT cell_id, count(*) AS queries, count(*) FILTER (WHERE k > 1) AS repeated, count(*) > 2 AS over_budget FROM x GROUP BY 1""")
def v2(spark, d):
    x = refs(spark, d).where("search_query is not null").groupBy("cell_id", "search_query").agg(F.count("*").alias("k"))
    return x.groupBy("cell_id").agg(F.count("*").alias("queries"), F.sum((F.col("k") > 1).cast("long")).alias("repeated"), (F.count("*") > 2).alias("over_budget"))


@P.add("v2_best_references", """WITH r AS (SELECT * FROM grounded_refs QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY loaded_at DESC) = 1) SELECT cell_id, ref_id, score, rank FROM (SELECT cell_id, ref_id, score, row_number() OVER (PARTITION BY cell_id ORDER BY score DESC NULLS LAST, ref_id) AS rank FROM r) WHERE rank <= 2""")
def v2b(spark, d):
    return dedup.top_per_group(refs(spark, d), ["cell_id"], [F.col("score").desc_nulls_last(), F.col("ref_id")], 2).select("cell_id", "ref_id", "score", "rank")


@P.add("s8_points_by_chapter", """WITH p AS (SELECT * FROM rag_points QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY ingested_at DESC) = 1) SELECT chapter, count(*) AS n, count(original_text) AS originals, coalesce(sum(length(text)), 0)::BIGINT AS chars FROM p GROUP BY 1""")
def s8(spark, d):
    return points(spark, d).groupBy("chapter").agg(F.count("*").alias("n"), F.count("original_text").alias("originals"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("chars"))


@P.add("asof_last_run", f"""WITH {RUNS}, {STEPS} SELECT s.step_id, r.result_id AS last_result FROM steps s ASOF LEFT JOIN (SELECT repo, recorded_at, max(result_id) AS result_id FROM runs WHERE repo IS NOT NULL AND recorded_at IS NOT NULL GROUP BY 1, 2) r ON s.repo = r.repo AND s.created_at >= r.recorded_at WHERE s.repo IS NOT NULL AND s.created_at IS NOT NULL""")
def asof_last_run(spark, d):
    s = steps(spark, d).where("repo is not null and created_at is not null").select("step_id", "repo", "created_at")
    r = runs(spark, d).where("repo is not null and recorded_at is not null").groupBy("repo", "recorded_at").agg(F.max("result_id").alias("result_id"))
    return joins.asof(s, r, ["repo"], "created_at", "recorded_at", "result_id", "last_result").select("step_id", "last_result")
