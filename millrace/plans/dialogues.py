"""Conversations made from the steps of tasks: outcomes, decision windows, reconciled observations, findings.

The test tables hold actions without what the tools answered, so answers are made from the actions themselves, the same way in
both languages: an edit that changes nothing finds no match, a read without a path no file, tests fail until a first
edit, and a search finds what an earlier step of its task wrote. Steps of one source step make one turn.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import conversations as C
from millrace.plans.base import STEPS, Plans, steps
from millrace.plans.curation import ACT

P = Plans()


def answered(spark, d):
    """Steps with the tool's answer."""
    w = Window.partitionBy("task_id").orderBy("step_index", "step_id")
    x = steps(spark, d).select("task_id", "step_id", "step_index", "source_step_index", "action")
    x = x.withColumn("edits", F.sum((ACT.action_type == "edit_file").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    wrote = x.select("task_id", F.struct("step_index", "step_id").alias("written_at"), F.coalesce(ACT.content, ACT.new_string).alias("text")).where("text is not null")
    asked = x.where(ACT.skill_name.isin("fast-grep", "code-map")).select("task_id", F.col("step_id").alias("asked"), F.struct("step_index", "step_id").alias("asked_at"), F.element_at(ACT.args, -1).alias("term"))
    met = asked.join(wrote, "task_id").where("written_at < asked_at and contains(text, term)").select(F.col("asked").alias("step_id")).distinct().withColumn("met", F.lit(True))
    x = x.join(met, "step_id", "left")
    done = F.coalesce("edits", F.lit(0)) > 0
    answer = (
        F.when(ACT.action_type == "edit_file", F.when(ACT.old_string.eqNullSafe(ACT.new_string) | ACT.new_string.isNull(), "No match for old_str").otherwise(F.concat(F.lit("edited "), F.coalesce(ACT.filepath, F.lit("")))))
        .when(ACT.action_type == "read_file", F.when(F.trim(F.coalesce(ACT.filepath, F.lit(""))) == "", "FileNotFoundError").otherwise(F.concat(F.lit("read "), ACT.filepath)))
        .when(ACT.skill_name == "test-gate", F.when(done, "passed").otherwise("FAILED"))
        .when(ACT.skill_name == "repro-check", F.when(done, "asserted").otherwise("AssertionError"))
        .when(ACT.skill_name.isin("fast-grep", "code-map"), F.when(F.col("met"), "1 line").otherwise("No matches"))
        .otherwise("")
    )
    return x.withColumn("observation", answer).drop("edits", "met")


def messages(spark, d):
    """(task_id, pos, role, content, calls): a turn of calls for each source step and an answer for each call."""
    x = answered(spark, d)
    call = F.struct(ACT.action_type.alias("name"), ACT.skill_name.alias("skill"), F.concat_ws("|", ACT.filepath, ACT.args).alias("args"))
    turn = x.groupBy("task_id", "source_step_index").agg(F.sort_array(F.collect_list(F.struct("step_index", "step_id", call.alias("call"), "observation"))).alias("s"))
    pos = F.struct(F.col("source_step_index").alias("turn"), F.lit(0).alias("part"), F.lit(-1).alias("step"))
    said = turn.select("task_id", F.struct(pos["turn"].alias("turn"), F.lit(0).alias("part")).alias("pos"), F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("content"), F.col("s.call").alias("calls"))
    told = turn.select("task_id", "source_step_index", F.posexplode("s").alias("k", "m"))
    told = told.select("task_id", F.struct(F.col("source_step_index").alias("turn"), (F.col("k") + 1).alias("part")).alias("pos"), F.lit("tool").alias("role"), F.col("m.observation").alias("content"), F.array().cast(C.CALLS).alias("calls"))
    return said.unionByName(told)


ANSWERED = f"""{STEPS}, edits AS (SELECT *, coalesce(sum(CASE WHEN action.action_type = 'edit_file' THEN 1 ELSE 0 END) OVER (PARTITION BY task_id ORDER BY step_index, step_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS done FROM steps),
met AS (SELECT DISTINCT q.step_id FROM steps q JOIN steps t ON q.task_id = t.task_id AND (t.step_index, t.step_id) < (q.step_index, q.step_id) AND contains(coalesce(t.action.content, t.action.new_string), q.action.args[-1]) WHERE q.action.skill_name IN ('fast-grep', 'code-map')),
answered AS (SELECT task_id, step_id, step_index, source_step_index, action, CASE
  WHEN action.action_type = 'edit_file' THEN CASE WHEN action.old_string IS NOT DISTINCT FROM action.new_string OR action.new_string IS NULL THEN 'No match for old_str' ELSE 'edited ' || coalesce(action.filepath, '') END
  WHEN action.action_type = 'read_file' THEN CASE WHEN trim(coalesce(action.filepath, '')) = '' THEN 'FileNotFoundError' ELSE 'read ' || action.filepath END
  WHEN action.skill_name = 'test-gate' THEN CASE WHEN done THEN 'passed' ELSE 'FAILED' END
  WHEN action.skill_name = 'repro-check' THEN CASE WHEN done THEN 'asserted' ELSE 'AssertionError' END
  WHEN action.skill_name IN ('fast-grep', 'code-map') THEN CASE WHEN step_id IN (SELECT step_id FROM met) THEN '1 line' ELSE 'No matches' END ELSE '' END AS observation FROM edits)"""


def _like(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


_CLASSIFY = f"""WITH {ANSWERED}, turn AS (SELECT task_id, source_step_index AS pos, string_agg(observation, chr(10) ORDER BY step_index, step_id) AS obs,
  string_agg(concat_ws('~', coalesce(action.action_type, 'null'), coalesce(action.skill_name, 'null'), concat_ws('|', action.filepath, array_to_string(action.args, '|'))), '^' ORDER BY step_index, step_id) AS sig,
  list(action.action_type ORDER BY step_index, step_id) AS names FROM answered GROUP BY 1, 2),
kinds AS (SELECT a.task_id, CASE WHEN a.action.action_type = 'edit_file' AND {_like("t.obs", C.EDIT_FAILED)} OR a.action.action_type = 'read_file' AND {_like("t.obs", C.READ_FAILED)} THEN 'b'
  WHEN a.action.action_type = 'run_skill_script' AND (a.action.skill_name IN ('repro-check', 'test-gate') AND {_like("t.obs", C.TEST_FAILED)} OR a.action.skill_name IN ('fast-grep', 'code-map') AND {_like("t.obs", C.NOTHING_FOUND)}) THEN 'a' ELSE 'clean' END AS kind
  FROM answered a JOIN turn t ON a.task_id = t.task_id AND a.source_step_index = t.pos),
counts AS (SELECT task_id, count(*) FILTER (WHERE kind = 'clean') AS clean, count(*) FILTER (WHERE kind = 'a') AS type_a, count(*) FILTER (WHERE kind = 'b') AS b, count(*) AS calls FROM kinds GROUP BY 1),
seen AS (SELECT task_id, pos, names, sig = lag(sig) OVER (PARTITION BY task_id ORDER BY pos) AS again FROM turn),
ends AS (SELECT task_id, count(*) FILTER (WHERE again) AS repeats, arg_max(names, pos) AS last FROM seen GROUP BY 1)
SELECT c.task_id, clean, type_a, b + repeats AS type_b, calls, b + repeats = 0 AND clean > 0 AND clean < 20 AND type_a < 20 AND clean + type_a < 40 AND list_has_any(last, ['submit_patch', 'edit_file', 'write_file', 'submit', 'finish']) AS valid FROM counts c JOIN ends e ON c.task_id = e.task_id"""


@P.add("f2_outcome_kinds", _CLASSIFY)
def f2(spark, d):
    return C.classify(messages(spark, d))


@P.add("f2_outcomes_reached", f"SELECT 'clean' AS kind, sum(clean)::BIGINT AS calls FROM ({_CLASSIFY}) UNION ALL SELECT 'a', sum(type_a)::BIGINT FROM ({_CLASSIFY}) UNION ALL SELECT 'b', sum(type_b)::BIGINT FROM ({_CLASSIFY}) UNION ALL SELECT 'valid tasks', count(*) FILTER (WHERE valid) FROM ({_CLASSIFY})")
def f2_reached(spark, d):
    x = C.classify(messages(spark, d)).agg(F.sum("clean").alias("clean"), F.sum("type_a").alias("a"), F.sum("type_b").alias("b"), F.sum(F.col("valid").cast("long")).alias("valid tasks"))
    return x.unpivot([], ["clean", "a", "b", "valid tasks"], "kind", "calls")


_MESSAGES = f"""{ANSWERED}, turn AS (SELECT task_id, source_step_index AS pos, list('call:' || coalesce(action.action_type, '') || chr(123) || concat_ws('|', action.filepath, array_to_string(action.args, '|')) || chr(125) ORDER BY step_index, step_id) AS calls, list(action.action_type ORDER BY step_index, step_id) AS names, list(observation ORDER BY step_index, step_id) AS told FROM answered GROUP BY 1, 2),
msgs AS (SELECT task_id, pos, 0 AS part, 'assistant' AS role, array_to_string(calls, '') AS content, array_to_string(names, ',') AS names FROM turn
  UNION ALL SELECT task_id, pos, generate_subscripts(told, 1) AS part, 'tool', unnest(told), NULL FROM turn)"""


@P.add("f6_decision_windows", f"""WITH {_MESSAGES}, led AS (SELECT *, row_number() OVER w - 1 AS turn, string_agg('<' || role || '>' || content || chr(10), '') OVER (PARTITION BY task_id ORDER BY pos, part ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS before,
  string_agg(role, '>') OVER (PARTITION BY task_id ORDER BY pos, part ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS context FROM msgs WINDOW w AS (PARTITION BY task_id ORDER BY pos, part)),
texts AS (SELECT task_id, turn, names, coalesce(context, '') AS context, '<system>Mend the code.' || chr(10) || '<user>Task ' || task_id || chr(10) || coalesce(before, '') || '<assistant>' AS prefix, content || chr(10) AS completion FROM led WHERE role = 'assistant')
SELECT task_id, turn, names, context, md5(prefix) AS prefix, md5(completion) AS completion, len(regexp_extract_all(prefix || completion, '\\S+'))::BIGINT AS tokens FROM texts WHERE starts_with(completion, 'call:') AND NOT contains(completion, '<think>') AND len(regexp_extract_all(prefix || completion, '\\S+')) <= 4096""")
def f6(spark, d):
    x = C.decision_windows(messages(spark, d), "Mend the code.", F.concat(F.lit("Task "), F.col("task_id")))
    return x.withColumn("prefix", F.md5("prefix")).withColumn("completion", F.md5("completion"))


@P.add("f8_observations", f"""WITH {ANSWERED}, src AS (SELECT task_id, step_index, arg_max(observation, step_id) AS told FROM answered GROUP BY 1, 2)
SELECT a.task_id, a.step_id, a.action.action_type AS name, CASE WHEN a.action.action_type = 'submit_patch' THEN 'Patch submitted.' WHEN a.action.skill_name = 'repro-check' AND contains(lower(told), 'assert') THEN 'Assert passed.' WHEN coalesce(told, '') = '' THEN 'Success.' ELSE told END AS observation
FROM answered a LEFT JOIN src s ON a.task_id = s.task_id AND a.source_step_index = s.step_index""")
def f8(spark, d):
    """Each action with what its source step was answered."""
    x = answered(spark, d)
    actions = x.select("task_id", "step_id", "source_step_index", ACT.action_type.alias("name"), ACT.skill_name.alias("skill"))
    sources = x.groupBy("task_id", "step_index").agg(F.max_by("observation", "step_id").alias("observation"))
    return C.reconciled(actions, sources)


@P.add("f9_diagnosis", f"""WITH {STEPS}, t AS (SELECT task_id, (max(step_index) + 1)::INT AS source_steps, arg_min(action.filepath, (step_index, step_id)) FILTER (WHERE action.action_type = 'edit_file') AS target FROM steps GROUP BY 1),
x AS (SELECT s.*, t.source_steps, t.target, action IS NOT DISTINCT FROM lag(action) OVER w AND row_number() OVER w > 1 AS again, CASE action.skill_name WHEN 'fast-grep' THEN 'grep.py' WHEN 'code-map' THEN 'map.py' WHEN 'code-oracle' THEN 'oracle.py' WHEN 'repro-check' THEN 'check.py' WHEN 'test-gate' THEN 'gate.py' END AS script FROM steps s JOIN t ON s.task_id = t.task_id WINDOW w AS (PARTITION BY s.task_id ORDER BY step_index, step_id)),
g AS (SELECT task_id, count(*) AS n, arg_max(action.action_type, (step_index, step_id)) AS last, bool_or(coalesce(action.action_type = 'read_file' OR action.skill_name IN ('fast-grep', 'code-map'), false)) AS looked, bool_or(action.action_type = 'edit_file') AS edited,
  bool_or(source_step_index < 0 OR source_step_index >= source_steps) AS f1, bool_or(action.action_type = 'edit_file' AND ltrim(trim(action.filepath), '/') IS DISTINCT FROM ltrim(trim(target), '/')) AS f2, bool_or(action.action_type = 'edit_file' AND action.old_string IS NOT DISTINCT FROM action.new_string) AS f3,
  bool_or(action.action_type = 'run_skill_script' AND script IS NULL) AS f4, bool_or(action.action_type = 'run_skill_script' AND script IS NOT NULL AND script <> coalesce(action.file_path, '')) AS f5, bool_or(again) AS f6 FROM x GROUP BY 1)
SELECT task_id, concat_ws(';', CASE WHEN f2 THEN 'edit_elsewhere' END, CASE WHEN f3 THEN 'edit_without_change' END, CASE WHEN f1 THEN 'index_out_of_bounds' END, CASE WHEN NOT looked THEN 'no_discovery' END, CASE WHEN NOT edited THEN 'no_edit' END, CASE WHEN last IS DISTINCT FROM 'submit_patch' THEN 'not_submitted' END, CASE WHEN f6 THEN 'repeated_action' END, CASE WHEN n < 3 THEN 'too_few_steps' END, CASE WHEN n > 16 THEN 'too_many_steps' END, CASE WHEN f4 THEN 'unknown_skill' END, CASE WHEN f5 THEN 'wrong_script' END) AS findings FROM g""")
def f9(spark, d):
    """What is wrong with each task; a task's first edit names the file that all of them should change."""
    x = steps(spark, d)
    edit = F.when(ACT.action_type == "edit_file", F.struct("step_index", "step_id", ACT.filepath.alias("path")))
    told = x.groupBy("task_id").agg((F.max("step_index") + 1).alias("source_steps"), F.min(edit)["path"].alias("target"))
    return C.diagnosis(x.join(told, "task_id")).withColumn("findings", F.array_join("findings", ";"))
