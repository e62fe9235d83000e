"""Predicates and projections over whole tables: targets of patches, globs, walks, priorities, aliases, comparisons, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import predicates as Q
from millrace.operators import conversations as C
from millrace.operators import search
from millrace.operators.dedup import content_digest, remapped, selected
from millrace.plans.base import POINTS, REFS, RUNS, STEPS, Plans, points, refs, runs, steps
from millrace.plans.curation import ACT
from millrace.plans.dialogues import _MESSAGES, messages
from millrace.session import table

P = Plans()
_BOTH = """both_ AS (SELECT instance_id, 'patch' AS part, patch AS diff FROM bench_tasks UNION ALL SELECT instance_id, 'test_patch', test_patch FROM bench_tasks),
s AS (SELECT instance_id, part, unnest(string_split(diff, chr(10))) AS l FROM both_), f AS (SELECT DISTINCT instance_id, part, regexp_replace(regexp_extract(l, '^(?:---|\\+\\+\\+) (\\S+)', 1), '^[ab]/', '') AS p FROM s WHERE regexp_matches(l, '^(---|\\+\\+\\+) ')),
g AS (SELECT instance_id, part, count(*) AS files, min(p) AS p FROM f WHERE p <> '/dev/null' AND p <> '' GROUP BY 1, 2)"""


def _diffs(spark, d) -> DataFrame:
    b = table(spark, d, "bench_tasks")
    return b.select("instance_id", F.lit("patch").alias("part"), F.col("patch").alias("diff")).unionByName(b.select("instance_id", F.lit("test_patch").alias("part"), F.col("test_patch").alias("diff")))


@P.add("pred6_single_target", f"WITH {_BOTH} SELECT b.instance_id, b.part, CASE WHEN g.files = 1 AND g.p LIKE '%.py' AND NOT starts_with(g.p, 'tests/') AND NOT starts_with(split_part(g.p, '/', -1), 'test_') THEN g.p END AS target FROM both_ b LEFT JOIN g ON b.instance_id = g.instance_id AND b.part = g.part")
def pred6(spark, d):
    return _diffs(spark, d).select("instance_id", "part", Q.single_target(F.col("diff")).alias("target"))


@P.add("pred7_header_target", f"WITH {_BOTH} SELECT b.instance_id, b.part, CASE WHEN g.files = 1 AND g.p LIKE '%.py' THEN regexp_replace(regexp_extract(diff, 'diff --git \\S+ (\\S+)', 1), '^b/', '') END AS target FROM both_ b LEFT JOIN g ON b.instance_id = g.instance_id AND b.part = g.part")
def pred7(spark, d):
    return _diffs(spark, d).select("instance_id", "part", Q.header_target(F.col("diff")).alias("target"))


@P.add("pred8_target_touched", f"""WITH {STEPS}, t AS (SELECT task_id, ltrim(trim(arg_min(action.filepath, (step_index, step_id)) FILTER (WHERE action.action_type = 'edit_file')), '/') AS target FROM steps GROUP BY 1),
x AS (SELECT s.step_id, t.target, list_transform(regexp_extract_all(concat_ws(' ', action.filepath, array_to_string(action.args, ' ')), '[\\w\\-./]+\\.py'), lambda p: ltrim(p, '/')) AS paths FROM steps s JOIN t ON s.task_id = t.task_id)
SELECT step_id, coalesce(target <> '' AND len(list_filter(paths, lambda p: contains(p, target) OR contains(target, p))) > 0, false) AS touched FROM x""")
def pred8(spark, d):
    """Whether a step names the file that its task edits first."""
    x = steps(spark, d)
    edit = F.when(ACT.action_type == "edit_file", F.struct("step_index", "step_id", ACT.filepath.alias("path")))
    target = x.groupBy("task_id").agg(F.min(edit)["path"].alias("target"))
    return x.join(target, "task_id").select("step_id", Q.touches(F.concat_ws(" ", ACT.filepath, ACT.args), F.col("target")).alias("touched"))


GLOBS = ["tests/*", "*.md", "src/[a-f]*", "lib/?o*.py", "core/[!a-m]*"]


@P.add("pred11_globs", f"WITH {STEPS}, p AS (SELECT DISTINCT action.filepath AS path FROM steps WHERE action.filepath IS NOT NULL) SELECT path, path GLOB 'tests/*' OR path GLOB '*.md' OR path GLOB 'src/[a-f]*' OR path GLOB 'lib/?o*.py' OR path GLOB 'core/[!a-m]*' AS excluded FROM p")
def pred11(spark, d):
    x = steps(spark, d).select(ACT.filepath.alias("path")).where("path is not null").distinct()
    return x.select("path", Q.matches_glob(F.col("path"), GLOBS).alias("excluded"))


@P.add("pred13_skipped_paths", f"""WITH {STEPS}, p AS (SELECT step_id, CASE step_id % 6 WHEN 0 THEN '.git/' WHEN 1 THEN 'a/__pycache__/' WHEN 2 THEN 'Build/' WHEN 3 THEN 'x.EGG-info/' ELSE '' END || action.filepath AS path FROM steps WHERE action.filepath IS NOT NULL)
SELECT step_id, path, len(list_filter(string_split(path, '/'), lambda v: v <> '' AND (starts_with(v, '.') OR starts_with(v, '__') OR contains(lower(v), 'egg-info') OR lower(v) IN ({", ".join(f"'{x}'" for x in Q.SKIPPED_FOLDERS)})))) > 0 AS skipped FROM p""")
def pred13(spark, d):
    """Paths of steps, two thirds of them put below a folder that walks leave out."""
    n = F.pmod("step_id", F.lit(6))
    head = F.when(n == 0, ".git/").when(n == 1, "a/__pycache__/").when(n == 2, "Build/").when(n == 3, "x.EGG-info/").otherwise("")
    x = steps(spark, d).where(ACT.filepath.isNotNull()).select("step_id", F.concat(head, ACT.filepath).alias("path"))
    return x.select("step_id", "path", Q.is_skipped(F.col("path")).alias("skipped"))


_PICK = f"""WITH {POINTS}, {REFS}, c AS (SELECT row_number() OVER (ORDER BY point_id) - 1 AS idx, point_id::VARCHAR AS id FROM points), done AS (SELECT DISTINCT id FROM c WHERE idx % 3 = 0), failed AS (SELECT DISTINCT id FROM c WHERE idx % 7 = 0)
SELECT 'failed' AS mode, id FROM c WHERE id IN (SELECT id FROM failed) UNION ALL SELECT 'target', id FROM c WHERE contains(id, '12') OR idx = 12 UNION ALL SELECT 'forced', id FROM c WHERE idx >= 50 UNION ALL SELECT 'pending', id FROM c WHERE idx >= 50 AND id NOT IN (SELECT id FROM done)"""


@P.add("pred15_selected_sources", _PICK)
def pred15(spark, d):
    from millrace.operators.ordering import numbered

    c = numbered(points(spark, d).select(F.col("point_id").cast("string").alias("id"), "point_id"), ["point_id"], "idx").select("id", (F.col("idx") - 1).alias("idx"))
    done, failed = c.where("idx % 3 = 0").select("id"), c.where("idx % 7 = 0").select("id")
    modes = {"failed": {"retry_failed": True, "target": "12"}, "target": {"target": "12", "force": True}, "forced": {"force": True}, "pending": {}}
    out = None
    for name, how in modes.items():
        x = selected(c, "id", "idx", done, failed, start=50, **how).select(F.lit(name).alias("mode"), "id")
        out = x if out is None else out.unionByName(x)
    return out


@P.add("pred16_window_guards", f"""WITH {_MESSAGES}, led AS (SELECT *, row_number() OVER w - 1 AS turn, string_agg('<' || role || '>' || content || chr(10), '') OVER (PARTITION BY task_id ORDER BY pos, part ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS before FROM msgs WINDOW w AS (PARTITION BY task_id ORDER BY pos, part)),
texts AS (SELECT task_id, turn, '<system>Mend.' || chr(10) || '<user>Go.' || chr(10) || coalesce(before, '') || '<assistant>' || content || chr(10) AS whole FROM led WHERE role = 'assistant')
SELECT task_id, turn, len(regexp_extract_all(whole, '\\S+'))::BIGINT AS tokens FROM texts WHERE len(regexp_extract_all(whole, '\\S+')) <= 7""")
def pred16(spark, d):
    """The windows that a limit of seven words lets through."""
    return C.decision_windows(messages(spark, d), "Mend.", F.lit("Go."), most=7).select("task_id", "turn", "tokens")


@P.add("pred20_aliases", f"""WITH {RUNS} SELECT result_id, instance_id, CASE WHEN result_id % 3 = 0 THEN agent_patch_size ELSE octet_length(encode(repo || 'é')) END::BIGINT AS agent_patch_size, CASE WHEN result_id % 2 = 0 THEN error END AS error FROM runs""")
def pred20(spark, d):
    """Results that name their fields in two ways: ids as task_id, patches by their text, errors as error_message."""
    x = runs(spark, d).select(
        "result_id", F.when(F.pmod("result_id", F.lit(2)) == 0, F.col("instance_id")).alias("instance_id"), F.col("instance_id").alias("task_id"),
        F.when(F.pmod("result_id", F.lit(3)) == 0, F.struct(F.col("agent_patch_size").cast("long").alias("v"))).alias("size"), F.concat("repo", F.lit("é")).alias("agent_patch"),
        F.when(F.pmod("result_id", F.lit(2)) == 0, F.col("error")).alias("error_message"),
    )
    y = remapped(x.withColumn("has_size", F.col("size").isNotNull()), {"instance_id": ["task_id"], "error": ["error_message"]})
    return y.select("result_id", "instance_id", F.when(F.col("has_size"), F.col("size.v")).otherwise(F.octet_length("agent_patch").cast("long")).alias("agent_patch_size"), "error")


@P.add("pred22_substance")
def pred22(spark, d):
    x = table(spark, d, "documents").select("source", Q.has_substance(F.col("text")).alias("good"))
    return x.groupBy("source").agg(F.count("*").alias("texts"), F.sum(F.col("good").cast("long")).alias("substantial"))


OPERATORS = ("==", "!=", "<", "<=", ">", ">=", "is", "is not", "in", "not in", "~")


@P.add("m11_comparisons", f"""WITH {RUNS}, x AS (SELECT result_id, (result_id % 11)::INT AS k, tool_calls::VARCHAR AS l, CASE WHEN result_id % 5 = 0 THEN NULL ELSE total_llm_calls::VARCHAR END AS r FROM runs)
SELECT result_id, [{", ".join(f"'{o}'" for o in OPERATORS)}][k + 1] AS op, coalesce(CASE k WHEN 0 THEN l = r WHEN 1 THEN l <> r WHEN 2 THEN l < r WHEN 3 THEN l <= r WHEN 4 THEN l > r WHEN 5 THEN l >= r WHEN 6 THEN l IS NOT DISTINCT FROM r WHEN 7 THEN l IS DISTINCT FROM r WHEN 8 THEN contains(r, l) WHEN 9 THEN NOT contains(r, l) END, false) AS holds FROM x""")
def m11(spark, d):
    op = F.get(F.array(*map(F.lit, OPERATORS)), F.pmod("result_id", F.lit(11)).cast("int"))
    right = F.when(F.pmod("result_id", F.lit(5)) != 0, F.col("total_llm_calls").cast("string"))
    return runs(spark, d).select("result_id", op.alias("op"), Q.compared_by(F.col("tool_calls").cast("string"), op, right).alias("holds"))


_SCHEMAS = "x AS (SELECT DISTINCT collection_name, file_no, line_no, raw FROM rag_exports WHERE json_valid(raw) AND json_type(raw) = 'OBJECT' AND starts_with(raw, '{'))"


def _schemas(spark, d) -> DataFrame:
    """Schemas whose definitions are named by the keys of the export lines."""
    x = table(spark, d, "rag_exports").where(F.json_object_keys("raw").isNotNull() & F.col("raw").startswith("{")).select("collection_name", "file_no", "line_no", "raw").distinct()
    odd = F.pmod("line_no", F.lit(2)) == 1
    return x.withColumn("schema", F.when(odd, F.concat(F.lit('{"$defs":'), "raw", F.lit(',"definitions":{"text":{}}}'))).otherwise(F.concat(F.lit('{"components":{"schemas":'), "raw", F.lit("}}"))))


@P.add("g4_definition_targets", f"""WITH {_SCHEMAS}, k AS (SELECT collection_name, file_no, line_no, line_no % 2 = 1 AS odd, unnest(json_keys(raw)) AS name FROM x),
y AS (SELECT name, CASE WHEN odd AND name <> 'text' THEN '#/$defs/' || name WHEN odd THEN '#/definitions/text' ELSE '#/components/schemas/' || name END AS target FROM k
  UNION ALL SELECT 'text', '#/definitions/text' FROM x WHERE line_no % 2 = 1 AND NOT list_contains(json_keys(raw), 'text'))
SELECT name, target, count(*) AS schemas FROM y GROUP BY 1, 2""")
def g4(spark, d):
    x = _schemas(spark, d).select(F.explode(Q.definition_targets(F.col("schema"))).alias("name", "target"))
    return x.groupBy("name", "target").agg(F.count("*").alias("schemas"))


@P.add("j19_reference_hints", f"""WITH {_SCHEMAS}, k AS (SELECT collection_name, file_no, line_no, line_no % 2 = 1 AS odd, ['text', 'Source', 'nowhere'][(line_no % 3 + 1)::INT] AS ref, json_keys(raw) AS keys FROM x),
t AS (SELECT *, CASE WHEN odd AND ref = 'text' THEN '#/definitions/text' WHEN list_contains(keys, ref) THEN CASE WHEN odd THEN '#/$defs/' ELSE '#/components/schemas/' END || ref END AS exact,
  CASE WHEN list_contains(list_transform(keys, lambda v: lower(v)), lower(ref)) THEN CASE WHEN odd THEN '#/$defs/' ELSE '#/components/schemas/' END || list_filter(list_sort(keys), lambda v: lower(v) = lower(ref))[1] END AS by_case FROM k)
SELECT ref, CASE WHEN exact IS NOT NULL THEN 'exact' WHEN by_case IS NOT NULL THEN 'case' ELSE 'none' END AS tier, coalesce(exact, by_case) AS target, count(*) AS n FROM t GROUP BY 1, 2, 3""")
def j19(spark, d):
    ref = F.get(F.array(F.lit("text"), F.lit("Source"), F.lit("nowhere")), F.pmod("line_no", F.lit(3)).cast("int"))
    x = _schemas(spark, d).select(ref.alias("ref"), Q.hinted_target(F.concat(F.lit("#/a/"), ref), Q.definition_targets(F.col("schema"))).alias("hint"))
    return x.groupBy("ref", F.coalesce("hint.tier", F.lit("none")).alias("tier"), F.col("hint.target").alias("target")).agg(F.count("*").alias("n"))


@P.add("w10_rank_frames", f"""WITH {RUNS} SELECT result_id, ntile(4) OVER w AS quarter, round(cume_dist() OVER w, 9) AS cumulated, round(percent_rank() OVER w, 9) AS percent, count(*) OVER (PARTITION BY repo ORDER BY tool_calls RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near FROM runs WINDOW w AS (PARTITION BY repo ORDER BY tool_calls, result_id)""")
def w10(spark, d):
    w = Window.partitionBy("repo").orderBy("tool_calls", "result_id")
    near = Window.partitionBy("repo").orderBy("tool_calls").rangeBetween(-5, 5)
    return runs(spark, d).select("result_id", F.ntile(4).over(w).cast("long").alias("quarter"), F.round(F.cume_dist().over(w), 9).alias("cumulated"), F.round(F.percent_rank().over(w), 9).alias("percent"), F.count("*").over(near).alias("near"))


@P.add("a1_tools_by_source", f"WITH {STEPS} SELECT coalesce(source, 'none') AS source, action.action_type AS tool, count(*) AS n FROM steps GROUP BY 1, 2")
def a1(spark, d):
    return steps(spark, d).groupBy(F.coalesce("source", F.lit("none")).alias("source"), ACT.action_type.alias("tool")).agg(F.count("*").alias("n"))


@P.add("k10_content_digest", "SELECT lang, count(*) AS texts, sha256(sha256(string_agg(sha256(coalesce(text, '')), '' ORDER BY doc_id))) AS digest FROM documents GROUP BY 1")
def k10(spark, d):
    """SHA-256 of the texts of each language in the order of their ids, over digests of blocks (one at this size)."""
    return content_digest(table(spark, d, "documents"), ["lang"], "doc_id", "text")


@P.add("c4_candidate_symbols", f"""WITH {STEPS}, w AS (SELECT step_id, action.content AS text FROM steps WHERE action.action_type = 'write_file' AND action.content IS NOT NULL),
l AS (SELECT step_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM w),
s AS (SELECT step_id, line_no, 1 AS part, regexp_extract(line, '^\\s*(?:async\\s+def|def)\\s+([A-Za-z_]\\w*)', 1) AS symbol, 'function' AS kind FROM l UNION ALL SELECT step_id, line_no, 2, regexp_extract(line, '^\\s*class\\s+([A-Za-z_]\\w*)', 1), 'class' FROM l UNION ALL SELECT step_id, line_no, 3, regexp_extract(line, '^\\s*([A-Za-z_]\\w*)\\s*=[^=]', 1), 'store' FROM l),
f AS (SELECT *, row_number() OVER (PARTITION BY step_id, symbol ORDER BY line_no, part) AS n FROM s WHERE symbol <> '')
SELECT step_id, symbol, kind, line_no FROM f WHERE n = 1""")
def c4(spark, d):
    """Each file's functions, classes and stores, each symbol where it first stands."""
    files = steps(spark, d).where((ACT.action_type == "write_file") & ACT.content.isNotNull()).select(F.col("step_id").alias("file_id"), ACT.filepath.alias("path"), ACT.content.alias("text"))
    return search.candidate_symbols(files).withColumnRenamed("file_id", "step_id")
