"""Sources and sinks at work: what a query writes to the shared folder it reads back through the reader in question."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import conversations as C
from millrace.plans.base import POINTS, RUNS, STEPS, Plans, points, runs, steps
from millrace.plans.curation import ACT
from millrace.plans.dialogues import messages
from millrace.session import shared_path, table
from millrace.sources import files, sinks

P = Plans()


@P.add("s6_ids_of_json_lines", f"WITH {RUNS} SELECT DISTINCT instance_id FROM runs WHERE instance_id IS NOT NULL AND instance_id <> ''")
def s6(spark, d):
    """The ids in a dump of results with blank lines and lines that are no JSON among them."""
    path = shared_path(spark, "results")
    x = runs(spark, d).select(F.to_json(F.struct("instance_id", "resolved")).alias("value"))
    x.unionByName(x.select(F.lit("").alias("value")).distinct()).unionByName(x.select(F.lit('["no object"').alias("value")).distinct()).write.text(path)
    return files.ids_of_json_lines(spark, path)


@P.add("s7_staged_once", "SELECT lang, count(*) AS texts FROM documents GROUP BY 1")
def s7(spark, d):
    """A table made on the first call and read on the second, whose maker must not run."""
    path = shared_path(spark, "staged")
    make = lambda: table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("texts"))
    files.staged_or_else(spark, path, make)

    def never():
        raise AssertionError("made twice")

    return files.staged_or_else(spark, path, never)


@P.add("s9_nested_steps", f"WITH {STEPS} SELECT task_id, step_index, step_id, action.action_type AS action_type, action.filepath AS filepath FROM steps")
def s9(spark, d):
    """Documents of a task with its nested steps, one JSON object each, read back as steps."""
    path = shared_path(spark, "nested")
    one = F.struct("step_index", "step_id", ACT.action_type.alias("action_type"), ACT.filepath.alias("filepath"))
    steps(spark, d).groupBy("task_id").agg(F.sort_array(F.collect_list(one)).alias("steps")).write.json(path)
    return files.nested(spark, path, "task_id string, steps array<struct<step_index:int,step_id:bigint,action_type:string,filepath:string>>", "steps")


@P.add("s10_catalog", "SELECT instance_id, repo, base_commit FROM bench_tasks")
def s10(spark, d):
    """The held-out tasks as one JSON array of records of an exact schema; they are few at every scale."""
    path = shared_path(spark, "catalog")
    x = table(spark, d, "bench_tasks").agg(F.to_json(F.sort_array(F.collect_list(F.struct("instance_id", "repo", "base_commit")))).alias("value"))
    x.write.text(path)
    return files.catalog(spark, path, "instance_id string, repo string, base_commit string")


@P.add("s12_task_list", "SELECT instance_id AS task, (row_number() OVER (ORDER BY instance_id) * 2 - 1)::INT AS place FROM bench_tasks")
def s12(spark, d):
    """A list of tasks with comments and repeats."""
    path = shared_path(spark, "tasks")
    ids = table(spark, d, "bench_tasks").agg(F.sort_array(F.collect_list("instance_id")).alias("v"))
    lines = F.concat(F.lit("# tasks\n"), F.array_join(F.transform("v", lambda i: F.concat(i, F.lit("  # note\n"))), "\n"), F.lit("\n"), F.get("v", F.lit(0)))
    ids.select(lines.alias("value")).write.text(path)
    return files.task_list(spark, path).select("task", F.col("place").cast("int").alias("place"))


@P.add("s14_zip_members", "SELECT instance_id || '.diff' AS member, octet_length(encode(patch)) AS bytes, sha256(patch) AS sha256 FROM bench_tasks")
def s14(spark, d):
    """The patches packed into an archive on the driver (they are few at every scale), its members read back with digests."""
    import io
    import zipfile

    box = io.BytesIO()
    with zipfile.ZipFile(box, "w", zipfile.ZIP_DEFLATED) as z:
        for r in table(spark, d, "bench_tasks").select("instance_id", "patch").orderBy("instance_id").collect():
            z.writestr(f"{r.instance_id}.diff", r.patch)
    path = shared_path(spark, "archive")
    sinks.write_bytes(spark, f"{path}/patches.zip", box.getvalue())
    return files.zip_members(spark, path).select("member", "bytes", "sha256")


@P.add("s18_policy", "SELECT * FROM (VALUES ('', 'version', '2'), ('limits', 'bytes', '1000'), ('limits', 'share', '0.5'), ('gates', 'strict', 'True'), ('gates', 'name', 'a: b'), ('gates', 'none', NULL)) AS t(section, key, value)")
def s18(spark, d):
    text = "# policy\nversion: 2\nlimits:\n  bytes: 1000\n  share: 0.5 # half\ngates:\n  strict: true\n  name: 'a: b'\n  none: ~\n"
    return spark.createDataFrame([(s, k, None if v is None else str(v)) for s, k, v in files.policy(text)], "section string, key string, value string")


@P.add("k1_ordered_json_lines", f"WITH {RUNS} SELECT row_number() OVER (ORDER BY task_index NULLS FIRST, result_id) AS place, result_id FROM runs")
def k1(spark, d):
    """Results written as JSON lines in order; the order is read back from the files' names and the places of their lines."""
    path = shared_path(spark, "ordered")
    sinks.json_lines(runs(spark, d).select("result_id", "task_index"), path, [F.col("task_index").asc_nulls_first(), F.col("result_id")])
    return files.numbered_lines(spark, path, "result_id long, task_index int").select("place", "result_id")


@P.add("k5_rejects", f"WITH {STEPS} SELECT CASE WHEN source IS NULL THEN 'no_source' WHEN action.action_type = 'write_file' AND action.content IS NULL THEN 'no_content' ELSE 'kept' END AS outcome, count(*) AS n FROM steps GROUP BY 1")
def k5(spark, d):
    kept, lost = shared_path(spark, "accepted"), shared_path(spark, "rejected")
    reason = F.when(F.col("source").isNull(), "no_source").when((ACT.action_type == "write_file") & ACT.content.isNull(), "no_content")
    sinks.split_rejects(steps(spark, d).select("step_id", reason.alias("reason")), "reason", kept, lost)
    x = spark.read.parquet(lost).select("reason").unionByName(spark.read.parquet(kept).select(F.lit("kept").alias("reason")))
    return x.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n"))


@P.add("k6_artefacts", f"WITH {STEPS}, t AS (SELECT task_id, source_step_index, count(*) AS calls FROM steps GROUP BY 1, 2) SELECT task_id, count(*) AS windows, sum(calls)::BIGINT + count(*) AS messages FROM t GROUP BY 1")
def k6(spark, d):
    """Each task's conversation once and its windows one by one, both from one computation; read back and counted."""
    whole, parts = shared_path(spark, "trajectories"), shared_path(spark, "windows")
    m = messages(spark, d)
    sinks.artefacts(m, whole, {parts: lambda x: C.decision_windows(x, "s", F.lit("u"), most=1 << 30)})
    w = spark.read.parquet(parts).groupBy("task_id").agg(F.count("*").alias("windows"))
    return w.join(spark.read.parquet(whole).groupBy("task_id").agg(F.count("*").alias("messages")), "task_id")


@P.add("k7_resume", f"WITH {POINTS} SELECT 'first' AS run, count(*) AS n FROM points WHERE chapter IS NOT NULL UNION ALL SELECT 'second', count(*) FROM points WHERE chapter IS NULL UNION ALL SELECT 'third', 0")
def k7(spark, d):
    """Three runs over the points: those with a chapter, then what is left, then nothing."""
    path = shared_path(spark, "processed")
    x = points(spark, d).select("point_id", "chapter")
    out = None
    for name, of in (("first", x.where("chapter is not null")), ("second", x), ("third", x)):
        rest = sinks.resume(of, "point_id", path)
        n = rest.count()
        if n:
            sinks.mark_processed(rest, "point_id", path)
        row = spark.createDataFrame([(name, n)], "run string, n long")
        out = row if out is None else out.unionByName(row)
    return out


@P.add("k12_csv", f"WITH {RUNS} SELECT result_id, repo, coalesce(error, '') AS error FROM runs")
def k12(spark, d):
    path = shared_path(spark, "csv")
    sinks.csv(runs(spark, d).select("result_id", "repo", F.coalesce("error", F.lit("")).alias("error")), path, [F.col("result_id")])
    x = spark.read.option("header", True).option("emptyValue", "").schema("result_id long, repo string, error string").csv(path)
    return x.select("result_id", "repo", F.coalesce("error", F.lit("")).alias("error"))
