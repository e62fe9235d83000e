"""Run results: summaries, histograms, verdicts, bands, quantiles, running scores."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import analytics as A
from millrace.operators.dedup import latest
from millrace.plans.base import RUNS, STEPS, Plans, runs, steps
from millrace.session import shared_path, table

P = Plans()


@P.add("flagship_curation", f"""
WITH {RUNS}, held AS (SELECT DISTINCT instance_id FROM bench_tasks WHERE instance_id IS NOT NULL), {STEPS}
SELECT coalesce(s.source, 'none') AS source, count(*) AS steps, count(DISTINCT s.task_id) AS tasks,
  coalesce(sum(CASE WHEN h.instance_id IS NULL THEN 1 ELSE 0 END), 0)::BIGINT AS clean_steps,
  round(coalesce(sum(CASE WHEN h.instance_id IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*), 0), 4) AS clean_rate
FROM steps s LEFT JOIN held h ON s.task_id = h.instance_id GROUP BY 1""")
def flagship(spark, d):
    """Steps per source with those of held-out tasks told apart."""
    held = table(spark, d, "bench_tasks").select(F.col("instance_id").alias("task_id")).where("task_id is not null").distinct().withColumn("held", F.lit(True))
    x = steps(spark, d).select(F.coalesce("source", F.lit("none")).alias("source"), "task_id").join(held, "task_id", "left")
    clean = A.count_if(F.col("held").isNull())
    return x.groupBy("source").agg(F.count("*").alias("steps"), F.countDistinct("task_id").alias("tasks"), clean.alias("clean_steps"), A.rate(clean, F.count("*")).alias("clean_rate"))


@P.add("a2_repo_histogram", f"WITH {RUNS} SELECT repo, count(*) AS n FROM runs GROUP BY 1")
def a2(spark, d):
    return runs(spark, d).groupBy("repo").agg(F.count("*").alias("n"))


@P.add("a3_exit_codes", f"WITH {RUNS} SELECT coalesce(test_exit_code::VARCHAR, 'None') AS code, count(*) AS n FROM runs GROUP BY 1")
def a3(spark, d):
    return A.histogram(runs(spark, d), F.col("test_exit_code"), "code")


@P.add("a4_run_summary", f"""WITH {RUNS} SELECT run_id, count(*) AS total, sum(CASE WHEN resolved THEN 1 ELSE 0 END)::BIGINT AS resolved_n,
  round(sum(CASE WHEN resolved THEN 1 ELSE 0 END)::DOUBLE / count(*), 4) AS resolve_rate, count(error) AS errors FROM runs GROUP BY 1""")
def a4(spark, d):
    hit = A.count_if(F.col("resolved"))
    return runs(spark, d).groupBy("run_id").agg(F.count("*").alias("total"), hit.alias("resolved_n"), A.rate(hit, F.count("*")).alias("resolve_rate"), F.count("error").alias("errors"))


@P.add("a4_by_repo", f"""WITH {RUNS} SELECT run_id, repo, count(*) AS total, sum(CASE WHEN resolved THEN 1 ELSE 0 END)::BIGINT AS resolved_n FROM runs GROUP BY 1, 2""")
def a4b(spark, d):
    return runs(spark, d).groupBy("run_id", "repo").agg(F.count("*").alias("total"), A.count_if(F.col("resolved")).alias("resolved_n"))


@P.add("a5_degenerate_runs", f"""WITH {RUNS}, x AS (SELECT run_id, count(*) AS n, sum(CASE WHEN coalesce(agent_patch_size, 0) = 0 THEN 1 ELSE 0 END)::BIGINT AS empty_patches,
  sum(CASE WHEN coalesce(total_llm_calls, 0) = 0 THEN 1 ELSE 0 END)::BIGINT AS silent FROM runs GROUP BY 1)
SELECT run_id, n, empty_patches, round(silent::DOUBLE / n, 4) AS silent_share, empty_patches >= 100 AND silent::DOUBLE / n >= 0.5 AS degenerate FROM x""")
def a5(spark, d):
    x = runs(spark, d).groupBy("run_id").agg(F.count("*").alias("n"), A.count_if(F.coalesce("agent_patch_size", F.lit(0)) == 0).alias("empty_patches"), A.count_if(F.coalesce("total_llm_calls", F.lit(0)) == 0).alias("silent"))
    share = F.col("silent") / F.col("n")
    return x.select("run_id", "n", "empty_patches", F.round(share, 4).alias("silent_share"), ((F.col("empty_patches") >= 100) & (share >= 0.5)).alias("degenerate"))


@P.add("a6_small_patches", f"""WITH {RUNS} SELECT run_id, round(avg(CASE WHEN agent_patch_size < 200 THEN 1.0 WHEN agent_patch_size IS NOT NULL THEN 0.0 END), 6) AS small_share FROM runs GROUP BY 1""")
def a6(spark, d):
    return runs(spark, d).groupBy("run_id").agg(F.round(F.avg((F.col("agent_patch_size") < 200).cast("double")), 6).alias("small_share"))


@P.add("a8_distinct_counts", f"WITH {RUNS} SELECT repo, count(DISTINCT instance_id) AS tasks, count(DISTINCT run_id) AS run_count FROM runs GROUP BY 1")
def a8(spark, d):
    return runs(spark, d).groupBy("repo").agg(F.countDistinct("instance_id").alias("tasks"), F.countDistinct("run_id").alias("run_count"))


@P.add("a9_max_or_zero", f"WITH {RUNS} SELECT run_id, coalesce(max(total_llm_calls), 0)::INTEGER AS most_calls FROM runs GROUP BY 1")
def a9(spark, d):
    return runs(spark, d).groupBy("run_id").agg(F.coalesce(F.max("total_llm_calls"), F.lit(0)).alias("most_calls"))


@P.add("a10_phase_sums", f"""WITH {RUNS} SELECT repo, round(sum(duration_seconds), 4) AS seconds, count(duration_seconds) AS samples, sum(tool_calls)::BIGINT AS tool_calls, count(tool_calls) AS tool_samples FROM runs GROUP BY 1""")
def a10(spark, d):
    return runs(spark, d).groupBy("repo").agg(F.round(F.sum("duration_seconds"), 4).alias("seconds"), F.count("duration_seconds").alias("samples"), F.sum("tool_calls").alias("tool_calls"), F.count("tool_calls").alias("tool_samples"))


@P.add("a11_patch_bands", f"""WITH {RUNS}, x AS (SELECT CASE WHEN agent_patch_size IS NULL THEN NULL WHEN agent_patch_size <= 1200 THEN 'to_1200' WHEN agent_patch_size <= 4000 THEN 'to_4000' WHEN agent_patch_size <= 6000 THEN 'to_6000' ELSE 'above' END AS band, resolved FROM runs)
SELECT band, count(*) AS n, round(avg(CASE WHEN resolved THEN 1.0 WHEN resolved IS NOT NULL THEN 0.0 END), 6) AS resolve_rate FROM x GROUP BY 1""")
def a11(spark, d):
    band = A.banded(F.col("agent_patch_size"), [("to_1200", 1200), ("to_4000", 4000), ("to_6000", 6000)], "above")
    return runs(spark, d).groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.round(F.avg(F.col("resolved").cast("double")), 6).alias("resolve_rate"))


@P.add("a12_growth_median", f"""WITH {RUNS}, x AS (SELECT run_id, duration_seconds, lag(duration_seconds) OVER (PARTITION BY run_id ORDER BY started_at, result_id) AS before FROM runs WHERE duration_seconds IS NOT NULL)
SELECT run_id, count(*) AS pairs, round(median(duration_seconds / before), 6) AS median_ratio FROM x WHERE before > 0 GROUP BY 1""")
def a12(spark, d):
    w = Window.partitionBy("run_id").orderBy("started_at", "result_id")
    x = runs(spark, d).where("duration_seconds is not null").withColumn("before", F.lag("duration_seconds").over(w)).where("before > 0")
    return x.groupBy("run_id").agg(F.count("*").alias("pairs"), F.round(F.percentile(F.col("duration_seconds") / F.col("before"), F.lit(0.5)), 6).alias("median_ratio"))


@P.add("a13_quantiles", f"""WITH {RUNS} SELECT repo, count(duration_seconds) AS n, min(duration_seconds) AS least, max(duration_seconds) AS most, round(quantile_cont(duration_seconds, 0.25), 6) AS p25,
  round(quantile_cont(duration_seconds, 0.5), 6) AS p50, round(quantile_cont(duration_seconds, 0.75), 6) AS p75, round(quantile_cont(duration_seconds, 0.9), 6) AS p90, round(quantile_cont(duration_seconds, 0.99), 6) AS p99 FROM runs GROUP BY 1""")
def a13(spark, d):
    ps = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
    x = A.quantiles(runs(spark, d), ["repo"], "duration_seconds", ps)
    return x.select("repo", "n", "least", "most", *[F.round(p, 6).alias(p) for p in ps])


@P.add("a14_shares", f"WITH {STEPS}, x AS (SELECT action.action_type AS kind, count(*) AS n FROM steps GROUP BY 1) SELECT kind, n, round(n / sum(n) OVER (), 6) AS share FROM x")
def a14(spark, d):
    return A.shares(steps(spark, d).select(F.col("action.action_type").alias("kind")), "kind")


@P.add("a15_crosstab", f"""WITH {RUNS} SELECT repo, count(*) FILTER (WHERE resolved) AS resolved_n, count(*) FILTER (WHERE NOT resolved) AS failed_n FROM runs GROUP BY 1""")
def a15(spark, d):
    x = runs(spark, d).groupBy("repo").pivot("resolved", [True, False]).agg(F.count(F.lit(1)))
    return x.select("repo", F.coalesce("true", F.lit(0)).alias("resolved_n"), F.coalesce("false", F.lit(0)).alias("failed_n"))


@P.add("a18_tallies", f"""WITH {RUNS}, x AS (SELECT repo, CASE WHEN error IS NOT NULL THEN 'FAIL' WHEN test_exit_code IS NULL THEN 'WARN' ELSE 'PASS' END AS status FROM runs)
SELECT repo, status, count(*) AS n, bool_or(status = 'FAIL') AS any_fail FROM x GROUP BY 1, 2""")
def a18(spark, d):
    status = F.when(F.col("error").isNotNull(), "FAIL").when(F.col("test_exit_code").isNull(), "WARN").otherwise("PASS")
    return runs(spark, d).groupBy("repo", status.alias("status")).agg(F.count("*").alias("n"), F.bool_or(status == "FAIL").alias("any_fail"))


@P.add("a19_capped_evidence", f"""WITH {RUNS}, x AS (SELECT DISTINCT repo, instance_id FROM runs WHERE instance_id IS NOT NULL), y AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY instance_id) AS k, count(*) OVER (PARTITION BY repo) AS n FROM x)
SELECT repo, string_agg(instance_id, ', ' ORDER BY k) FILTER (WHERE k <= 5) || CASE WHEN max(n) > 5 THEN ', ...' ELSE '' END AS evidence FROM y GROUP BY 1""")
def a19(spark, d):
    x = runs(spark, d).where("instance_id is not null").select("repo", "instance_id").distinct()
    w = Window.partitionBy("repo")
    x = x.withColumn("k", F.row_number().over(w.orderBy("instance_id"))).withColumn("n", F.count("*").over(w)).where("k <= 6")
    names = F.array_join(F.transform(F.slice(F.sort_array(F.collect_list(F.struct("k", "instance_id"))), 1, 5), lambda s: s["instance_id"]), ", ")
    return x.groupBy("repo").agg(F.concat(names, F.when(F.max("n") > 5, ", ...").otherwise("")).alias("evidence"))


@P.add("a20_verdict", f"""WITH {RUNS}, x AS (SELECT count(*) AS total, count(*) FILTER (WHERE test_exit_code = -1) AS minus_one, count(*) FILTER (WHERE test_exit_code = 1) AS exit_one, count(*) FILTER (WHERE test_exit_code = 0) AS zero FROM runs),
y AS (SELECT *, total - minus_one - exit_one - zero AS other, minus_one + exit_one AS failed FROM x), z AS (SELECT *, coalesce(minus_one * 100 // nullif(failed, 0), 0) AS minus_one_pct, coalesce(exit_one * 100 // nullif(failed, 0), 0) AS exit_one_pct FROM y)
SELECT *, CASE WHEN total = 0 THEN 'unavailable' WHEN failed = 0 AND other = 0 THEN 'no failures' WHEN failed = 0 THEN 'mixed' WHEN minus_one > exit_one AND minus_one_pct >= 50 THEN 'infrastructure' WHEN exit_one > minus_one AND exit_one_pct >= 50 THEN 'quality' ELSE 'mixed' END AS verdict FROM z""")
def a20(spark, d):
    return A.verdict(runs(spark, d), "test_exit_code")


@P.add("a22_dominant_source", f"""WITH {STEPS}, x AS (SELECT task_id, coalesce(source, 'none') AS source, count(*) AS n FROM steps GROUP BY 1, 2)
SELECT task_id, source AS dominant, n FROM x QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY n DESC, source) = 1""")
def a22(spark, d):
    x = steps(spark, d).groupBy("task_id", F.coalesce("source", F.lit("none")).alias("source")).agg(F.count("*").alias("n"))
    best = x.groupBy("task_id").agg(F.min_by(F.struct("source", "n"), F.struct((-F.col("n")).alias("m"), "source")).alias("b"))
    return best.select("task_id", F.col("b.source").alias("dominant"), F.col("b.n").alias("n"))


@P.add("a23_task_tiers", f"""WITH {STEPS}, x AS (SELECT task_id, count(DISTINCT action.filepath) AS files FROM steps GROUP BY 1), y AS (SELECT CASE WHEN files <= 1 THEN 'one' WHEN files <= 3 THEN 'few' WHEN files <= 8 THEN 'some' ELSE 'many' END AS tier, count(*) AS n FROM x GROUP BY 1)
SELECT tier, n, round(n / sum(n) OVER (), 6) AS share FROM y""")
def a23(spark, d):
    x = steps(spark, d).groupBy("task_id").agg(F.countDistinct("action.filepath").alias("files"))
    return A.shares(x.select(A.banded(F.col("files"), [("one", 1), ("few", 3), ("some", 8)], "many").alias("tier")), "tier")


@P.add("a24_generation_plan", f"""WITH {RUNS}, x AS (SELECT t.repo, t.instance_id, bool_or(r.resolved) AS done, bool_or(r.error IS NOT NULL) AS failed, count(r.result_id) AS k FROM bench_tasks t LEFT JOIN runs r ON t.instance_id = r.instance_id GROUP BY 1, 2),
y AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY instance_id) AS p FROM x)
SELECT repo, count(*) AS total, count(*) FILTER (WHERE done) AS done_n, count(*) FILTER (WHERE failed) AS failed_n, count(*) FILTER (WHERE k = 0) AS pending_n, string_agg(instance_id, ',' ORDER BY p) FILTER (WHERE p <= 5) AS first_ids FROM y GROUP BY 1""")
def a24(spark, d):
    t = table(spark, d, "bench_tasks").select("repo", "instance_id")
    r = runs(spark, d).groupBy("instance_id").agg(F.bool_or("resolved").alias("done"), F.bool_or(F.col("error").isNotNull()).alias("failed"), F.count("*").alias("k"))
    x = t.join(r, "instance_id", "left").withColumn("p", F.row_number().over(Window.partitionBy("repo").orderBy("instance_id")))
    first = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("p") <= 5, F.struct("p", "instance_id")))), lambda s: s["instance_id"]), ",")
    return x.groupBy("repo").agg(F.count("*").alias("total"), A.count_if(F.col("done")).alias("done_n"), A.count_if(F.col("failed")).alias("failed_n"), A.count_if(F.col("k").isNull()).alias("pending_n"), first.alias("first_ids"))


@P.add("a25_resolution_rate", f"WITH {RUNS} SELECT round(avg(CASE WHEN resolved THEN 1.0 WHEN resolved IS NOT NULL THEN 0.0 END), 6) AS resolution_rate FROM runs")
def a25(spark, d):
    return runs(spark, d).agg(F.round(F.avg(F.col("resolved").cast("double")), 6).alias("resolution_rate"))


@P.add("a21_rollup", f"""WITH {RUNS} SELECT repo, resolved, count(*) AS n, grouping(repo)::BIGINT AS g_repo, grouping(resolved)::BIGINT AS g_resolved FROM runs GROUP BY ROLLUP (repo, resolved)""")
def a21(spark, d):
    x = runs(spark, d).rollup("repo", "resolved").agg(F.count("*").alias("n"), F.grouping("repo").cast("long").alias("g_repo"), F.grouping("resolved").cast("long").alias("g_resolved"))
    return x


@P.add("w5_stratified_top", f"""WITH {RUNS} SELECT repo, result_id, duration_seconds, rank FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY duration_seconds DESC NULLS LAST, result_id) AS rank FROM runs) WHERE rank <= 3""")
def w5(spark, d):
    from millrace.operators.dedup import top_per_group

    x = top_per_group(runs(spark, d), ["repo"], [F.col("duration_seconds").desc_nulls_last(), F.col("result_id")], 3)
    return x.select("repo", "result_id", "duration_seconds", "rank")


@P.add("w7_running_score", f"""WITH {RUNS} SELECT result_id, run_id, count(*) OVER w AS seen, (sum(CASE WHEN resolved THEN 1 ELSE 0 END) OVER w)::BIGINT AS hits FROM runs WINDOW w AS (PARTITION BY run_id ORDER BY started_at, result_id ROWS UNBOUNDED PRECEDING)""")
def w7(spark, d):
    return A.running_rate(runs(spark, d), "run_id", [F.col("started_at"), F.col("result_id")], F.col("resolved")).select("result_id", "run_id", "seen", "hits")


@P.add("w8_call_growth", f"""WITH {RUNS} SELECT result_id, (lead(total_llm_calls) OVER (PARTITION BY run_id ORDER BY started_at, result_id) - total_llm_calls)::INTEGER AS growth FROM runs""")
def w8(spark, d):
    w = Window.partitionBy("run_id").orderBy("started_at", "result_id")
    return runs(spark, d).select("result_id", (F.lead("total_llm_calls").over(w) - F.col("total_llm_calls")).alias("growth"))


@P.add("l8_latest_rows", f"""WITH {RUNS} SELECT result_id, run_id, started_at FROM runs ORDER BY started_at DESC NULLS LAST, result_id DESC LIMIT 15""")
def l8(spark, d):
    return runs(spark, d).orderBy(F.col("started_at").desc_nulls_last(), F.col("result_id").desc()).limit(15).select("result_id", "run_id", "started_at")


@P.add("l6_index_slice", f"""WITH {RUNS} SELECT result_id, task_index FROM runs WHERE task_index >= 3 ORDER BY task_index, result_id LIMIT 50""")
def l6(spark, d):
    return runs(spark, d).where("task_index >= 3").orderBy("task_index", "result_id").limit(50).select("result_id", "task_index")


@P.add("k9_result_dump", f"""WITH {RUNS} SELECT row_number() OVER (ORDER BY task_index ASC NULLS LAST, result_id) AS line, result_id, task_index FROM runs""")
def k9(spark, d):
    """Rows in the order of the dump; the place comes from a range-partitioned sort, not from one task."""
    from millrace.operators.ordering import numbered

    return numbered(runs(spark, d).select("result_id", "task_index"), [F.col("task_index").asc_nulls_last(), F.col("result_id")], "line").select("line", "result_id", "task_index")


@P.add("j8_result_buckets", f"""WITH {RUNS}, s AS (SELECT task_id, count(*) AS k FROM translated_steps GROUP BY 1)
SELECT CASE WHEN s.k IS NULL THEN 'no_trace' WHEN coalesce(r.total_llm_calls, 0) = 0 THEN 'silent' ELSE 'ran' END AS bucket, count(*) AS n, round(median(r.duration_seconds), 6) AS median_seconds FROM runs r LEFT JOIN s ON r.instance_id = s.task_id GROUP BY 1""")
def j8(spark, d):
    s = table(spark, d, "translated_steps").groupBy(F.col("task_id").alias("instance_id")).agg(F.count("*").alias("k"))
    x = runs(spark, d).join(s, "instance_id", "left")
    b = F.when(F.col("k").isNull(), "no_trace").when(F.coalesce("total_llm_calls", F.lit(0)) == 0, "silent").otherwise("ran")
    return x.groupBy(b.alias("bucket")).agg(F.count("*").alias("n"), F.round(F.percentile("duration_seconds", F.lit(0.5)), 6).alias("median_seconds"))


@P.add("s1_latest_runs", f"WITH {RUNS} SELECT result_id, run_id, instance_id, repo, resolved, test_exit_code FROM runs")
def s1(spark, d):
    return latest(table(spark, d, "run_results"), "result_id", "recorded_at").select("result_id", "run_id", "instance_id", "repo", "resolved", "test_exit_code")


@P.add("stream_event_windows", """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def event_windows(spark, d):
    """Tumbling windows of a stream with a watermark, worked off into a table."""
    from millrace.streaming import jobs

    folder, checkpoint = shared_path(spark, "windows"), shared_path(spark, "windows-state")
    x = jobs.windowed(jobs.table_stream(spark, d, "events"), "ts", "1 hour", "1 hour")
    jobs.complete_available(x, folder, checkpoint)
    return spark.read.parquet(folder).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


@P.add("stream_sessions", """WITH x AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM events), y AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM x)
SELECT user_id, min(ts) AS started, count(*) AS n FROM y GROUP BY user_id, s""")
def event_sessions(spark, d):
    """Session windows of a stream, worked off into a table."""
    from millrace.streaming import jobs

    folder, checkpoint = shared_path(spark, "sessions"), shared_path(spark, "sessions-state")
    jobs.complete_available(jobs.sessions(jobs.table_stream(spark, d, "events"), "ts", "user_id", "30 minutes", "1 hour"), folder, checkpoint)
    return spark.read.parquet(folder).select("user_id", F.col("started").cast("timestamp_ntz").alias("started"), "n")
