"""Manifests compared, rules, generators and range overlaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import gates, joins
from millrace.plans.base import POINTS, RUNS, STEPS, Plans, points, runs, steps
from millrace.session import table

P = Plans()
# manifests: the digests of the last contents of each path, by source
MAN = f"{STEPS}, man AS (SELECT coalesce(source, 'none') AS source, action.filepath AS path, arg_max(md5(action.content), (step_index, step_id)) AS digest FROM steps WHERE action.action_type = 'write_file' AND action.content IS NOT NULL AND action.filepath IS NOT NULL GROUP BY 1, 2)"


def manifests(spark, d):
    """The manifests of both sources and of rows without one side by side, in one pass over the steps."""
    a = F.col("action")
    x = steps(spark, d).where((a.action_type == "write_file") & a.content.isNotNull() & a.filepath.isNotNull())
    last = F.struct("step_index", "step_id")
    aggs = []
    for name, source in (("c", "source_a"), ("a", "source_b"), ("e", "none")):
        own = F.coalesce("source", F.lit("none")) == source
        aggs += [F.max_by(F.when(own, F.md5(a.content)), F.when(own, last)).alias(name), F.max(F.when(own, True)).alias(f"in_{name}")]
    return x.groupBy(a.filepath.alias("path")).agg(*aggs)


def manifest(spark, d, source):
    a = F.col("action")
    x = steps(spark, d).where((F.coalesce("source", F.lit("none")) == source) & (a.action_type == "write_file") & a.content.isNotNull() & a.filepath.isNotNull())
    return x.groupBy(a.filepath.alias("path")).agg(F.max_by(F.md5(a.content), F.struct("step_index", "step_id")).alias("digest"))


@P.add("j7_drift", f"""WITH {MAN} SELECT coalesce(l.path, r.path) AS path, CASE WHEN r.path IS NULL THEN 'only_left' WHEN l.path IS NULL THEN 'only_right' WHEN l.digest = r.digest THEN 'same' ELSE 'differs' END AS status FROM (SELECT * FROM man WHERE source = 'source_a') l FULL JOIN (SELECT * FROM man WHERE source = 'source_b') r ON l.path = r.path""")
def j7(spark, d):
    return joins.compared(manifest(spark, d, "source_a"), manifest(spark, d, "source_b"), "path", "digest")


_J6 = """WITH {man}, c AS (SELECT path, digest FROM man WHERE source = 'source_a'), a AS (SELECT path, digest FROM man WHERE source = 'source_b'), e AS (SELECT path, digest FROM man WHERE source = 'none'),
k AS (SELECT path FROM c UNION SELECT path FROM a UNION SELECT path FROM e), x AS (SELECT k.path, c.path IS NOT NULL AS here, a.path IS NOT NULL AS ok, e.path IS NOT NULL AS exc, c.digest IS NOT DISTINCT FROM a.digest AS same_a, c.digest IS NOT DISTINCT FROM e.digest AS same_e FROM k LEFT JOIN c ON k.path = c.path LEFT JOIN a ON k.path = a.path LEFT JOIN e ON k.path = e.path)
SELECT path, verdict FROM (SELECT path, {case} AS verdict FROM x) WHERE verdict IS NOT NULL"""
_STRICT = "CASE WHEN NOT here AND ok THEN 'FAIL missing' WHEN here AND NOT ok AND exc THEN 'FAIL unpromoted' WHEN here AND NOT ok THEN 'FAIL unapproved' WHEN here AND exc THEN 'FAIL unpromoted' WHEN here AND NOT same_a THEN 'FAIL modified' WHEN here THEN 'PASS' END"
_LENIENT = "CASE WHEN exc AND NOT here THEN 'FAIL missing exception' WHEN exc AND NOT same_e THEN 'FAIL mismatch' WHEN exc THEN 'PASS' WHEN NOT here AND ok THEN 'FAIL missing' WHEN ok AND NOT same_a THEN 'FAIL modified' WHEN ok THEN 'PASS' ELSE 'FAIL unapproved' END"


@P.add("j6_manifest_strict", _J6.format(man=MAN, case=_STRICT))
def j6(spark, d):
    return joins.presence_verdicts(manifests(spark, d), "path", "strict")


@P.add("j6_manifest_lenient", _J6.format(man=MAN, case=_LENIENT))
def j6b(spark, d):
    return joins.presence_verdicts(manifests(spark, d), "path", "lenient")


@P.add("u1_key_union", f"WITH {MAN} SELECT DISTINCT path FROM man")
def u1(spark, d):
    x = manifest(spark, d, "source_a").select("path").union(manifest(spark, d, "source_b").select("path")).union(manifest(spark, d, "none").select("path"))
    return x.distinct()


@P.add("u2_set_difference", f"WITH {MAN} SELECT 'left' AS side, path FROM (SELECT path FROM man WHERE source = 'source_a' EXCEPT SELECT path FROM man WHERE source = 'source_b') UNION ALL SELECT 'both', path FROM (SELECT path FROM man WHERE source = 'source_a' INTERSECT SELECT path FROM man WHERE source = 'source_b')")
def u2(spark, d):
    a, b = manifest(spark, d, "source_a").select("path"), manifest(spark, d, "source_b").select("path")
    return a.subtract(b).select(F.lit("left").alias("side"), "path").unionByName(a.intersect(b).select(F.lit("both").alias("side"), "path"))


@P.add("j15_missing_scripts", f"""WITH {STEPS} SELECT DISTINCT action.skill_name AS skill FROM steps WHERE action.skill_name IS NOT NULL AND action.skill_name NOT IN (SELECT action.skill_name FROM steps WHERE action.file_path IN ('grep.py', 'map.py') AND action.skill_name IS NOT NULL)""")
def j15(spark, d):
    s = steps(spark, d).select(F.col("action.skill_name").alias("skill"), F.col("action.file_path").alias("f")).where("skill is not null")
    return joins.exclude(s.select("skill").distinct(), "skill", s.where(F.col("f").isin("grep.py", "map.py")), "skill")


@P.add("s11_combinations", f"""WITH {POINTS}, c AS (SELECT DISTINCT trim(source, ' ') AS book FROM points WHERE trim(source, ' ') <> ''), k AS (SELECT DISTINCT kind FROM eval_items), l AS (SELECT DISTINCT lang FROM eval_items WHERE lang IS NOT NULL)
SELECT row_number() OVER (ORDER BY book, kind, lang) AS index, book, kind, lang FROM c, k, l""")
def s11(spark, d):
    """Numbered combinations of small sets; their sizes are checked before the product."""
    from millrace.operators.ordering import numbered
    from millrace.sources.generators import combinations

    e = table(spark, d, "eval_items")
    sets = [points(spark, d).select(F.trim("source").alias("book")).where("book <> ''").distinct(), e.select("kind").distinct(), e.select("lang").where("lang is not null").distinct()]
    return numbered(combinations(sets), [F.col("book"), F.col("kind"), F.col("lang")], "index").select("index", "book", "kind", "lang")


@P.add("gate_overlaps", f"""WITH {RUNS}, r AS (SELECT run_id, min(task_index) AS lo, max(task_index) AS hi FROM runs WHERE task_index IS NOT NULL GROUP BY 1) SELECT x.run_id AS a, y.run_id AS b FROM r x JOIN r y ON x.run_id < y.run_id AND x.lo <= y.hi AND y.lo <= x.hi""")
def gate_overlaps(spark, d):
    r = runs(spark, d).where("task_index is not null").groupBy("run_id").agg(F.min("task_index").alias("lo"), F.max("task_index").alias("hi"))
    return gates.overlapping(r, "run_id", "lo", "hi")


@P.add("gate_results", f"""WITH {RUNS}, {STEPS}, r AS (SELECT 'known_tasks' AS name, 'submission' AS category, (SELECT count(DISTINCT instance_id) FROM runs WHERE instance_id NOT IN (SELECT instance_id FROM bench_tasks)) AS n, false AS w
UNION ALL SELECT 'no_held_out_steps', 'training', (SELECT count(DISTINCT task_id) FROM steps WHERE task_id IN (SELECT instance_id FROM bench_tasks)), false UNION ALL SELECT 'long_lines', 'docs', (SELECT count(*) FROM documents WHERE len(list_filter(string_split(text, chr(10)), lambda l: length(l) > 5000)) > 0), true)
SELECT name, category, CASE WHEN n = 0 THEN 'PASS' WHEN w THEN 'WARN' ELSE 'FAIL' END AS status, n || ' offenders' AS message FROM r""")
def gate_results(spark, d):
    b = table(spark, d, "bench_tasks")
    long = F.exists(F.split("text", "\n"), lambda x: F.length(x) > 5000)
    rules = [
        gates.Rule("known_tasks", "submission", lambda: joins.exclude(runs(spark, d).where("instance_id is not null").select("instance_id").distinct(), "instance_id", b, "instance_id").withColumnRenamed("instance_id", "offender"), needs_rows=lambda: b),
        gates.Rule("no_held_out_steps", "training", lambda: joins.keep_only(steps(spark, d), "task_id", b, "instance_id").select(F.col("task_id").alias("offender")).distinct()),
        gates.Rule("long_lines", "docs", lambda: table(spark, d, "documents").where(long).select(F.col("doc_id").alias("offender")), warn_only=True),
    ]
    return gates.run_rules(spark, rules).select("name", "category", "status", "message")


@P.add("s13_tree_digests")
def s13(spark, d):
    """Path and SHA-256 of every file of the data folder."""
    from millrace.sources.files import tree_digests

    return tree_digests(spark, d)


@P.add("a26_exact_duplicates", "SELECT md5(text) AS digest, count(*) AS copies, min(doc_id) AS kept FROM documents WHERE text IS NOT NULL AND text <> '' GROUP BY 1 HAVING count(*) > 1")
def a26(spark, d):
    x = table(spark, d, "documents").where("text is not null and text <> ''").groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("kept"))
    return x.where("copies > 1")


@P.add("tpch_q1", """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def q1(spark, d):
    x = table(spark, d, "lineitem").where(F.col("l_shipdate") <= F.expr("TIMESTAMP_NTZ '1998-09-02 00:00:00'"))
    return x.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.count("*").alias("n"))


@P.add("tpch_revenue_by_nation", """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(DISTINCT o_orderkey) AS order_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def q5(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations at every scale
    line = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    x = line.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return x.groupBy("n_name").agg(F.round(F.sum("r"), 2).alias("revenue"), F.count("o_orderkey").alias("order_count"))
