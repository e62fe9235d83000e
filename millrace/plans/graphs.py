"""Graphs of files, vectors, search and diffs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import joins, patches, search
from millrace.operators.vectors import nearest
from millrace.plans.base import RUNS, STEPS, Plans, runs, steps
from millrace.session import table

P = Plans()
# the graph: files that a task touches one after the other
EDGES = f"""{STEPS}, touched AS (SELECT task_id, step_index, step_id, coalesce(action.filepath, action.file_path) AS f FROM steps WHERE coalesce(action.filepath, action.file_path) IS NOT NULL),
edges AS (SELECT DISTINCT f AS src, g AS dst FROM (SELECT f, lead(f) OVER (PARTITION BY task_id ORDER BY step_index, step_id) AS g FROM touched) WHERE g IS NOT NULL AND g <> f)"""


def edges(spark, d):
    f = F.coalesce(F.col("action.filepath"), F.col("action.file_path"))
    x = steps(spark, d).where(f.isNotNull()).select("task_id", "step_index", "step_id", f.alias("src"))
    x = x.withColumn("dst", F.lead("src").over(Window.partitionBy("task_id").orderBy("step_index", "step_id")))
    return x.where("dst is not null and dst <> src").select("src", "dst").distinct()


@P.add("s16_edges", f"WITH {EDGES} SELECT src, dst FROM edges")
def s16(spark, d):
    return edges(spark, d)


@P.add("j13_degrees", f"WITH {EDGES}, x AS (SELECT src AS node, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, 0, 1 FROM edges) SELECT node, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree FROM x GROUP BY 1")
def j13(spark, d):
    n = joins.neighbours(edges(spark, d), "src", "dst")
    return n.groupBy("node").agg(F.sum((F.col("direction") == "out").cast("long")).alias("out_degree"), F.sum((F.col("direction") == "in").cast("long")).alias("in_degree"))


@P.add("j12_folder_neighbours", f"""WITH {EDGES}, x AS (SELECT split_part(src, '/', 1) AS a, split_part(dst, '/', 1) AS b FROM edges) SELECT a AS folder, b AS neighbour, count(*) AS links FROM x GROUP BY 1, 2""")
def j12(spark, d):
    x = edges(spark, d).select(F.element_at(F.split("src", "/"), 1).alias("folder"), F.element_at(F.split("dst", "/"), 1).alias("neighbour"))
    return x.groupBy("folder", "neighbour").agg(F.count("*").alias("links"))


@P.add("j14_induced_subgraph", f"WITH {EDGES}, t AS (SELECT f FROM touched GROUP BY f HAVING count(DISTINCT task_id) >= 2) SELECT src, dst FROM edges WHERE src IN (SELECT f FROM t) AND dst IN (SELECT f FROM t)")
def j14(spark, d):
    f = F.coalesce(F.col("action.filepath"), F.col("action.file_path"))
    shared = steps(spark, d).where(f.isNotNull()).groupBy(f.alias("f")).agg(F.countDistinct("task_id").alias("k")).where("k >= 2")
    return joins.induced(edges(spark, d), "src", "dst", shared, "f")


@P.add("j12_two_hops", f"""WITH {EDGES}, s AS (SELECT DISTINCT src AS node FROM edges WHERE src LIKE '%.py' AND split_part(src, '/', 1) = 'core'), a AS (SELECT DISTINCT dst AS node FROM edges WHERE src IN (SELECT node FROM s) AND dst NOT IN (SELECT node FROM s)),
b AS (SELECT DISTINCT dst AS node FROM edges WHERE src IN (SELECT node FROM a) AND dst NOT IN (SELECT node FROM s) AND dst NOT IN (SELECT node FROM a)) SELECT node, 0 AS distance FROM s UNION ALL SELECT node, 1 FROM a UNION ALL SELECT node, 2 FROM b""")
def j12b(spark, d):
    e = edges(spark, d)
    seeds = e.where(F.col("src").endswith(".py") & (F.element_at(F.split("src", "/"), 1) == "core")).select(F.col("src").alias("node"))
    return joins.reachable(e, "src", "dst", seeds, "node", 2)


@P.add("j11_tiered_lookup", f"""WITH {STEPS}, q AS (SELECT DISTINCT action.args[2] AS q FROM steps WHERE action.args[1] = '--file'), n AS (SELECT DISTINCT coalesce(action.filepath, '') AS p, regexp_extract(action.filepath, '([^/]+)\\.[a-z]+$', 1) AS leaf FROM steps WHERE action.filepath IS NOT NULL),
h AS (SELECT q, p, 1 AS tier FROM q JOIN n ON q = p UNION ALL SELECT q, p, 2 FROM q JOIN n ON q = leaf UNION ALL SELECT q, p, 3 FROM q JOIN n ON lower(q) = lower(leaf)), b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY q ORDER BY tier, p) = 1)
SELECT q.q AS query, b.p AS path, b.tier AS tier FROM q LEFT JOIN b ON q.q = b.q WHERE q.q IS NOT NULL""")
def j11(spark, d):
    s = steps(spark, d)
    q = s.where(F.get("action.args", F.lit(0)) == "--file").select(F.get("action.args", F.lit(1)).alias("query")).where("query is not null").distinct()
    n = s.select(F.col("action.filepath").alias("path")).where("path is not null").distinct().withColumn("leaf", F.regexp_extract("path", r"([^/]+)\.[a-z]+$", 1))
    tiers = [n.select(F.col("path").alias("query"), "path"), n.select(F.col("leaf").alias("query"), "path")]
    low = q.withColumn("l", F.lower("query")).join(n.select(F.lower("leaf").alias("l"), "path"), "l").select("query", "path")
    return joins.first_tier(q, "query", [*[t.join(q, "query", "left_semi") for t in tiers], low], "path").select("query", "path", "tier")


@P.add("v1_nearest_vectors", """WITH q AS (SELECT vec_id, embedding AS v FROM embeddings WHERE vec_id % 100 = 0), x AS (SELECT q.vec_id AS query_id, e.vec_id AS id, round(list_cosine_similarity(q.v::DOUBLE[], e.embedding::DOUBLE[]), 9) AS cosine FROM q, embeddings e WHERE q.vec_id <> e.vec_id)
SELECT query_id, id, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) AS rank FROM x) WHERE rank <= 10""")
def v1(spark, d):
    e = table(spark, d, "embeddings")
    return nearest(e, e.where(F.col("vec_id") % 100 == 0), "vec_id", "embedding", 10).select("query_id", "id", "rank")


@P.add("m6_cosine_to_label_mean", """WITH x AS (SELECT label, list(embedding ORDER BY vec_id)[1] AS a, list(embedding ORDER BY vec_id)[-1] AS b FROM embeddings GROUP BY 1) SELECT label, round(list_cosine_similarity(a::DOUBLE[], b::DOUBLE[]), 6) AS cosine FROM x""")
def m6(spark, d):
    """Cosine of the first and the last vector of each label, as a plain expression."""
    from millrace.functions.structured import cosine

    x = table(spark, d, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("a"), F.max_by("embedding", "vec_id").alias("b"))
    return x.select("label", F.round(cosine(F.col("a"), F.col("b")), 6).alias("cosine"))


def files(spark, d):
    a = F.col("action")
    return steps(spark, d).where((a.action_type == "write_file") & a.content.isNotNull()).select(F.col("step_id").alias("file_id"), a.filepath.alias("path"), a.content.alias("text"))


@P.add("c1_regex_search", rf"""WITH {STEPS}, x AS (SELECT step_id AS file_id, unnest(string_split(action.content, chr(10))) AS line, generate_subscripts(string_split(action.content, chr(10)), 1) AS line_no FROM steps WHERE action.action_type = 'write_file' AND action.content IS NOT NULL)
SELECT file_id, line_no, md5(line) AS digest FROM x WHERE regexp_matches(line, '^\s*raise \w+Error\(')""")
def c1(spark, d):
    return search.matching_lines(files(spark, d), r"^\s*raise \w+Error\(").select("file_id", "line_no", F.md5("line").alias("digest"))


@P.add("c2_guarded_search", f"""WITH {STEPS}, x AS (SELECT step_id AS file_id, unnest(string_split(action.content, chr(10))) AS line, generate_subscripts(string_split(action.content, chr(10)), 1) AS line_no FROM steps WHERE action.action_type = 'write_file' AND length(action.content) <= 500000)
SELECT file_id, count(*) AS hits FROM x WHERE contains(line, 'return') AND length(line) <= 1000 AND line_no <= 5000 GROUP BY 1""")
def c2(spark, d):
    return search.lines(files(spark, d), guarded=True).where(F.col("line").contains("return")).groupBy("file_id").agg(F.count("*").alias("hits"))


_WORDS = """w AS (SELECT step_id AS file_id, string_split(action.content, chr(10)) AS l FROM steps WHERE action.action_type = 'write_file' AND action.content IS NOT NULL), v AS (SELECT file_id, unnest(l) AS line, generate_subscripts(l, 1) AS line_no FROM w),
i AS (SELECT file_id, line_no, unnest(regexp_extract_all(line, '([A-Za-z_][A-Za-z0-9_]*)', 1)) AS name FROM v), names AS (SELECT name, count(*) AS hits, min((file_id, line_no)) AS spot FROM i GROUP BY 1)"""


@P.add("c3_search_cascade", f"""WITH {STEPS}, {_WORDS}, asked AS (SELECT DISTINCT action.args[-1] AS term FROM steps WHERE action.skill_name = 'fast-grep' AND action.args[-1] <> ''),
p AS (SELECT name, hits, spot, unnest(list_distinct(list_filter(string_split(lower(name), '_'), lambda x: length(x) >= 3))) AS part FROM names), q AS (SELECT term, unnest(list_distinct(list_filter(string_split(lower(term), '_'), lambda x: length(x) >= 3))) AS part FROM asked),
f AS (SELECT term, 1 AS t, name, hits, spot FROM asked JOIN names ON term = name UNION ALL SELECT term, 2, name, hits, spot FROM asked JOIN names ON lower(term) = lower(name) UNION ALL SELECT DISTINCT term, 3, name, hits, spot FROM q JOIN p ON q.part = p.part),
g AS (SELECT term, t, sum(hits)::BIGINT AS hits, min(spot) AS spot FROM f GROUP BY 1, 2), b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY term ORDER BY t) = 1)
SELECT a.term, CASE b.t WHEN 1 THEN 'exact' WHEN 2 THEN 'any case' WHEN 3 THEN 'part' ELSE 'none' END AS tier, coalesce(b.hits, 0) AS hits, b.spot.element_1 AS file_id, b.spot.element_2 AS line_no FROM asked a LEFT JOIN b ON a.term = b.term""".replace("min((file_id, line_no))", "min({'element_1': file_id, 'element_2': line_no})"))
def c3(spark, d):
    """What the searches of all tasks would find in all written files."""
    a = F.col("action")
    terms = steps(spark, d).where(a.skill_name == "fast-grep").select(F.element_at(a.args, -1).alias("term"))
    written = steps(spark, d).where((a.action_type == "write_file") & a.content.isNotNull()).select(F.col("step_id").alias("file_id"), a.filepath.alias("path"), a.content.alias("text"))
    return search.cascade(written, terms)


@P.add("c5_similar_file_names", f"""WITH {STEPS}, p AS (SELECT DISTINCT repo, action.action_type AS kind, action.filepath AS path, lower(regexp_extract(action.filepath, '([^/]+?)(?:\\.[A-Za-z0-9]+)?$', 1)) AS s FROM steps WHERE action.filepath IS NOT NULL AND repo IS NOT NULL),
a AS (SELECT DISTINCT repo, path AS asked, s FROM p WHERE kind = 'read_file' AND s <> ''), f AS (SELECT DISTINCT repo, path, s AS z FROM p WHERE kind = 'write_file' AND s <> ''),
ak AS (SELECT *, unnest(list_distinct(list_filter(string_split(s, '_'), lambda x: length(x) >= 3))) AS k FROM a), fk AS (SELECT *, unnest(list_distinct(list_filter(string_split(z, '_'), lambda x: length(x) >= 3))) AS k FROM f),
x AS (SELECT a.repo, asked, path, s, z, 1 AS t FROM a JOIN f ON a.repo = f.repo AND s = z
  UNION ALL SELECT ak.repo, asked, path, s, z, 2 FROM ak JOIN fk ON ak.repo = fk.repo AND ak.k = fk.k AND (contains(s, z) OR contains(z, s))
  UNION ALL SELECT a.repo, asked, path, s, z, 3 FROM a JOIN f ON a.repo = f.repo AND (left(s, 3) = left(z, 3) OR right(s, 3) = right(z, 3)) AND levenshtein(s, z) <= 0.5 * greatest(length(s), length(z))),
y AS (SELECT repo, asked, path, s, z, min(t) AS t FROM x WHERE asked <> path GROUP BY 1, 2, 3, 4, 5), r AS (SELECT *, row_number() OVER (PARTITION BY repo, asked ORDER BY t, levenshtein(s, z), path) AS rank FROM y)
SELECT repo, asked, ['stem', 'part', 'close'][t] AS tier, path, rank FROM r WHERE rank <= 5""")
def c5(spark, d):
    """For every file that a step reads, the written files of its repository with names like it."""
    a = F.col("action")
    x = steps(spark, d).select("repo", a.action_type.alias("kind"), a.filepath.alias("path")).where("path is not null and repo is not null")
    return search.similar_files(x.where("kind = 'read_file'"), x.where("kind = 'write_file'"), "repo")


@P.add("c9_overview", f"""WITH {STEPS}, p AS (SELECT DISTINCT repo, action.filepath AS path FROM steps WHERE action.filepath IS NOT NULL) SELECT repo, split_part(path, '/', 1) AS folder, count(*) AS files, count(*) FILTER (WHERE ends_with(path, '.py')) AS python_files FROM p GROUP BY 1, 2""")
def c9(spark, d):
    p = steps(spark, d).select("repo", F.col("action.filepath").alias("path")).where("path is not null").distinct()
    return p.groupBy("repo", F.element_at(F.split("path", "/"), 1).alias("folder")).agg(F.count("*").alias("files"), F.sum(F.col("path").endswith(".py").cast("long")).alias("python_files"))


@P.add("l9_layout", f"""WITH {STEPS}, p AS (SELECT DISTINCT split_part(action.filepath, '/', 1) AS name, contains(action.filepath, '/') AS is_dir FROM steps WHERE action.filepath IS NOT NULL), q AS (SELECT name, bool_or(is_dir) AS is_dir FROM p GROUP BY 1) SELECT name, is_dir, row_number() OVER (ORDER BY NOT is_dir, lower(name), name) AS place FROM q""")
def l9(spark, d):
    from millrace.operators.ordering import numbered

    p = steps(spark, d).select(F.col("action.filepath").alias("p")).where("p is not null")
    q = p.groupBy(F.element_at(F.split("p", "/"), 1).alias("name")).agg(F.bool_or(F.col("p").contains("/")).alias("is_dir"))
    return numbered(q, [~F.col("is_dir"), F.lower("name"), F.col("name")], "place").select("name", "is_dir", "place")


@P.add("j10_enclosing_scope")
def j10(spark, d):
    """Calls with the innermost definition around them, over all Python files."""
    from millrace.functions.arrow import python_symbols

    x = python_symbols(files(spark, d).where(F.col("path").endswith(".py")), "file_id", "text")
    calls = x.where("kind = 'call'").select("file_id", "line", "name").distinct()
    spans = x.where("kind in ('function', 'class')").select("file_id", "line", "last_line", F.col("name").alias("scope")).withColumnRenamed("line", "first_line")
    return joins.innermost(calls, spans, ["file_id"], ["name"], "line", "first_line", "last_line", "scope").select("file_id", "name", "line", "scope")


@P.add("c6_scopes_per_file")
def c6(spark, d):
    """The two scopes of each file with most calls."""
    from millrace.operators.dedup import top_per_group

    x = j10(spark, d).where("scope is not null").groupBy("file_id", "scope").agg(F.count("*").alias("calls"))
    return top_per_group(x, ["file_id"], [F.desc("calls"), F.col("scope")], 2)


@P.add("a17_diff_stats", r"""WITH s AS (SELECT instance_id, unnest(string_split(chr(10) || patch, chr(10) || 'diff --git ')) AS s FROM bench_tasks WHERE patch IS NOT NULL), x AS (SELECT instance_id, regexp_extract(s, '^a/(\S+)', 1) AS path, string_split(s, chr(10)) AS l FROM s WHERE s <> '')
SELECT instance_id, path, len(list_filter(l, lambda x: starts_with(x, '+') AND NOT starts_with(x, '+++ ')))::BIGINT AS added, len(list_filter(l, lambda x: starts_with(x, '-') AND NOT starts_with(x, '--- ')))::BIGINT AS removed, CASE WHEN list_contains(l, '--- /dev/null') THEN 'A' WHEN list_contains(l, '+++ /dev/null') THEN 'D' ELSE 'M' END AS status FROM x WHERE path <> ''""")
def a17(spark, d):
    return patches.file_stats(table(spark, d, "bench_tasks"), "instance_id", "patch")


@P.add("pred5_single_python_patch", r"""WITH s AS (SELECT instance_id, unnest(string_split(patch, chr(10))) AS l FROM bench_tasks), f AS (SELECT DISTINCT instance_id, regexp_replace(regexp_extract(l, '^(?:---|\+\+\+) (\S+)', 1), '^[ab]/', '') AS p FROM s WHERE regexp_matches(l, '^(---|\+\+\+) ')),
g AS (SELECT instance_id, count(*) AS files, min(p) AS p FROM f WHERE p <> '/dev/null' AND p <> '' GROUP BY 1) SELECT b.instance_id, coalesce(g.files = 1 AND ends_with(g.p, '.py'), false) AS single_python FROM bench_tasks b LEFT JOIN g ON b.instance_id = g.instance_id""")
def p5(spark, d):
    return table(spark, d, "bench_tasks").select("instance_id", X.is_single_python_patch(F.col("patch")).alias("single_python"))


@P.add("c12_patch_states", r"""WITH d AS (SELECT instance_id || ':patch' AS id, patch AS diff FROM bench_tasks UNION ALL SELECT instance_id || ':tests', test_patch FROM bench_tasks UNION ALL SELECT instance_id || ':both', patch || test_patch FROM bench_tasks UNION ALL SELECT instance_id || ':none', '' FROM bench_tasks),
s AS (SELECT id, unnest(string_split(diff, chr(10))) AS l FROM d), f AS (SELECT DISTINCT id, regexp_replace(regexp_extract(l, '^(?:---|\+\+\+) (\S+)', 1), '^[ab]/', '') AS p FROM s WHERE regexp_matches(l, '^(---|\+\+\+) ')),
g AS (SELECT id, count(*) AS files, bool_and(ends_with(p, '.py')) AS python, count(*) FILTER (WHERE regexp_matches(lower(p), '(^|/)(tests|test|testing)(/|$)') OR starts_with(split_part(lower(p), '/', -1), 'test_') OR ends_with(lower(p), '_test.py')) AS tests FROM f WHERE p <> '/dev/null' AND p <> '' GROUP BY 1)
SELECT d.id, coalesce(files, 0) AS files, coalesce(files = 1 AND python, false) AS single_python, coalesce(tests, 0) > 0 AS touches_tests, CASE WHEN coalesce(files, 0) = 0 THEN 'empty' WHEN tests = files THEN 'tests_only' WHEN files > 1 THEN 'wide' ELSE 'ready' END AS state FROM d LEFT JOIN g ON d.id = g.id""")
def c12(spark, d):
    """Each task's patch, its tests, both together and none, so that every state occurs."""
    b = table(spark, d, "bench_tasks")
    one = lambda name, diff: b.select(F.concat("instance_id", F.lit(":" + name)).alias("id"), diff.alias("diff"))
    x = one("patch", F.col("patch")).unionByName(one("tests", F.col("test_patch"))).unionByName(one("both", F.concat("patch", "test_patch"))).unionByName(one("none", F.lit("")))
    return patches.readiness(x, "id", "diff")


@P.add("j16_run_status", f"""WITH {RUNS}, s AS (SELECT instance_id, max(test_exit_code) AS code FROM runs GROUP BY 1) SELECT b.instance_id, coalesce(s.code::VARCHAR, 'M') AS code FROM bench_tasks b LEFT JOIN s ON b.instance_id = s.instance_id""")
def j16(spark, d):
    s = runs(spark, d).groupBy("instance_id").agg(F.max("test_exit_code").alias("code"))
    return table(spark, d, "bench_tasks").join(s, "instance_id", "left").select("instance_id", F.coalesce(F.col("code").cast("string"), F.lit("M")).alias("code"))


def _edits(spark, d, exact=False):
    """Edits with texts to apply them to, made from the edits: the old text stands there as it is, with other white space,
    with other white space around its delimiters, twice, or not at all."""
    a = F.col("action")
    old = a.old_string
    odd = F.lit(0) if exact else F.pmod("step_id", F.lit(5))
    wide, loose = F.regexp_replace(old, r"\s+", "  \n "), F.regexp_replace(old, r"([^\w\s])", " $1 ")
    body = F.when(odd == 0, old).when(odd == 1, wide).when(odd == 2, loose).when(odd == 3, F.concat(old, F.lit("\n"), old)).otherwise(F.lit("nothing"))
    x = steps(spark, d).where((a.action_type == "edit_file") & (F.trim(F.coalesce(old, F.lit(""))) != ""))
    return x.select("step_id", old.alias("old"), a.new_string.alias("new"), F.concat(F.lit("begin\n"), body, F.lit("\nend")).alias("before"))


@P.add("e3_three_tier_edits")
def e3(spark, d):
    """Each edit with the tier or the reason that decided, and the text it leaves."""
    return search.edited(_edits(spark, d), "before", "old", "new").select("step_id", "tier", F.md5("edited").alias("edited"))


@P.add("e3_exact_edits", f"""WITH {STEPS}, x AS (SELECT step_id, action.old_string AS old, coalesce(action.new_string, '') AS new, 'begin' || chr(10) || action.old_string || chr(10) || 'end' AS before FROM steps WHERE action.action_type = 'edit_file' AND trim(coalesce(action.old_string, '')) <> ''),
n AS (SELECT *, len(string_split(before, old)) - 1 AS times FROM x) SELECT step_id, CASE WHEN times = 1 THEN 'exact' ELSE 'ambiguous' END AS tier, CASE WHEN times = 1 THEN md5(replace(before, old, new)) END AS edited FROM n""")
def e3_exact(spark, d):
    """All edits, applied to texts where the old text stands as it is."""
    return search.edited(_edits(spark, d, exact=True), "before", "old", "new").select("step_id", "tier", F.md5("edited").alias("edited"))
