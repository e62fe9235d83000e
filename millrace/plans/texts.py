"""Text, path, JSON and array functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import structured as S
from millrace.functions import text as X
from millrace.functions.signals import BUFFER_NAMES, STRING_VERBS
from millrace.plans.base import POINTS, STEPS, Plans, points, steps
from millrace.session import table

P = Plans()


@P.add("t2_bare_paths", f"""WITH {STEPS}, x AS (SELECT DISTINCT action.filepath AS path FROM steps WHERE action.filepath IS NOT NULL) SELECT path, trim(regexp_replace(regexp_replace(trim(path), '^(/testbed/)?(testbed/)?', ''), '^(/workspace/)?(workspace/)?', ''), '/') AS bare FROM x""")
def t2(spark, d):
    x = steps(spark, d).select(F.col("action.filepath").alias("path")).where("path is not null").distinct()
    return x.select("path", X.bare_path(F.col("path")).alias("bare"))


@P.add("t3_sanitized", r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '/testbed/?', '/workspace/', 'g'), '/workspace/[^/]+__[^/]+/', '/workspace/', 'g'), '/(?:private/)?var/folders/[^\s"''\\]+', '/tmp', 'g'), ' ')) AS digest FROM documents""")
def t3(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.sanitized(F.col("text"))).alias("digest"))


@P.add("t4_compacted", """SELECT doc_id, md5(CASE WHEN length(text) <= 800 THEN text ELSE left(text, 380) || chr(10) || '... [truncated] ...' || chr(10) || right(text, 380) END) AS digest FROM documents""")
def t4(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.compacted(F.col("text"))).alias("digest"))


@P.add("t5_ansi_stripped", r"""SELECT doc_id, length(regexp_replace(text, '\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])', '', 'g')) AS chars FROM documents""")
def t5(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length(X.without_ansi(F.col("text"))).cast("long").alias("chars"))


@P.add("t6_without_fences", r"""SELECT doc_id, md5(trim(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT starts_with(ltrim(x, ' '), '```')), chr(10)), ' ')) AS digest FROM documents""")
def t6(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.without_fences(F.col("text"))).alias("digest"))


@P.add("t8_latin_first", rf"""WITH {POINTS} SELECT point_id, regexp_replace(trim(source, ' '), '^\(?([\x{{4e00}}-\x{{9fff}}]+)\)?\s*\(([A-Za-z][A-Za-z ]*)\)', '\2 (\1)') AS source FROM points""")
def t8(spark, d):
    return points(spark, d).select("point_id", X.latin_first(F.col("source")).alias("source"))


@P.add("t9_json_block", """SELECT line_no, file_name, CASE WHEN instr(trim(raw), '{') > 0 AND instr(reverse(trim(raw)), '}') > 0 AND length(trim(raw)) - instr(reverse(trim(raw)), '}') + 1 > instr(trim(raw), '{') THEN md5(substring(trim(raw), instr(trim(raw), '{'), length(trim(raw)) - instr(reverse(trim(raw)), '}') + 2 - instr(trim(raw), '{'))) ELSE md5(trim(raw)) END AS digest FROM rag_exports""")
def t9(spark, d):
    return table(spark, d, "rag_exports").select("line_no", "file_name", F.md5(X.json_block(F.col("raw"))).alias("digest"))


@P.add("t10_terms", """SELECT instance_id, array_to_string(list_distinct_ordered, ',') AS terms FROM (SELECT instance_id, list_filter(u, lambda w, i: list_position(u, w) = i) AS list_distinct_ordered FROM (SELECT instance_id, list_filter(regexp_extract_all(problem_statement, '[A-Za-z_][A-Za-z0-9_]*'), lambda w: length(w) >= 3 AND lower(w) NOT IN ('the', 'and', 'for', 'with', 'when', 'from', 'that', 'this')) AS u FROM bench_tasks))""")
def t10(spark, d):
    t = X.terms(F.col("problem_statement"), ["the", "and", "for", "with", "when", "from", "that", "this"])
    return table(spark, d, "bench_tasks").select("instance_id", F.array_join(t, ",").alias("terms"))


@P.add("t13_first_difference", f"""WITH {STEPS}, x AS (SELECT step_id, action.old_string AS a, action.new_string AS b FROM steps WHERE action.old_string IS NOT NULL AND action.new_string IS NOT NULL)
SELECT step_id, CASE WHEN a = b THEN NULL ELSE coalesce(list_position(list_transform(range(1, least(length(a), length(b)) + 1), lambda i: a[i] = b[i]), false) - 1, least(length(a), length(b)))::BIGINT END AS at FROM x""")
def t13(spark, d):
    a, b = F.col("action.old_string"), F.col("action.new_string")
    return steps(spark, d).where(a.isNotNull() & b.isNotNull()).select("step_id", X.first_difference(a, b).alias("at"))


@P.add("t14_difference_kinds", rf"""WITH {STEPS}, x AS (SELECT action.old_string AS a, action.new_string AS b FROM steps WHERE action.old_string IS NOT NULL AND action.new_string IS NOT NULL)
SELECT coalesce(CASE WHEN a = b THEN NULL WHEN (a = '' AND b IN (chr(10), chr(13) || chr(10))) OR (b = '' AND a IN (chr(10), chr(13) || chr(10))) THEN 'boundary' WHEN regexp_replace(a, '\s+$', '') = regexp_replace(b, '\s+$', '') THEN 'trailing'
 WHEN length(a) - length(replace(a, chr(10), '')) <> length(b) - length(replace(b, chr(10), '')) THEN 'lines' ELSE 'other' END, 'equal') AS kind, count(*) AS n FROM x GROUP BY 1""")
def t14(spark, d):
    a, b = F.col("action.old_string"), F.col("action.new_string")
    k = F.coalesce(X.difference_kind(a, b), F.lit("equal"))
    return steps(spark, d).where(a.isNotNull() & b.isNotNull()).groupBy(k.alias("kind")).agg(F.count("*").alias("n"))


@P.add("t17_hex_head", "SELECT doc_id, hex(encode(left(text, 16))) AS head FROM documents")
def t17(spark, d):
    return table(spark, d, "documents").select("doc_id", F.hex(F.encode(F.left("text", F.lit(16)), "UTF-8")).alias("head"))


@P.add("t17_hex_rows")
def t17_rows(spark, d):
    """The whole dump in rows of 16 bytes; ``t17_hex_head`` shows the first 16 characters."""
    return table(spark, d, "documents").select("doc_id", F.inline(X.hex_rows(F.col("text"))))


@P.add("t20_lengths", "SELECT doc_id, length(text) AS points, strlen(text)::BIGINT AS bytes, (length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))::BIGINT AS units FROM documents")
def t20(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.length(t).cast("long").alias("points"), F.octet_length(t).cast("long").alias("bytes"), X.utf16_units(t).alias("units"))


@P.add("t21_package_names", "SELECT DISTINCT lower(regexp_replace(split_part(repo, '/', 2), '[-_.]+', '-', 'g')) AS package FROM bench_tasks WHERE repo IS NOT NULL")
def t21(spark, d):
    return table(spark, d, "bench_tasks").where("repo is not null").select(X.package_name(F.element_at(F.split("repo", "/"), 2)).alias("package")).distinct()


@P.add("t23_line_search", """WITH x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents) SELECT doc_id, line_no, CASE WHEN length(line) > 140 THEN left(line, 137) || '...' ELSE line END AS line FROM x WHERE contains(lower(line), 'lookup')""")
def t23(spark, d):
    x = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")).where(F.lower("line").contains("lookup"))
    return x.select("doc_id", (F.col("i") + 1).cast("long").alias("line_no"), X.clipped(F.col("line"), 140).alias("line"))


@P.add("t24_bare_ampersands", """SELECT doc_id, (len(regexp_extract_all(text, '&')) - len(regexp_extract_all(text, '&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);')))::BIGINT AS n FROM documents""")
def t24(spark, d):
    return table(spark, d, "documents").select("doc_id", X.bare_ampersands(F.col("text")).alias("n"))


@P.add("t25_clipped", """SELECT instance_id, CASE WHEN length(problem_statement) > 70 THEN left(problem_statement, 67) || '...' ELSE problem_statement END AS head FROM bench_tasks""")
def t25(spark, d):
    return table(spark, d, "bench_tasks").select("instance_id", X.clipped(F.col("problem_statement"), 70).alias("head"))


_T12 = (
    "WITH "
    + STEPS
    + r"""
, files AS (SELECT step_id AS file_id, action.filepath AS path, action.content AS text FROM steps WHERE action.content IS NOT NULL),
split AS (SELECT file_id, path, string_split(text, chr(10)) AS parts FROM files),
lines AS (SELECT file_id, path, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no FROM split),
held AS (SELECT *, lower(line) AS low, lower(path) AS place, regexp_matches(line, '^\s*(#|//|/\*|\*|\x22{3}|\x27{3})') AS comment, regexp_matches(line, '\b(async\s+def|def|class)\s+') AS says,
  lower(regexp_extract(line, '^\s*(async\s+def|def|class)\s+([A-Za-z0-9_]+)', 2)) AS name FROM lines WHERE contains(lower(line), 'return') OR contains(lower(line), 'lookup')),
scored AS (SELECT file_id, line_no,
  coalesce(CASE WHEN path LIKE '%.py' THEN 30 WHEN path LIKE '%.pyi' OR path LIKE '%.toml' THEN 10 ELSE 0 END, 0)
  + CASE WHEN contains(place, 'test') THEN -40 ELSE 0 END
  + CASE WHEN (contains(place, 'doc') OR path LIKE '%.md' OR path LIKE '%.rst') AND NOT (contains(place, 'docs_src') AND path LIKE '%.py') THEN -40 ELSE 0 END
  + CASE WHEN contains(place, 'bench') OR contains(place, 'example') THEN -50 ELSE 0 END
  + CASE WHEN regexp_matches(place, '(\b|_)(ansi|text|codec|decode|encode|string|parser|format|stream)(\b|\.py)') THEN 25 ELSE 0 END
  + CASE WHEN comment THEN 0 WHEN says THEN 60 WHEN contains(line, '@') THEN 30 ELSE 0 END
  + CASE WHEN comment THEN 0 WHEN name <> '' THEN 60 WHEN regexp_matches(line, '^\s*@') THEN 30 ELSE 0 END
  + CASE WHEN comment THEN 0 WHEN name = 'return' THEN 75 WHEN contains(name, 'return') THEN 50 WHEN name = 'lookup' THEN 75 WHEN contains(name, 'lookup') THEN 50 ELSE 0 END
  + CASE WHEN contains(line, '=') AND NOT regexp_matches(line, '^\s*#') THEN 10 ELSE 0 END
  + CASE WHEN regexp_matches(low, '\.\s*(VERBS)\s*\(') OR regexp_matches(low, '\b(BUFFERS)\w*\s*\.\s*(VERBS)\b') OR regexp_matches(line, '\bre\.(split|sub|finditer|findall)\s*\(') THEN 40 ELSE 0 END
  + CASE WHEN regexp_matches(line, '\b\w+\.(splitlines|split|rstrip|strip|replace|join|partition|decode|encode)\(') THEN 30 ELSE 0 END
  + CASE WHEN contains(line, 'yield') OR regexp_matches(line, 'for\s+\w+\s+in\s+.*(splitlines|split|partition)') THEN 20 ELSE 0 END
  + CASE WHEN regexp_matches(line, '\b(len|assert)\s*\(') THEN -25 ELSE 0 END
  + CASE WHEN regexp_matches(low, '\breturn\b') THEN 15 ELSE 0 END + CASE WHEN regexp_matches(low, '\blookup\b') THEN 15 ELSE 0 END AS score FROM held),
ranked AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY score DESC, line_no) AS rank FROM scored)
SELECT file_id, line_no, score, rank FROM ranked WHERE rank <= 3"""
)


@P.add("t12_line_scores", _T12.replace("VERBS", "|".join(STRING_VERBS)).replace("BUFFERS", "|".join(BUFFER_NAMES)))
def t12(spark, d):
    """Best three lines of each task's files for two terms."""
    from millrace.operators.search import ranked_lines

    a = F.col("action")
    files = steps(spark, d).where(a.content.isNotNull()).select(F.col("step_id").alias("file_id"), a.filepath.alias("path"), a.content.alias("text"))
    return ranked_lines(files, ["return", "lookup"], per_file=3)


@P.add("s5_tolerant_lines", """SELECT collection_name, count(*) AS lines, count(*) FILTER (WHERE trim(raw) = '') AS blank, count(*) FILTER (WHERE json_valid(raw) AND trim(raw) <> '') AS good FROM rag_exports GROUP BY 1""")
def s5(spark, d):
    ok = S.is_json(F.col("raw"))
    return table(spark, d, "rag_exports").groupBy("collection_name").agg(F.count("*").alias("lines"), F.sum((F.trim("raw") == "").cast("long")).alias("blank"), F.sum(ok.cast("long")).alias("good"))


@P.add("g2_canonical_json", """SELECT collection_name, file_name, line_no, CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN array_to_string(list_sort(json_keys(raw)), ',') ELSE '' END AS keys FROM rag_exports""")
def g2(spark, d):
    keys = F.array_join(F.array_sort(F.map_keys(S.parsed_or_empty(F.col("raw")))), ",")
    return table(spark, d, "rag_exports").select("collection_name", "file_name", "line_no", keys.alias("keys"))


@P.add("u5_extra_keys", """WITH x AS (SELECT file_name, line_no, unnest(json_keys(raw)) AS k FROM rag_exports WHERE json_valid(raw) AND json_type(raw) = 'OBJECT') SELECT k AS extra_key, count(*) AS n FROM x WHERE k NOT IN ('id', 'text', 'source', 'chapter', 'original_text', 'content', 'summary_zh', 'modern_chinese_summary') GROUP BY 1""")
def u5(spark, d):
    allowed = ["id", "text", "source", "chapter", "original_text", "content", "summary_zh", "modern_chinese_summary"]
    x = table(spark, d, "rag_exports").select(F.explode(S.extra_keys(F.col("raw"), allowed)).alias("extra_key"))
    return x.groupBy("extra_key").agg(F.count("*").alias("n"))


@P.add("g3_pointer", """SELECT event_id, json_extract_string(props, '/k') AS k FROM events""")
def g3(spark, d):
    return table(spark, d, "events").select("event_id", S.pointer(F.col("props"), "/k").alias("k"))


@P.add("m2_digests", "SELECT doc_id, sha256(text) AS sha, md5(text) AS md FROM documents")
def m2(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.md5("text").alias("md"))


@P.add("k10_metadata", """SELECT source, count(*) AS texts, max(coalesce(length(text), 0)) AS most_chars, sum(coalesce(('0x' || substr(md5(text), 1, 8))::BIGINT, 0))::BIGINT AS digest FROM documents GROUP BY 1""")
def k10(spark, d):
    """Counts and a digest of each source that needs no order: digests of rows are summed, none is gathered."""
    part = F.coalesce(F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("long"), F.lit(0))
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("texts"), F.max(F.coalesce(F.length("text"), F.lit(0))).cast("long").alias("most_chars"), F.sum(part).alias("digest"))


@P.add("m10_sequence_compare", f"""WITH {STEPS}, x AS (SELECT step_id, action.args AS a, lag(action.args) OVER (PARTITION BY task_id ORDER BY step_index, step_id) AS b FROM steps WHERE action.action_type = 'run_skill_script' AND action.args IS NOT NULL)
SELECT step_id, (len(a) - len(b))::BIGINT AS longer_by, CASE WHEN a = b THEN NULL ELSE coalesce(list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i]), false) - 1, least(len(a), len(b)))::BIGINT END AS at FROM x WHERE b IS NOT NULL""")
def m10(spark, d):
    from pyspark.sql import Window

    x = steps(spark, d).where((F.col("action.action_type") == "run_skill_script") & F.col("action.args").isNotNull()).select("step_id", "task_id", "step_index", F.col("action.args").alias("a"))
    x = x.withColumn("b", F.lag("a").over(Window.partitionBy("task_id").orderBy("step_index", "step_id"))).where("b is not null")
    return x.select("step_id", (F.size("a") - F.size("b")).cast("long").alias("longer_by"), S.first_mismatch(F.col("a"), F.col("b")).alias("at"))


@P.add("m9_map_compare", """WITH x AS (SELECT event_id, props AS a, lag(props) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) SELECT event_id, json_extract_string(a, '/k') IS DISTINCT FROM json_extract_string(b, '/k') AS changed FROM x WHERE b IS NOT NULL""")
def m9(spark, d):
    from pyspark.sql import Window

    x = table(spark, d, "events").withColumn("b", F.lag("props").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).where("b is not null")
    diff = S.map_difference(S.parsed_or_empty(F.col("props")), S.parsed_or_empty(F.col("b")))
    return x.select("event_id", (F.size(diff["different"]) > 0).alias("changed"))


@P.add("m12_token_counts", r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\v]+'))::BIGINT AS tokens FROM documents")
def m12(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^ \t\n\r\f\x0B]+)"), 1)).cast("long").alias("tokens"))


@P.add("m8_masked_labels", """WITH x AS (SELECT vec_id, list_transform(range(0, (vec_id % 9 + 1)::BIGINT), lambda i: (vec_id + i)::INTEGER) AS ids, (vec_id % 4)::BIGINT AS prefix FROM embeddings)
SELECT vec_id, array_to_string(list_concat(list_transform(list_slice(ids, greatest(len(ids) - 6, 0) + 1, len(ids)), lambda v, i: CASE WHEN i - 1 + greatest(len(ids) - 6, 0) < prefix THEN -100 ELSE v END), list_transform(range(0, (8 - least(len(ids), 6))::BIGINT), lambda i: -100)), ',') AS labels FROM x""")
def m8(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", F.transform(F.sequence(F.lit(0).cast("long"), F.col("vec_id") % 9), lambda i: (F.col("vec_id") + i).cast("int")).alias("ids"), (F.col("vec_id") % 4).alias("prefix"))
    return x.select("vec_id", F.array_join(S.masked_labels(F.col("ids"), F.col("prefix"), 6, 8), ",").alias("labels"))


@P.add("t19_terminal_width")
def t19(spark, d):
    from millrace.functions.arrow import terminal_width

    return table(spark, d, "documents").select("doc_id", terminal_width(F.col("text")).alias("cells"))


@P.add("m7_fuzzy_suggestions")
def m7(spark, d):
    """Near names of task repositories among all repositories of the steps."""
    from millrace.operators.search import fuzzy

    q = table(spark, d, "bench_tasks").select(F.col("repo").alias("query")).where("query is not null").distinct()
    c = steps(spark, d).select(F.col("repo").alias("candidate")).where("candidate is not null").distinct()
    return fuzzy(q, c, 3, 0.5)


@P.add("g6_html_findings")
def g6(spark, d):
    from millrace.functions.arrow import html_findings

    return html_findings(table(spark, d, "documents"), "doc_id", "text")


@P.add("c7_python_symbols")
def c7(spark, d):
    """Definitions, imports and calls of all Python files that steps wrote, with their scope."""
    from millrace.functions.arrow import python_symbols

    a = F.col("action")
    x = steps(spark, d).where((a.action_type == "write_file") & a.filepath.endswith(".py") & a.content.isNotNull())
    return python_symbols(x.select("step_id", a.content.alias("content")), "step_id", "content")


@P.add("k8_catalog", """WITH p AS (SELECT * FROM rag_points QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY ingested_at DESC) = 1) SELECT row_number() OVER (ORDER BY chapter NULLS FIRST, point_id) AS place, chapter, point_id FROM p""")
def k8(spark, d):
    """Entries numbered in the order of the compiled catalog, by a range-partitioned sort."""
    from millrace.operators.ordering import numbered

    x = points(spark, d).select("chapter", "point_id")
    return numbered(x, [F.col("chapter").asc_nulls_first(), F.col("point_id")], "place").select("place", "chapter", "point_id")
