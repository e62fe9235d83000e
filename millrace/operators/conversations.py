"""Conversations as tables: one row a message (task_id, pos, role, content, calls), an assistant's calls as an array.

Everything is windows and aggregates over one partitioning by task: a turn's tool messages, the turn before it and the
messages that lead to it come from the same exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CALLS = "array<struct<name:string,skill:string,args:string>>"
# fixed values: words that tell outcomes, in any place and in this case; limits and last actions
EDIT_FAILED = ("Error", "not found", "No match", "no match", "did not match", "Failed", "SyntaxError", "old_str")
READ_FAILED = ("FileNotFoundError", "No such file", "does not exist", "IsADirectoryError")
TEST_FAILED = ("Traceback", "AssertionError", "FAILED", "Error")
NOTHING_FOUND = ("No matches", "0 matches")
LAST_ACTIONS = ("submit_patch", "edit_file", "write_file", "submit", "finish")
MOST_CLEAN, MOST_NEGATIVE, MOST_CALLS = 20, 20, 40
SCRIPTS = {"fast-grep": "grep.py", "code-map": "map.py", "code-oracle": "oracle.py", "repro-check": "check.py", "test-gate": "gate.py"}


def says(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def turns(messages: DataFrame) -> DataFrame:
    """(task_id, pos, calls, observation): assistant messages with calls, and the texts of the tool messages that directly
    follow, a line each, shared by all calls of the turn."""
    by_task = Window.partitionBy("task_id").orderBy("pos")
    anchor = F.last(F.when(F.col("role") != "tool", F.col("pos")), ignorenulls=True).over(by_task)
    told = F.when(F.col("role") == "tool", F.struct("pos", F.coalesce("content", F.lit("")).alias("content")))
    x = messages.withColumn("anchor", anchor).where("anchor is not null").groupBy("task_id", "anchor")
    own = (F.col("role") == "assistant") & (F.size("calls") > 0)
    x = x.agg(F.max(F.when(own, F.to_json("calls"))).alias("calls"), F.sort_array(F.collect_list(told)).alias("told")).where("calls is not null")
    return x.select("task_id", F.col("anchor").alias("pos"), F.from_json("calls", CALLS).alias("calls"), F.array_join(F.col("told.content"), "\n").alias("observation"))


def outcome(call: Column, observation: Column) -> Column:
    """``b`` for an edit or a read that failed, ``a`` for a test that failed or a search without a result, else ``clean``."""
    bad = ((call["name"] == "edit_file") & says(observation, EDIT_FAILED)) | ((call["name"] == "read_file") & says(observation, READ_FAILED))
    told = (call["skill"].isin("repro-check", "test-gate") & says(observation, TEST_FAILED)) | (call["skill"].isin("fast-grep", "code-map") & says(observation, NOTHING_FOUND))
    return F.when(bad, "b").when((call["name"] == "run_skill_script") & told, "a").otherwise("clean")


def classify(messages: DataFrame) -> DataFrame:
    """(task_id, clean, type_a, type_b, calls, valid) of every task with a turn. A turn whose calls are those of the turn
    before it counts once more as ``type_b``. Valid are tasks without ``type_b``, within the limits, whose last turn edits,
    writes or submits."""
    x = turns(messages).withColumn("kinds", F.transform("calls", lambda c: outcome(c, F.col("observation"))))
    before = F.lag(F.to_json("calls")).over(Window.partitionBy("task_id").orderBy("pos"))
    x = x.withColumn("again", (F.to_json("calls") == before) & before.isNotNull())
    n = lambda k: F.sum(F.size(F.filter("kinds", lambda v: v == k))).cast("long")
    x = x.groupBy("task_id").agg(
        n("clean").alias("clean"), n("a").alias("type_a"), (n("b") + F.sum(F.col("again").cast("long"))).alias("type_b"),
        F.sum(F.size("calls")).cast("long").alias("calls"), F.max_by(F.col("calls.name"), F.col("pos")).alias("last"),
    )
    valid = (F.col("type_b") == 0) & (F.col("clean") > 0) & (F.col("clean") < MOST_CLEAN) & (F.col("type_a") < MOST_NEGATIVE) & (F.col("clean") + F.col("type_a") < MOST_CALLS)
    return x.withColumn("valid", valid & F.arrays_overlap("last", F.array(*map(F.lit, LAST_ACTIONS)))).drop("last")


def words_of(text: Column) -> Column:
    """The number of words: what a token limit counts where no tokenizer is given."""
    return F.regexp_count(text, F.lit(r"\S+"))


def rendered(message: Column) -> Column:
    """A message as text; calls come as ``call:name{args}``, thoughts in ``<think>`` stay where they are."""
    calls = F.array_join(F.transform(message["calls"], lambda c: F.concat(F.lit("call:"), c["name"], F.lit("{"), F.coalesce(c["args"], F.lit("")), F.lit("}"))), "")
    return F.concat(F.lit("<"), message["role"], F.lit(">"), F.coalesce(calls, F.lit("")), F.coalesce(message["content"], F.lit("")), F.lit("\n"))


def decision_windows(messages: DataFrame, system: str, user: Column, context: int = 2, most: int = 4096, tokens=words_of) -> DataFrame:
    """(task_id, turn, names, context, prefix, completion, tokens): for each assistant message with calls the system and user
    messages, up to ``context`` messages before it and itself, as text. Guards: the completion begins with a call, no part
    of it thinks, and the whole is within ``most`` tokens."""
    w = Window.partitionBy("task_id").orderBy("pos")
    m = F.struct("role", "content", "calls")
    x = messages.withColumn("turn", F.row_number().over(w) - 1).withColumn("led", F.collect_list(m).over(w.rowsBetween(-context, -1)))
    x = x.where((F.col("role") == "assistant") & (F.size("calls") > 0))
    head = F.concat(F.lit(f"<system>{system}\n<user>"), user, F.lit("\n"))
    prefix = F.concat(head, F.array_join(F.transform("led", rendered), ""), F.lit("<assistant>"))
    x = x.withColumn("prefix", prefix).withColumn("completion", F.substring(rendered(m), len("<assistant>") + 1, 1 << 30))
    x = x.withColumn("tokens", tokens(F.concat("prefix", "completion")).cast("long"))
    x = x.where(F.col("completion").startswith("call:") & ~F.col("completion").contains("<think>") & (F.col("tokens") <= most))
    return x.select("task_id", F.col("turn").cast("long").alias("turn"), F.array_join(F.col("calls.name"), ",").alias("names"), F.array_join(F.transform("led", lambda v: v["role"]), ">").alias("context"), "prefix", "completion", "tokens")


def reconciled(actions: DataFrame, sources: DataFrame) -> DataFrame:
    """(task_id, step_id, name, observation): each action with the observation of its source step. ``actions`` has task_id,
    step_id, source_step_index, name and skill, ``sources`` task_id, step_index and observation. A submission and a check
    whose source asserted get fixed texts, what has no text succeeded."""
    src = sources.select("task_id", F.col("step_index").alias("source_step_index"), F.col("observation").alias("told"))
    x = actions.join(src, ["task_id", "source_step_index"], "left")
    checked = (F.col("skill") == "repro-check") & F.lower("told").contains("assert")
    text = F.when(F.col("name") == "submit_patch", "Patch submitted.").when(checked, "Assert passed.").when((F.col("told") == "") | F.col("told").isNull(), "Success.").otherwise(F.col("told"))
    return x.select("task_id", "step_id", "name", text.alias("observation"))


def diagnosis(steps: DataFrame, least: int = 3, most: int = 16) -> DataFrame:
    """(task_id, findings): what is wrong with each task's steps, each finding once, in the order of their names. ``steps``
    has task_id, step_index, step_id, source_step_index, source_steps (how many the source has), target (the file that edits
    should change) and action."""
    a = F.col("action")
    w = Window.partitionBy("task_id").orderBy("step_index", "step_id")
    path = lambda c: F.regexp_replace(F.trim(c), "^/+", "")
    edit, script = a.action_type == "edit_file", a.action_type == "run_skill_script"
    pairs = F.create_map(*[F.lit(v) for kv in SCRIPTS.items() for v in kv])
    found = F.array_compact(
        F.array(
            F.when((F.col("source_step_index") < 0) | (F.col("source_step_index") >= F.col("source_steps")), "index_out_of_bounds"),
            F.when(edit & ~path(a.filepath).eqNullSafe(path(F.col("target"))), "edit_elsewhere"),
            F.when(edit & a.old_string.eqNullSafe(a.new_string), "edit_without_change"),
            F.when(script & F.element_at(pairs, F.coalesce(a.skill_name, F.lit(""))).isNull(), "unknown_skill"),
            F.when(script & (F.element_at(pairs, F.coalesce(a.skill_name, F.lit(""))) != F.coalesce(a.file_path, F.lit(""))), "wrong_script"),
            F.when(F.col("same_as_before"), "repeated_action"),
        )
    )
    x = steps.withColumn("as_json", F.to_json("action")).withColumn("same_as_before", F.coalesce(F.col("as_json") == F.lag("as_json").over(w), F.lit(False)))
    x = x.groupBy("task_id").agg(
        F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_list(found))).alias("each"),
        F.max((a.action_type == "read_file") | a.skill_name.isin("fast-grep", "code-map")).alias("looked"), F.max(edit).alias("edited"), F.max_by(a.action_type, F.struct("step_index", "step_id")).alias("last"),
    )
    whole = F.array_compact(F.array(F.when(F.col("n") < least, "too_few_steps"), F.when(F.col("n") > most, "too_many_steps"), F.when(~F.coalesce("looked", F.lit(False)), "no_discovery"), F.when(~F.coalesce("edited", F.lit(False)), "no_edit"), F.when(~F.col("last").eqNullSafe(F.lit("submit_patch")), "not_submitted")))
    return x.select("task_id", F.array_sort(F.concat("each", whole)).alias("findings"))
