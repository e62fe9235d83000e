"""Message sequences into steps: calls translated with a memory of written files, folded in order, classified.

A task's messages are one array in one row, so the fold is a narrow pass over Arrow batches and nothing is shuffled.
Calls that translate to nothing are dropped; malformed arguments count as empty."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import PATH_ROOTS, SCRATCH

Call = tuple[str, dict]
# fixed values: helper scripts and the file that each one is
SCRIPTS = {"fast-grep": "grep.py", "code-map": "map.py", "code-oracle": "oracle.py", "repro-check": "check.py", "test-gate": "gate.py"}
_THROWAWAY = re.compile(SCRATCH)
MOST, LEAST_STEPS = 40, 4


def clean_path(p: object) -> str:
    p = str(p or "").strip()
    for r in PATH_ROOTS:
        p = re.sub(r, "", p)
    return p.lstrip("/")


def throwaway(p: str) -> bool:
    return bool(p) and ("/tests/" in f"/{p}" or bool(_THROWAWAY.search(p)))


def helper(skill: str, *args: str) -> Call:
    return "run_skill_script", {"skill_name": skill, "file_path": SCRIPTS[skill], "args": list(args)}


def _whole(v: object) -> int | None:
    try:
        return int(v)  # type: ignore[call-overload]
    except (TypeError, ValueError):
        return None


class Translator:
    """Turns calls of other tool sets into the step vocabulary; remembers what was written under which name."""

    def __init__(self) -> None:
        self.written: dict[str, str] = {}

    def __call__(self, name: str, args: dict) -> Call | None:
        path = clean_path(args.get("filepath") or args.get("file_path") or args.get("path"))
        if name in ("submit_patch", "finish", "submit"):
            return "submit_patch", {}
        if name == "get_status":
            return name, {}
        if name == "read_file":
            bounds = {k: n for k in ("start_line", "end_line") if (n := _whole(args.get(k))) is not None}
            return (name, {"filepath": path, **bounds}) if path else None
        if name == "edit_file":
            return self.edit(path, args.get("old_string") or args.get("old_text"), args.get("new_string") or args.get("new_text"))
        if name == "write_file":
            return self.write(path, args.get("content"))
        if name == "run_skill_script":
            ok = SCRIPTS.get(args.get("skill_name")) == args.get("file_path")
            rest = args.get("args")
            return (name, {**args, "args": [str(x) for x in (rest if isinstance(rest, list) else [rest] if rest else [])]}) if ok else None
        if name in ("str_replace_editor", "editor"):
            return self.editor(path, args)
        return self.shell(str(args.get("command") or args.get("cmd") or "").strip())

    def edit(self, path: str, old: object, new: object) -> Call | None:
        return ("edit_file", {"filepath": path, "old_string": str(old), "new_string": str(new or ""), "allow_multiple": False}) if path and old else None

    def write(self, path: str, content: object) -> Call | None:
        text = str(content or "")
        self.written[path] = self.written[path.rsplit("/", 1)[-1]] = text
        return None if not path or throwaway(path) else ("write_file", {"filepath": path, "content": text})

    def editor(self, path: str, args: dict) -> Call | None:
        what = args.get("command")
        if what == "view":
            span = args.get("view_range") or []
            if not span and "." not in path.rsplit("/", 1)[-1]:
                return helper("code-map", "--file", path or ".")
            bounds = {k: n for k, v in zip(("start_line", "end_line"), span) if (n := _whole(v)) is not None}
            return "read_file", {"filepath": path, **bounds}
        if what == "str_replace":
            return self.edit(path, args.get("old_str"), args.get("new_str"))
        return self.write(path, args.get("file_text")) if what == "create" else None

    def shell(self, c: str) -> Call | None:
        words = c.split()
        if not words or re.match(r"rm |git (?:checkout|clean|reset)\b", c):
            return None
        if re.search(r"pytest|unittest|\btox\b", c):
            return helper("test-gate")
        if "git diff" in c:
            return helper("test-gate", "--diff")
        if "git status" in c:
            return "get_status", {}
        if "py_compile" in c:
            return helper("code-oracle", "--syntax", clean_path(words[-1]))
        if m := re.search(r"python3?\s+-c\s+(['\"])(.*)\1", c, re.S):
            return self.code(m[2])
        if m := re.search(r"python3?\s+(\S+\.py)\b", c):
            text = self.written.get(clean_path(m[1])) or self.written.get(m[1].rsplit("/", 1)[-1])
            return self.code(text) if text else None
        if re.search(r"\bfind\b.*-(?:name|type)", c) or re.match(r"ls\b", c):
            return helper("code-map", "--file", clean_path(next((w for w in words[1:] if not w.startswith("-")), "")) or ".")
        if re.search(r"grep|\brg ", c):
            return self.search(c)
        return None

    @staticmethod
    def code(text: str) -> Call:
        if "assert" not in text:
            return helper("code-oracle", "--eval", text)
        return helper("repro-check", text if "assert " in text else text + "\nassert True")

    @staticmethod
    def search(c: str) -> Call | None:
        if m := re.search(r"\b(?:class|def)\s+(\w+)", c):
            return helper("code-map", "--symbol", m[1])
        tail = c[re.search(r"grep|\brg ", c).end() :]
        if m := re.search(r"(['\"])(.+?)\1(.*)$", tail, re.S):
            what, rest = m[2], m[3].split()
        else:
            bare = [w for w in tail.split() if not w.startswith("-")]
            if not bare or len(bare[0]) < 2:
                return None
            what, rest = bare[0], bare[1:]
        where = next((clean_path(w) for w in rest if not w.startswith("-")), "")
        return helper("fast-grep", what, *([where] if where else []))


def call_of(raw: dict) -> Call:
    """Name and arguments of a tool call, nested under ``function`` or flat; arguments may be JSON text."""
    f = raw.get("function") if isinstance(raw.get("function"), dict) else raw
    args = f.get("arguments", {})
    if isinstance(args, str):
        try:
            args = json.loads(args)
        except ValueError:
            args = {}
    return str(f.get("name") or ""), args if isinstance(args, dict) else {}


def fold(messages: list, stop_at_submit: bool = True) -> tuple[str, list[dict]] | None:
    """(prompt, steps) of a conversation, or None without a prompt or with fewer than LEAST_STEPS steps.

    Steps alternate between an assistant's calls and the first tool message after them; an assistant that nobody
    answers is replaced by the next one, and dropped at the end unless it submits."""
    prompt, steps, translate = "", [], Translator()
    for m in messages:
        if not isinstance(m, dict):
            continue
        role = m.get("role")
        tail = steps[-1] if steps else None
        if role == "user" and not prompt:
            prompt = str(m.get("content") or "").strip()
        elif role == "assistant":
            raw = [call_of(c) for c in m.get("tool_calls") or [] if isinstance(c, dict)]
            calls = [t for n, a in raw if n != "think" and (t := translate(n, a))]
            if not calls:
                continue
            if tail and tail["role"] == "assistant":
                steps.pop()
            step = {"role": "assistant", "calls": [{"id": f"call_{len(steps)}_{i}", "name": n, "arguments": a} for i, (n, a) in enumerate(calls)]}
            steps.append(step)
            if stop_at_submit and calls[0][0] == "submit_patch":
                steps.append({"role": "tool", "content": "Patch submitted."})
                break
        elif role == "tool" and tail and tail["role"] == "assistant":
            steps.append({"role": "tool", "content": str(m.get("content") or "")})
    if steps and steps[-1]["role"] == "assistant" and steps[-1]["calls"][0]["name"] != "submit_patch":
        steps.pop()
    return (prompt, steps) if prompt and len(steps) >= LEAST_STEPS else None


def build(df: DataFrame, key: str, messages: str, stop_at_submit: bool = True) -> DataFrame:
    """(key, prompt, n_steps, steps) of the conversations that make a trajectory; ``messages`` is JSON text."""
    names = [key, "prompt", "n_steps", "steps"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    found = fold(json.loads(text), stop_at_submit)
                except (TypeError, ValueError):
                    continue
                if found:
                    rows.append((k, found[0], len(found[1]), json.dumps(found[1], ensure_ascii=False)))
            cols = list(zip(*rows)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return df.select(F.col(key).cast("string"), F.col(messages)).mapInArrow(run, f"{key} string, prompt string, n_steps long, steps string")


def budget(steps: DataFrame, task: str, tool: Column, observation: Column) -> DataFrame:
    """Per task: calls that went wrong for good (b), that told something (a), and clean ones; b is looked at first.

    Words are fixed values, looked for in any case and with every tool."""
    low = F.lower(F.coalesce(observation, F.lit("")))
    b = (tool.contains("edit") & low.rlike("error|not found|no match|did not match|failed")) | (tool.contains("read") & low.rlike("no such file|does not exist|error"))
    a = low.rlike("traceback|assertionerror|failed|error|no matches|0 matches")
    kind = F.when(b, "b").when(a, "a").otherwise("clean")
    n = lambda k: F.sum((kind == k).cast("long")).alias(k)
    x = steps.groupBy(task).agg(F.count("*").alias("total"), n("clean"), n("a"), n("b"))
    return x.withColumn("within", (F.col("b") == 0) & (F.col("clean") < 20) & (F.col("a") < 20) & (F.col("total") < MOST) & (F.col("total") >= 2))
