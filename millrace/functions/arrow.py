"""Functions that Catalyst has no expression for, over Arrow batches."""

from __future__ import annotations

import ast
import unicodedata
import warnings
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@lru_cache(1 << 16)
def char_cells(c: str) -> int:
    """Terminal cells of a character: none for marks and controls, two for wide ones and emoji."""
    o = ord(c)
    if unicodedata.category(c) in ("Mn", "Me", "Mc", "Cf", "Cc") or 0x1F3FB <= o <= 0x1F3FF:
        return 0
    return 2 if unicodedata.east_asian_width(c) in "WF" or 0x1F300 <= o <= 0x1FAFF or 0x2600 <= o <= 0x27BF else 1


def text_cells(x: str) -> int:
    """Terminal cells of a text. What a zero-width joiner ties to a sign takes no room of its own, a sign that variation
    selector 16 shows as an emoji takes two cells, and so do two letters of a flag."""
    if x.isascii() and x.isprintable():
        return len(x)
    total = last = 0
    tied = flag = False
    for c in x:
        o = ord(c)
        if o == 0x200D:
            tied = True
            continue
        if o == 0xFE0F:
            if last == 1:
                total, last = total + 1, 2
            continue
        n = char_cells(c)
        if 0x1F1E6 <= o <= 0x1F1FF:
            n, flag = (0, False) if flag else (2, True)
        else:
            flag = False
        if tied and n:
            n = 0
        tied = False
        total += n
        last = n or last
    return total


def terminal_width(t: Column) -> Column:
    @F.pandas_udf("long")
    def cells(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else text_cells(x)).astype("Int64")

    return cells(t)


# fixed values: elements without an end tag
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Tags(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.open: list[tuple[str, int]] = []
        self.found: list[tuple[int, str, str]] = []

    def handle_starttag(self, tag, attrs):
        if tag not in _VOID:
            self.open.append((tag, self.getpos()[0]))

    def handle_endtag(self, tag):
        line = self.getpos()[0]
        if tag in _VOID:
            self.found.append((line, "void end tag", tag))
        elif tag not in [t for t, _ in self.open]:
            self.found.append((line, "end without start", tag))
        else:
            while self.open[-1][0] != tag:
                t, n = self.open.pop()
                self.found.append((n, "misnested", t))
            self.open.pop()

    def handle_data(self, data):
        if "&" in data or "<" in data:
            self.found.append((self.getpos()[0], "unescaped", "&" if "&" in data else "<"))


def html_problems(text: str) -> list[tuple[int, str, str]]:
    """(line, kind, tag) of misnested, unclosed and stray tags and of unescaped signs."""
    p = _Tags()
    p.feed(text)
    p.close()
    return p.found + [(n, "unclosed", t) for t, n in p.open]


def html_findings(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line, kind, tag): one row per finding; texts without < and & are skipped before Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *f) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for f in html_problems(t)]
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.string(), pa.string()))], names=["id", "line", "kind", "tag"])

    x = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike("[<&]"))
    return x.mapInArrow(run, "id long, line int, kind string, tag string").withColumnRenamed("id", id_col)


def symbols(source: str) -> list[tuple[int, int, str, str, str]]:
    """(line, last line, kind, name, scope) of definitions, imports and calls; nothing for text that isn't Python."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(source)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    out: list[tuple[int, int, str, str, str]] = []
    stack: list[tuple[ast.AST, str]] = [(tree, "")]
    while stack:
        node, scope = stack.pop()
        inner = scope
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            out.append((node.lineno, node.end_lineno, "class" if isinstance(node, ast.ClassDef) else "function", node.name, scope))
            inner = f"{scope}.{node.name}" if scope else node.name
            if isinstance(node, ast.ClassDef):
                out += [(node.lineno, node.lineno, "base", ast.unparse(b), inner) for b in node.bases]
        elif isinstance(node, ast.Import):
            out += [(node.lineno, node.lineno, "import", a.name, scope) for a in node.names]
        elif isinstance(node, ast.ImportFrom):
            out += [(node.lineno, node.lineno, "import", f"{node.module or '.'}.{a.name}", scope) for a in node.names]
        elif isinstance(node, ast.Call):
            f = node.func
            name = f.id if isinstance(f, ast.Name) else f.attr if isinstance(f, ast.Attribute) else ""
            if name:
                out.append((node.lineno, node.lineno, "call", name, scope))
        stack += [(c, inner) for c in ast.iter_child_nodes(node)]
    return sorted(out)


def python_symbols(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line, last_line, kind, name, scope) of every file."""
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
    names = ["id", "line", "last_line", "kind", "name", "scope"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *s) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for s in symbols(t)]
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    x = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    return x.mapInArrow(run, "id long, line int, last_line int, kind string, name string, scope string").withColumnRenamed("id", id_col)


def schema_problems(schema) -> list[tuple[str, str]]:
    """(pointer, problem) of a JSON schema: dangling references, unknown types, required names without a property."""
    found: list[tuple[str, str]] = []
    todo: list[tuple[str, object]] = [("", schema)]
    while todo:
        where, node = todo.pop()
        if isinstance(node, list):
            todo += [(f"{where}/{i}", x) for i, x in enumerate(node)]
        if not isinstance(node, dict):
            continue
        ref = node.get("$ref")
        if isinstance(ref, str) and ref.startswith("#") and not _resolves(schema, ref[1:]):
            found.append((where, f"dangling reference {ref}"))
        kind = node.get("type")
        for k in kind if isinstance(kind, list) else [kind] if isinstance(kind, str) else []:
            if k not in ("string", "number", "integer", "boolean", "object", "array", "null"):
                found.append((where, f"unknown type {k}"))
        props = node.get("properties")
        if isinstance(node.get("required"), list) and isinstance(props, dict):
            found += [(where, f"required without property {r}") for r in node["required"] if r not in props]
        todo += [(f"{where}/{str(k).replace('~', '~0').replace('/', '~1')}", v) for k, v in node.items()]
    return sorted(found)


def _resolves(root, pointer: str) -> bool:
    node = root
    for p in pointer.split("/")[1:]:
        p = p.replace("~1", "/").replace("~0", "~")
        if isinstance(node, dict) and p in node:
            node = node[p]
        elif isinstance(node, list) and p.isdigit() and int(p) < len(node):
            node = node[int(p)]
        else:
            return False
    return True
