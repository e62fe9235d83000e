"""What speaks for or against a line that a search found, and how much.

A line fires signals, an array of names that says why it ranks where it does; its score is the sum of their weights, which
the caller may replace. All of it is Catalyst: pattern tests gathered into arrays, and one lookup in a literal map.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: verbs, words and weights that scores depend on
STRING_VERBS = ("splitlines", "split", "rstrip", "strip", "lstrip", "replace", "join", "partition", "rpartition", "decode", "encode", "from_ansi")
CALLED_VERBS = ("splitlines", "split", "rstrip", "strip", "replace", "join", "partition", "decode", "encode")
BUFFER_NAMES = ("text", "line", "lines", "terminal_text", "buffer", "output", "input", "data", "content", "string", "val", "raw", "payload", "chunk", "stream", "body", "msg")
PATH_WORDS = ("ansi", "text", "codec", "decode", "encode", "string", "parser", "format", "stream")
SCOPE_WORDS = ("ansi", "text", "buffer", "decode", "encode")
WEIGHTS = {
    "python file": 30, "stub or toml file": 10, "test path": -40, "doc path": -40, "bench or example path": -50, "text path": 25,
    "definition": 60, "at sign": 30, "definition begins": 60, "decorator begins": 30, "name is a term": 75, "name holds a term": 50,
    "equals sign": 10, "string transform": 40, "verb called": 30, "iteration": 20, "length or assert": -25,
    "scope verb": 25, "scope word": 20, "term": 15,
}


def _any(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")"


def _fired(**tests: Column) -> Column:
    """The names of the tests that hold; an underscore stands for a blank."""
    return F.array_compact(F.array(*[F.when(test, name.replace("_", " ")) for name, test in tests.items()]))


def path_signals(path: Column) -> Column:
    """What the path of a file says: ``docs_src/tutorial.py`` is a Python file and no doc, ``docs/a.md`` a doc."""
    mentions = lambda word: F.lower(path).contains(word)
    python = path.endswith(".py")
    written = path.rlike(r"\.(md|rst)$")
    return _fired(
        python_file=python,
        stub_or_toml_file=path.rlike(r"\.(pyi|toml)$"),
        test_path=mentions("test"),
        doc_path=(mentions("doc") | written) & ~(mentions("docs_src") & python),
        bench_or_example_path=mentions("bench") | mentions("example"),
        text_path=F.lower(path).rlike(rf"(\b|_){_any(PATH_WORDS)}(\b|\.py)"),
    )


def transforms_string(line: Column) -> Column:
    """Whether a line transforms a string: ``x.strip ()``, the method of a buffer without a call (``map(line.strip, xs)``),
    ``re.sub(``."""
    verbs = _any(STRING_VERBS)
    return line.rlike(rf"(?i)\.\s*{verbs}\s*\(") | line.rlike(rf"(?i)\b{_any(BUFFER_NAMES)}\w*\s*\.\s*{verbs}\b") | line.rlike(r"\bre\.(split|sub|finditer|findall)\s*\(")


def line_signals(line: Column, words: list[str]) -> Column:
    """What the text of a line says. A comment defines and decorates nothing; of the words, the first that the defined
    name is or holds counts."""
    code = ~line.rlike(r"^\s*(#|//|/\*|\*|\"{3}|'{3})")
    opens = r"^\s*(?:async\s+def|def|class)\s+([A-Za-z0-9_]+)"
    begins = code & line.rlike(opens)
    defines = code & line.rlike(r"\b(?:async\s+def|def|class)\s+")
    name = F.lower(F.regexp_extract(line, opens, 1))
    said = F.lit(None).cast("string")
    for w in reversed([w.lower() for w in words]):
        said = F.when(name == w, "is").when(name.contains(w), "holds").otherwise(said)
    return _fired(
        definition=defines,
        at_sign=code & ~defines & line.contains("@"),
        definition_begins=begins,
        decorator_begins=code & ~begins & line.rlike(r"^\s*@"),
        name_is_a_term=begins & (said == "is"),
        name_holds_a_term=begins & (said == "holds"),
        equals_sign=line.contains("=") & ~line.rlike(r"^\s*#"),
        string_transform=transforms_string(line),
        verb_called=line.rlike(rf"\b\w+\.{_any(CALLED_VERBS)}\("),
        iteration=line.contains("yield") | line.rlike(r"for\s+\w+\s+in\s+.*(splitlines|split|partition)"),
        length_or_assert=line.rlike(r"\b(len|assert)\s*\("),
    )


def scope_signals(scope: Column) -> Column:
    """What the name of the function or class around a line says; null and '' say nothing."""
    low = F.lower(F.coalesce(scope, F.lit("")))
    return _fired(scope_verb=low.rlike(_any(STRING_VERBS)), scope_word=low.rlike(_any(SCOPE_WORDS)))


def term_signals(line: Column, words: list[str]) -> Column:
    """``term`` for each word in the line: identifiers as whole words, others anywhere, in any case."""
    held = F.lower(line)
    found = [held.rlike(rf"\b{w.lower()}\b") if w.isascii() and w.replace("_", "a").isalnum() else held.contains(w.lower()) for w in words]
    return F.array_compact(F.array(*[F.when(x, "term") for x in found])) if found else F.array().cast("array<string>")


def signals(path: Column, line: Column, words: list[str], scope: Column | None = None) -> Column:
    """All signals of a found line; blank words are left out."""
    words = [w.strip() for w in words if w.strip()]
    return F.concat(path_signals(path), line_signals(line, words), scope_signals(F.lit(None) if scope is None else scope), term_signals(line, words))


def score(fired: Column, weights: dict[str, int] | None = None) -> Column:
    """The sum of the weights of an array of signals."""
    table = F.create_map(*[F.lit(x) for pair in (weights or WEIGHTS).items() for x in pair])
    return F.aggregate(fired, F.lit(0), lambda total, x: total + F.coalesce(table[x], F.lit(0))).cast("long")
