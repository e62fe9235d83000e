"""Search over lines of files: regular expression or literal, rule scores, ranks, fuzzy names, edits."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.signals import score, signals
from millrace.operators.dedup import top_per_group
from millrace.operators.joins import prefiltered
from millrace.session import stage

FILE_CHARS, FILE_LINES, LINE_CHARS = 500_000, 5_000, 1_000


def lines(files: DataFrame, guarded: bool = False) -> DataFrame:
    """(file_id, path, line_no, line) of every line, from 1. ``guarded`` leaves out huge files and lines, as a tool's scan does."""
    x = files.where(F.length("text") <= FILE_CHARS) if guarded else files
    x = x.select("file_id", "path", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    x = x.select("file_id", "path", (F.col("i") + 1).cast("long").alias("line_no"), "line")
    return x.where((F.col("line_no") <= FILE_LINES) & (F.length("line") <= LINE_CHARS)) if guarded else x


def matching_lines(files: DataFrame, pattern: str, ignore_case: bool = False, guarded: bool = False) -> DataFrame:
    """Lines that match a regular expression; where none does, those that hold it literally."""
    all_lines = lines(files, guarded)
    hits = all_lines.where(F.col("line").rlike(("(?i)" if ignore_case else "") + pattern))
    if not hits.isEmpty():
        return hits
    return all_lines.where(F.lower("line").contains(pattern.lower()) if ignore_case else F.col("line").contains(pattern))


def ranked_lines(files: DataFrame, words: list[str], per_file: int) -> DataFrame:
    """The best lines of each file that hold one of the words, by rule score, ties by line."""
    holds: Column = F.lit(False)
    for w in words:
        holds = holds | F.lower("line").contains(w.lower())
    x = lines(files).where(holds).withColumn("score", score(signals(F.col("path"), F.col("line"), words)))
    return top_per_group(x, ["file_id"], [F.desc("score"), F.col("line_no")], per_file).select("file_id", "line_no", "score", "rank")


def similarity(a: str, b: str) -> float:
    """Matching-block ratio of two names, also of their lower-case forms at 95 per cent."""
    return max(difflib.SequenceMatcher(None, a, b).ratio(), 0.95 * difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio())


def fuzzy(queries: DataFrame, candidates: DataFrame, n: int, cutoff: float) -> DataFrame:
    """(query, candidate, ratio, rank): up to n near names of each query. Queries are few (checked) and go to every task."""
    few = [r.query for r in queries.select("query").distinct().orderBy("query").limit(10_001).collect()]
    if len(few) > 10_000:
        raise ValueError("fuzzy suggestions take at most 10,000 queries at a time")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(q, c, round(s, 9)) for c in batch.column(0).to_pylist() for q in few if (s := similarity(q, c)) >= cutoff]
            q, c, s = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.string()), pa.array(c, pa.string()), pa.array(s, pa.float64())], names=["query", "candidate", "ratio"])

    x = candidates.select(F.col("candidate").cast("string")).where("candidate is not null").distinct().mapInArrow(run, "query string, candidate string, ratio double")
    return top_per_group(x, ["query"], [F.desc("ratio"), F.length("candidate"), F.col("candidate")], n)


def edit_text(text: str, old: str, new: str) -> tuple[str | None, str]:
    """A three-tier edit: exact, then with any white space, then by its delimiters; each must match once.

    Returns the new text and the tier, or None and the reason."""
    import re

    if not old:
        return None, "empty"
    n = text.count(old)
    if n:
        return (text.replace(old, new), "exact") if n == 1 else (None, "ambiguous")
    words = [re.escape(w) for w in old.split()]
    parts = [re.escape(w) for w in re.findall(r"\w+|[^\w\s]", old)]
    for tier, pattern in (("whitespace", r"\s+".join(words)), ("delimiters", r"\s*".join(parts))):
        if pattern:
            found = list(re.finditer(pattern, text))
            if len(found) == 1:
                return text[: found[0].start()] + new + text[found[0].end() :], tier
            if found:
                return None, "ambiguous"
    return None, "not found"


def edited(df: DataFrame, text: str, old: str, new: str) -> DataFrame:
    """Rows with ``edited`` and ``tier``."""
    schema = "edited string, tier string"

    @F.udf(schema, useArrow=True)
    def apply(t: str, a: str, b: str):
        return edit_text(t, a, b or "") if t is not None and a is not None else (None, "null")

    return df.withColumn("_e", apply(F.col(text), F.col(old), F.col(new))).select(*df.columns, F.col("_e.edited").alias("edited"), F.col("_e.tier").alias("tier"))


SYMBOLS = (("function", r"^\s*(?:async\s+def|def)\s+([A-Za-z_]\w*)"), ("class", r"^\s*class\s+([A-Za-z_]\w*)"), ("store", r"^\s*([A-Za-z_]\w*)\s*=[^=]"))


def candidate_symbols(files: DataFrame) -> DataFrame:
    """(file_id, symbol, kind, line_no): functions, classes and stores of each file, each symbol where it first stands."""
    found = F.array_compact(F.array(*[F.when(F.col("line").rlike(p), F.struct(F.lit(k).alias("part"), F.lit(kind).alias("kind"), F.regexp_extract("line", p, 1).alias("symbol"))) for k, (kind, p) in enumerate(SYMBOLS)]))
    x = lines(files).select("file_id", "line_no", F.explode(found).alias("s")).select("file_id", "line_no", "s.*")
    return x.groupBy("file_id", "symbol").agg(F.min(F.struct("line_no", "part", "kind")).alias("first")).select("file_id", "symbol", "first.kind", "first.line_no")


IDENTIFIER = r"([A-Za-z_][A-Za-z0-9_]*)"


def parts_of(name: str | Column, least: int = 3) -> Column:
    """The parts of an identifier between underscores, in lower case, each once."""
    return F.array_distinct(F.filter(F.split(F.lower(name), "_"), lambda p: F.length(p) >= least))


#: So many parts, those of most terms, come first in the names' keys. They order keys only: any order gives the same rows.
COMMON_PARTS = 1_000


def cascade(files: DataFrame, terms: DataFrame, least: int = 3) -> DataFrame:
    """(term, tier, hits, file_id, line_no): for each term the first tier that finds identifiers and how many: the term as it
    is, in any case, or identifiers with one of its parts; with the first place. Terms that nothing finds come as ``none``.

    Terms meet identifiers by equal keys, not line by line, so many terms cost one join, and the files are read once: a name
    has a key for itself in lower case and one for each part. With a part's key stand the parts before it, so that a name
    that shares several parts with a term counts at the first only, and names are summed by key before terms see them: pairs
    of terms and names are never formed. Keys that no term has go before the shuffle. ``fuzzy`` suggests names for terms
    without a hit where these are few."""
    keys = lambda name, parts: F.concat(F.array(F.concat(F.lit("="), F.lower(name))), parts)
    marked = lambda name: F.transform(parts_of(name, least), lambda p: F.concat(F.lit("_"), p))
    asked = stage(terms.select("term").where("term is not null and term <> ''").distinct().select("term", keys("term", marked("term")).alias("keys")), "terms")
    wanted = asked.select("term", "keys", F.explode("keys").alias("key"))
    shared = wanted.where(F.col("key").startswith("_")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    common = [r.key for r in shared.orderBy(F.desc("n"), "key").limit(COMMON_PARTS).collect()]
    words = lines(files).select("file_id", "line_no", F.explode(F.regexp_extract_all("line", F.lit(IDENTIFIER), 1)).alias("name"))
    names = words.groupBy("name").agg(F.count("*").alias("hits"), F.min(F.struct("file_id", "line_no")).alias("at"))
    names = names.withColumn("parts", F.array_sort(marked("name")))
    ordered = F.concat(F.filter("parts", lambda p: p.isin(common)), F.filter("parts", lambda p: ~p.isin(common)))
    x = names.select("name", "hits", "at", keys("name", ordered).alias("keys"))
    x = x.select("*", F.posexplode_outer("keys").alias("i", "key"))  # outer: else Spark tests the keys of every word before it groups them
    x = prefiltered(x, "key", wanted)
    before = F.when(F.col("i") == 0, F.array("name")).otherwise(F.slice("keys", F.lit(2), F.greatest(F.col("i") - 1, F.lit(0))))
    x = x.groupBy("key", before.alias("before")).agg(F.sum("hits").alias("hits"), F.min("at").alias("at"))
    x = x.join(wanted, "key")
    whole = F.col("key").startswith("=")
    t = F.when(whole & (F.get("before", F.lit(0)) == F.col("term")), F.array(F.lit(1), F.lit(2))).when(whole, F.array(F.lit(2))).otherwise(F.array(F.lit(3)))
    found = x.where(whole | ~F.arrays_overlap("before", "keys")).select("term", F.explode(t).alias("t"), "hits", "at")
    best = found.groupBy("term", "t").agg(F.sum("hits").alias("hits"), F.min("at").alias("at")).groupBy("term").agg(F.min(F.struct("t", "hits", "at")).alias("b"))
    tier = F.when(F.col("b.t") == 1, "exact").when(F.col("b.t") == 2, "any case").when(F.col("b.t") == 3, "part").otherwise("none")
    return asked.join(best, "term", "left").select("term", tier.alias("tier"), F.coalesce("b.hits", F.lit(0)).alias("hits"), F.col("b.at.file_id").alias("file_id"), F.col("b.at.line_no").alias("line_no"))


def stem(path: str | Column) -> Column:
    """The name of a file without folders and extension, in lower case."""
    return F.lower(F.regexp_extract(path, r"([^/]+?)(?:\.[A-Za-z0-9]+)?$", 1))


def similar_files(asked: DataFrame, files: DataFrame, group: str, n: int = 5, close: float = 0.5, least: int = 3) -> DataFrame:
    """(group, asked, tier, path, rank): up to ``n`` files of the group like each path asked for: of the same stem, with a stem
    that holds the other's or lies in it and shares a part with it, or a close one (edits of at most ``close`` of the longer)
    that shares its first or last ``least`` letters. Better tiers first, then fewer edits, then by path."""
    a = asked.select(group, F.col("path").alias("asked"), stem("path").alias("s")).where("s <> ''").distinct()
    f = files.select(group, "path", stem("path").alias("z")).where("z <> ''").distinct()
    pair = [group, "asked", "s", "path", "z"]
    same = a.join(f, (a[group] == f[group]) & (F.col("s") == F.col("z"))).select(a[group], "asked", "s", "path", "z")
    by_part = a.withColumn("k", F.explode(parts_of("s", least))).join(f.withColumn("k", F.explode(parts_of("z", least))), [group, "k"]).where(F.contains("s", "z") | F.contains("z", "s")).select(*pair)
    ends = lambda c: F.explode(F.array_distinct(F.array(F.concat(F.lit("<"), F.left(c, F.lit(least))), F.concat(F.right(c, F.lit(least)), F.lit(">")))))
    near = a.withColumn("k", ends(F.col("s"))).join(f.withColumn("k", ends(F.col("z"))), [group, "k"]).where(F.levenshtein("s", "z") <= close * F.greatest(F.length("s"), F.length("z"))).select(*pair)
    x = same.withColumn("t", F.lit(1)).unionByName(by_part.withColumn("t", F.lit(2))).unionByName(near.withColumn("t", F.lit(3))).where("asked <> path")
    x = x.groupBy(group, "asked", "path", "s", "z").agg(F.min("t").alias("t"))
    x = top_per_group(x.withColumn("edits", F.levenshtein("s", "z")), [group, "asked"], [F.col("t"), F.col("edits"), F.col("path")], n)
    return x.select(group, "asked", F.element_at(F.array(F.lit("stem"), F.lit("part"), F.lit("close")), F.col("t")).alias("tier"), "path", F.col("rank").cast("long").alias("rank"))
