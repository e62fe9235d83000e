"""Problem 9: text cut off by field limits or broken transfers.

A corpus shows itself how whole texts end: every paragraph, heading or list entry that something follows is whole. One
pass over all texts counts the tokens of the corpus (a run of letters of a spaced script, one character of an unspaced
one or a run of digits, each with the marks after it), how often each stands at such a whole end, and in what class of
ends it falls. The tokens with their counts are the vocabulary trie: a cut at a random place leaves the token T as often
as the words beyond the trie's node T occur, a whole text as often as T stands at whole ends. So the final token of a
text weighs

    log P(class | cut) / P(class | whole)  +  log (ends expected of T's node in its class + 1) / (ends of T seen + 1)

An unknown proper prefix of known words gets a high second term (many words beyond, no ends), and so do stops of
abbreviations and the first words of list entries; a token that ends entries gets a low one. To that come the prior
``PRIOR``, an open quotation or bracket (how often whole paragraphs and their first parts leave one open) and the length:
far more different texts of the source with this length than with lengths near it. Length tells that a text was cut, not
that it broke inside a sentence, so it adds at most ``MOST_LENGTH``. An open code block and a broken code point are cut
whatever they end with. A bracketed or dotted sign at the very end is taken off and the rest is judged, as cuts are often marked.

A last paragraph of one line that recurs is a closing line: the whole last paragraph of one in ``SHARE`` different texts
of a source or of all, at least ``LEAST``, and of half as many as have a longer one with that beginning. Copies of a text
count once there and in the lengths.

All statistics stay in tables, of whole texts, and are joined; nothing of the corpus goes to the driver but the distinct
lengths of closing lines. Null, empty and blank texts are not truncated. Extra columns are ignored; an empty table gives
an empty result; a text of any length is judged whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import maybe_broadcast
from millrace.session import stage

LEAST, SHARE = 3, 500
PRIOR, MOST_LENGTH, SMOOTH = -2.2, 3.0, 1.0
_UNSPACED = "⺀-⿟々-〇぀-ヿ㐀-䶿一-鿿豈-﫿฀-໿က-႟ក-៿"
_TOKEN = re.compile(rf"(?:[{_UNSPACED}]|_?[^\W\d_{_UNSPACED}]+|_?0|_+)[^\w\s]*|[^\w\s]+")
_DIGITS = re.compile(r"\d+")
_BLANK = re.compile(r"\n[^\S\n]*(?=\n)")
_FENCE = re.compile(r"^[ ]{0,3}(?:```|~~~)[^\n]*$", re.M)
_ENTRY = re.compile(r"^[^\S\n]*(?:([-*•+]|\d+[.)])|#{1,6})(?:[^\S\n]+([^\n]*))?$", re.M)
_MARKED = re.compile(r"\s*(?:…|\.\.\.|[\[(（<【][^\[\](（）)<>【】\n]{1,16}[\])）>】])$")
_OPENS, _SHUTS = "「『（(《«“„[【", "」』）)》»”“]】"
_STATS = "kind string, token string, class string, n long, k long"
_ENDS = "id long, source string, length int, digest long, kind string, token string, class string, line string, state string, open boolean"


def last_paragraph(text: str) -> str:
    """The text after the last blank line, whatever its length."""
    t = text.rstrip()
    end = t.rfind("\n")
    while end >= 0:
        start = t.rfind("\n", 0, end)
        if start >= 0 and not t[start + 1 : end].strip():
            return t[end + 1 :]
        end = start
    return t


def _plain(text: str) -> str:
    return _DIGITS.sub("0", text).lower()


def last_token(line: str) -> str:
    """The final token of a line in plain form, with the marks after it."""
    found = ""
    for m in _TOKEN.finditer(line, max(0, line.rfind(" ") + 1)):
        found = m[0]
    return found


def token_class(token: str) -> str:
    """What kind of characters a token has, and the marks after it."""
    head = token[:2].lstrip("_")[:1]
    marks = re.sub(r"^[\w]+", "", token)
    letter = "" if not head or not (head.isalnum()) else "0" if head == "0" else "c" if re.match(f"[{_UNSPACED}]", head) else "a"
    return letter + marks[:1] + marks[-1:]


def left_open(p: str) -> bool:
    """Whether a paragraph leaves a quotation or bracket open."""
    last: dict[str, int] = {}
    for i, (a, b) in enumerate(zip(_OPENS, _SHUTS)):
        if a == "“" and "„" in p:
            continue  # there it closes
        k = p.rfind(a)
        if k >= 0 and p.find(b, k + 1) < 0:
            return True
    return p.count('"') % 2 == 1


def _parts(text: str) -> tuple[list[str], bool]:
    """The text outside of code blocks, and whether the last one is open."""
    if "```" not in text and "~~~" not in text:
        return [text], False
    parts = _FENCE.split(text)
    return parts[::2], len(parts) % 2 == 0


def statistics(df: DataFrame, text_col: str) -> DataFrame:
    """(kind, token, class, n, k) over the corpus: how often each token stands in prose (p), list entries (l) and headings
    (h; a first line that a blank one follows is one), and how often at a whole end there. Kind ``o`` counts paragraphs: whole ones and, under the token ``cut``, their
    first parts up to a place that their digest draws; k of them leave a quotation or bracket open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {"p": Counter(), "l": Counter(), "h": Counter()}
            ends: dict[str, Counter] = {"p": Counter(), "l": Counter(), "h": Counter()}
            opened, whole = Counter(), 0
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                parts, _ = _parts(text.rstrip())
                for at, part in enumerate(parts):
                    final = at == len(parts) - 1
                    part = _plain(part)
                    prose, cut = [], 0
                    for m in _ENTRY.finditer(part):
                        prose.append(part[cut : m.start()])
                        cut = m.end()
                        kind = "l" if m[1] else "h"
                        tokens = _TOKEN.findall(m[2] or "")
                        seen[kind].update(tokens)
                        if tokens and not (final and m.end() == len(part)):
                            ends[kind][tokens[-1]] += 1
                    prose.append(part[cut:])
                    for k, run_of in enumerate(prose):
                        if not run_of.strip():
                            continue
                        paragraphs = [p for p in _BLANK.split(run_of) if p.strip()]
                        rest = final and k == len(prose) - 1
                        if at == k == 0 and "\n" not in paragraphs[0].strip() and len(paragraphs) > rest:
                            tokens = _TOKEN.findall(paragraphs.pop(0))
                            seen["h"].update(tokens)
                            ends["h"].update(tokens[-1:])
                        for p in paragraphs:
                            seen["p"].update(_TOKEN.findall(p))
                        if rest:
                            paragraphs.pop()
                        for p in paragraphs:
                            p = p.strip()
                            ends["p"][last_token(p)] += 1
                            whole += 1
                            opened["whole"] += left_open(p)
                            opened["cut"] += left_open(p[: xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass")) % len(p) + 1])
            rows = [(kind, t, token_class(t), n, ends[kind][t]) for kind, c in seen.items() for t, n in c.items()]
            rows += [("o", w, "", whole, opened[w]) for w in ("whole", "cut")]
            cols = list(zip(*rows))
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["kind", "token", "class", "n", "k"])

    x = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, _STATS)
    return x.groupBy("kind", "token", "class").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))


def end_of(text: str) -> tuple[str, str, str, str | None, str, bool]:
    """(kind, token, class, line, state, open) of a text's end: ``line`` is its last paragraph if that is one line, ``state``
    is ``code`` in an open code block (kind ``c``; ``b`` after a closed one), ``transfer`` after a broken code point, ``marked`` if a sign was taken off, else ``end``."""
    t = text.rstrip()
    parts, inside = _parts(t)
    if inside:
        return "c", "", "", None, "code", False
    state = "end"
    if t.endswith("�"):
        state = "transfer"
    p = last_paragraph(t)
    last = t[t.rfind("\n") + 1 :]
    if not parts[-1].strip():  # a closed code block is a whole end
        return "b", "", "", None, state, False
    m = _ENTRY.fullmatch(last)
    kind = "p" if not m else "l" if m[1] else "h"
    line = _plain(last.strip()) if "\n" not in p and kind == "p" else None
    while kind == "p" and (sign := _MARKED.search(last)) and sign.start():
        last, state = last[: sign.start()], "marked"
    token = last_token(_plain(m[2] or "" if m else last).rstrip())
    return kind, token, token_class(token), line, state, left_open(p) if kind == "p" else False


def ends(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per text that is not blank with what its end shows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 5, pa.bool_())
        for batch in batches:
            rows = []
            for i, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text and text.strip():
                    rows.append((i, source, len(text), xxhash.xxh64_intdigest(text.strip().encode("utf-8", "surrogatepass")) - (1 << 63), *end_of(text)))
            cols = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in _ENDS.split(", ")])

    return df.select(F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, _ENDS)


def closing_lines(of: DataFrame) -> DataFrame:
    """(line) of the closing lines among the ends of the different texts, see above."""
    last = of.where(F.col("line").isNotNull()).select("source", "line", "digest").distinct()
    texts = of.select("source", "digest").distinct().groupBy(F.col("source").alias("of")).agg(F.count("*").alias("texts"))
    own = last.groupBy("source", "line").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    own = own.join(maybe_broadcast(texts), F.col("source").eqNullSafe(F.col("of"))).where(F.col("n") * SHARE >= F.col("texts")).select("line").distinct()
    # a text that several sources have is one text of all
    by_line = stage(last.select("line", "digest").distinct().groupBy("line").agg(F.count("*").alias("n")), "lines")
    total = of.select("digest").distinct().count()
    found = stage(by_line.where(F.col("n") >= LEAST).join(own.withColumn("own", F.lit(True)), "line", "left").where(F.col("own") | (F.col("n") * SHARE >= total)).select("line", "n"), "closing")
    lengths = sorted(r[0] for r in found.select(F.length("line")).distinct().collect())
    if not lengths:
        return found.select("line")
    starts = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda x: x < F.length("line")), lambda x: F.substring("line", F.lit(1), x))
    longer = by_line.select("n", F.explode(starts).alias("line")).join(found.select("line"), "line", "left_semi").groupBy("line").agg(F.sum("n").alias("beyond"))
    return found.join(longer, "line", "left").where(F.col("n") * 2 >= F.coalesce("beyond", F.lit(0))).select("line")


def _log(a: Column, b: Column) -> Column:
    return F.log((a + SMOOTH) / (b + SMOOTH))


def judged(df: DataFrame, id_col: str, text_col: str, source_col: str, use: tuple[str, ...] = ("trie", "length", "closing", "open")) -> DataFrame:
    """(id, source, cut, score): every text with how it was cut, null for a whole one. ``use`` names the evidence to take in."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    stats = stage(statistics(rows, "text"), "tokens")
    of = stage(ends(rows, "id", "text", "source"), "ends")
    tokens = stats.where("kind <> 'o'")
    classes = tokens.groupBy("kind", "class").agg(F.sum("n").alias("class_n"), F.sum("k").alias("class_k"))
    whole = tokens.groupBy("kind").agg(F.sum(F.length("token") * F.col("n")).alias("all_n"), F.sum("k").alias("all_k"))
    # a class is left by a cut at any character of its tokens that ends in it: at letters its tokens bare, at marks with them
    letters = tokens.select("kind", F.regexp_extract("token", r"^_?[\p{L}\p{M}\p{N}_]+", 0).alias("head"), "n")
    bare = letters.select("kind", F.when(F.col("head") == "", "").when(F.col("head").rlike("^_?0"), "0").when(F.col("head").rlike(f"^[{_UNSPACED}]"), "c").otherwise("a").alias("class"), (F.length("head") * F.col("n")).alias("n"))
    places = bare.groupBy("kind", "class").agg(F.sum("n").alias("places"))
    classes = classes.join(places, ["kind", "class"], "left").join(whole, "kind")
    cut_n = F.coalesce("places", "class_n")
    classes = classes.select("kind", "class", "class_n", "class_k", (F.log((cut_n + SMOOTH) / F.col("all_n")) - F.log((F.col("class_k") + SMOOTH) / (F.col("all_k") + SMOOTH))).alias("by_class"))
    wanted = of.select("kind", "token").distinct()
    # the trie's nodes that ends ask for: the words beyond each prefix
    nodes = tokens.select("kind", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("token")), lambda i: F.substring("token", F.lit(1), i))).alias("token"))
    nodes = nodes.where("token <> ''").join(maybe_broadcast(wanted), ["kind", "token"], "left_semi").groupBy("kind", "token").agg(F.sum("n").alias("node"))
    known = wanted.join(nodes, ["kind", "token"], "left").join(tokens.select("kind", "token", F.col("k").alias("ends")), ["kind", "token"], "left")
    known = stage(known, "known")  # a row for each final token
    y = of.join(maybe_broadcast(known), ["kind", "token"]).join(F.broadcast(classes), ["kind", "class"], "left")  # a class is a letter and two marks
    expected = F.coalesce("node", F.lit(0)) * F.col("class_k") / F.col("class_n")
    by_token = _log(F.coalesce(expected, F.lit(0.0)), F.coalesce("ends", F.lit(0)))
    score = F.lit(PRIOR) + F.coalesce("by_class", F.lit(0.0))
    if "trie" in use:
        score = score + by_token
    if "length" in use:
        # every text adds to the lengths within 20 of its own, so no window holds a source
        sizes = of.select("source", "length", "digest").distinct().groupBy("source", "length").agg(F.count("*").alias("same"))
        around = sizes.select("source", F.explode(F.sequence(F.col("length") - 20, F.col("length") + 20)).alias("length"), "same").groupBy("source", "length").agg(F.sum("same").alias("near"))
        piled = sizes.join(around, ["source", "length"]).select(F.col("source").alias("of_source"), F.col("length").alias("of_length"), F.least(F.lit(MOST_LENGTH), F.greatest(F.lit(0.0), F.log((F.col("same") + 1) / ((F.col("near") - F.col("same")) / 40 + 1)))).alias("by_length"))
        piled = stage(piled.where("by_length > 0"), "lengths")
        y = y.join(maybe_broadcast(piled), F.col("source").eqNullSafe(F.col("of_source")) & (F.col("length") == F.col("of_length")), "left")
        score = score + F.coalesce("by_length", F.lit(0.0))
    if "open" in use:
        o = stats.where("kind = 'o'").groupBy().agg(*[F.sum(F.when(F.col("token") == w, F.col(c))).alias(f"{w}_{c}") for w in ("whole", "cut") for c in ("n", "k")])
        y = y.crossJoin(F.broadcast(o))  # one row
        rate = lambda w: (F.coalesce(f"{w}_k", F.lit(0)) + SMOOTH) / (F.coalesce(f"{w}_n", F.lit(0)) + 2 * SMOOTH)
        score = score + F.when(F.col("open"), F.log(rate("cut") / rate("whole"))).otherwise(F.log((1 - rate("cut")) / (1 - rate("whole"))))
    if "closing" in use:
        closing = stage(closing_lines(of), "closing")
        y = y.join(maybe_broadcast(closing.withColumn("closes", F.lit(True))), "line", "left")
        score = F.when(F.col("closes"), F.lit(-9.0)).otherwise(score)
    y = y.withColumn("score", F.when(F.col("kind") == "b", F.lit(-9.0)).otherwise(score))
    how = F.when(F.col("kind") == "l", "list").when(F.col("state") == "marked", "marked").when(F.col("open"), "open").when(F.coalesce("by_length", F.lit(0.0)) >= MOST_LENGTH, "limit") if "length" in use else F.when(F.col("kind") == "l", "list")
    how = how.when((F.coalesce("node", F.lit(0)) > 0) & (F.coalesce("ends", F.lit(0)) == 0), "word").otherwise("sentence")
    return y.select("id", "source", F.when(F.col("state").isin("code", "transfer"), F.col("state")).when(F.col("score") > 0, how).alias("cut"), "score")


def rates(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Per source: texts (blank and null ones too), truncated ones and their share."""
    texts = df.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("texts"))
    cut = judged(df, id_col, text_col, source_col).groupBy(F.col("source").alias("of")).agg(F.count("cut").alias("truncated"))
    x = texts.join(cut, F.col("source").eqNullSafe(F.col("of")), "left").select("source", "texts", F.coalesce("truncated", F.lit(0)).alias("truncated"))
    return x.withColumn("truncated_rate", F.round(F.col("truncated") / F.col("texts"), 6))
