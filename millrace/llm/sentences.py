"""Problem 1: sentence boundaries across languages and scripts.

Candidates are runs of end marks with the quotes and brackets that close after them (a lone full stop only before white
space, a closing sign or the end) and, in text of unspaced scripts without any stops, line breaks, spaces or the final
particles of classical prose. Each is classified by a maximum-entropy model over the neighbouring tokens, their case,
length, digits and script, the kind of mark, whether a quotation or bracket holds or closes it, what follows, and how
often stops after this token stand at the end of a paragraph. Blank lines and the end of a value end sentences by
definition.

The model is trained on the table's own reliable boundaries. Ends are the marks that end values and paragraphs; their
right side, which says nothing there, is replaced by what may follow a sentence in that script. No ends are marks before
a lower-case word, a digit, a comma, a dash or a reporting clause, and those inside a quotation or bracket; stops among
them are learnt a second time with an upper-case word on the right, so that the token before has to tell. A usual
abbreviation, a single letter and a number after a certain word are features like all others. It is fitted on the values of at
most ``SAMPLE`` rows, those least by a hash of their id; every value is segmented, whole, in time linear in its length.

Null and empty values, and those of white space only, have no sentences. Rows delivered again count once; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 20000
DIMS, STEPS = 1 << 15, 500
# usual abbreviations, in lower case, without their last stop: one feature of the model
ABBREVIATIONS = frozenset(
    "dr dra prof mr mrs ms sr sra srta st jr mt rev gen col capt lt hon messrs mme mlle "
    "e.g i.e cf vs approx etc. vol fig figs sec no nos pp p ch eq ed eds al dept inc ltd co corp est ca viz resp "
    "z d b u h bzw vgl usw ggf evtl nr abs kap hrsg abb tab bd "
    "pág págs núm art cap fig ud uds ee uu "
    "т е д п к г стр рис табл гл им ул "
    "डॉ श्री पं प्रो सं "
    "jan feb mar apr jun jul aug sep sept oct nov dec".split()
)
OPENING, CLOSING = "“‘«「『(（[【{《〈„‹", "”’»」』)）]】}》〉“›"
_PAIRS = {"“": "”", "«": "»", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "【": "】", "《": "》", "〈": "〉", "„": "“", "‹": "›", '"': '"', "{": "}"}
_QUOTE_OR_BRACKET = re.compile(r"[“”«»「」『』()（）\[\]【】《》〈〉„‹›\"{}]")
_MARKS = re.compile(r"[.。．!！?？؟।॥…‽⁇⁈⁉]+")
_WIDE = frozenset("。．！？؟।॥!?‽⁇⁈⁉")
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_UNSPACED = re.compile(r"[\u2e80-\u2fdf\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]")
_LETTER = re.compile(r"[^\W\d_]")
_PARTICLES = re.compile(r"[也矣哉焉乎耳]+")
_HAN_SAYS = re.compile(r"[\u4e00-\u9fff]{0,8}?[曰说說道问問答言叹嘆写寫](?:道|着|著|了)?(?=[，。,！？!?\n]|$)")
_KANA = re.compile(r"[\u3040-\u309f]")
_ID = re.compile(r"\w+$")


def closed_spans(text: str) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Outermost quotations and brackets as (open, close), matched within paragraphs; and close -> open."""
    spans: list[tuple[int, int]] = []
    at = 0
    for part in [*_BLANK.finditer(text), None]:
        end = part.start() if part else len(text)
        stack: list[tuple[str, int]] = []
        found: list[tuple[int, int]] = []
        for m in _QUOTE_OR_BRACKET.finditer(text, at, end):
            c, i = m[0], m.start()
            hit = next((k for k in range(len(stack) - 1, -1, -1) if _PAIRS[stack[k][0]] == c), -1)
            if hit >= 0:
                found.append((stack[hit][1], i))
                del stack[hit:]
            elif c in _PAIRS:
                stack.append((c, i))
        last = -1
        for a, b in sorted(found, key=lambda x: (x[0], -x[1])):
            if b > last:
                spans.append((a, b))
                last = b
        at = part.end() if part else end
    return spans, {b: a for a, b in spans}


def _token_before(text: str, i: int) -> str:
    j = i
    while j > 0 and not text[j - 1].isspace() and text[j - 1] not in "“”«»「」『』()（）[]《》\"„,;:，；：、。！？!?¿¡":
        j -= 1
    return text[j:i]


class Candidate(NamedTuple):
    """A possible end: its place, its features, and what the text around says for sure (1, 0 or None)."""

    end: int
    left: tuple[str, ...]
    right: tuple[str, ...]  # what follows: one entry, or all that may follow where nothing does
    key: str | None  # the token before a stop, or the word before a number
    sure: int | None


def _token_at(text: str, i: int) -> tuple[str, str]:
    """The token before ``i`` and the one before it."""
    own = _token_before(text, i)
    j = i - len(own)
    while j > 0 and text[j - 1].isspace():
        j -= 1
    return own, _token_before(text, j)


_SHAPES = ((re.compile(r"[\d.,%]+$"), "num"), (re.compile(r"\W*\w*\d"), "dig"), (re.compile(r"\w(?:\.\w)+$"), "dotted"), (re.compile(r"\w+_"), "id"))


def _left(text: str, i: int) -> tuple[tuple[str, ...], str]:
    """Features of the token before the stop at ``i`` and the key of its statistics."""
    own, prev = _token_at(text, i)
    low, prev = own.lower(), prev.lower()
    shape = next((name for p, name in _SHAPES if p.match(own)), "word")
    script = "lat" if re.search(r"[A-Za-zÀ-ɏ]", own) else "cyr" if re.search(r"[а-яА-Я]", own) else "num" if shape == "num" else "oth"
    case = "A" if own[:1].isupper() else "a" if own[:1].islower() else "-"
    size = str(min(len(own), 6))
    before = "#" if re.search(r"\d", prev) else prev[-12:]
    key = f"{before} #" if shape == "num" else f"# {low}" if before == "#" and len(own) == 1 and case == "a" else low
    listed = low in ABBREVIATIONS or "." in low and low.rstrip(".") in ABBREVIATIONS
    told = (f"key={key}", f"shape={shape}", f"size={size}{case}", f"script={script}|{size}", f"prev={before}", f"{shape}|{size}", f"{size}{case}|{before == '#'}")
    return (*told, "listed") if listed else told, key


def _follows(text: str, k: int) -> tuple[str, bool]:
    """What stands after ``k``, white space aside, and whether a paragraph ends there."""
    n, j = len(text), k
    while j < n and text[j].isspace():
        j += 1
    if j >= n or _BLANK.match(text, k):
        return "end", True
    c = text[j]
    gap = "" if j == k else " "
    if c in ",，、;；:：":
        return "comma", False
    if c in "–—-‐‑‒―·":
        return "dash", False
    if _HAN_SAYS.match(text, j):
        return "says", False
    kind = "kana" if _KANA.match(c) else "low" if c.islower() else "up" if c.isupper() else "dig" if c.isdigit() else "open" if c in OPENING or c in '"¿¡' else "cjk" if _UNSPACED.match(c) else "letter" if c.isalpha() else "other"
    return kind + gap, False


_NO_END = ("comma", "dash", "says", "low ", "low", "kana", "kana ")


def candidates(text: str) -> Iterator[Candidate]:
    n, last = len(text), len(text.rstrip())
    spans, opened = closed_spans(text)
    opens = {a for a, _ in spans}
    inside = bytearray(n + 1)
    for a, b in spans:
        inside[a : b + 1] = b"\x01" * (b + 1 - a)
    stops = False
    for m in _MARKS.finditer(text):
        i, j, marks = m.start(), m.end(), m[0]
        dot = marks == "."
        if dot and j < n and not text[j].isspace() and text[j] not in CLOSING and text[j] != '"':
            continue  # within a number, a file name or an abbreviation
        stops = True
        kind = "dot" if dot else "dots" if not set(marks) & _WIDE else "mark"
        k, state = j, "out"
        if inside[i]:
            while k < n and k not in opened and (text[k] in CLOSING or text[k] == '"'):
                k += 1
            if k >= n or k not in opened or opened[k] > i:
                yield Candidate(j, (f"{kind}|in",), ("any",), None, 0)
                continue
            o, shut = opened[k], k
            k += 1
            while k < n and text[k] in CLOSING and not inside[k] and k not in opens:
                k += 1
            if k < n and _MARKS.match(text, k):
                continue  # the end mark outside is a candidate of its own
            state = "bracket" if text[shut] in ")]）】" else "quote"
            if state == "bracket" and o and text[o - 1].isalnum() and text[k : k + 1].isalnum():
                state = "word"  # a bracket within a word group
        else:
            while k < n and (text[k] in CLOSING or text[k] == '"') and k not in opens and (text[k] not in '"“' or k in opened):
                k += 1
        follow, over = _follows(text, k)
        left: tuple[str, ...] = (f"{kind}|{state}",)
        key = None
        if dot and state != "bracket":
            told, key = _left(text, i)
            left += told
        sure = None
        if over:
            # what ends a paragraph shows a boundary, unless a bracket holds it: then the paragraph's end alone does
            sure = None if state in ("bracket", "word") and kind != "mark" else 1
        elif state == "out" and kind == "mark":
            sure = None
        elif follow in _NO_END or follow.startswith("dig") and dot or kind == "dots" and not follow.endswith(" ") or state == "word":
            sure = 0
        if over:
            cjk = i > 0 and _UNSPACED.match(text[i - 1]) is not None
            right: tuple[str, ...] = ("cjk", "open", "letter", "up", "cjk ", "open ", "up ") if cjk else ("up ", "open ", "letter ", "other ", "cjk ")
            if kind == "mark" and state == "out":
                right += ("low ", "low", "dig ", "dig", "other", "comma", "dash", "kana", "up", "says")
        else:
            right = (follow,)
        yield Candidate(k, left, right, key, sure)
    if not stops and _unspaced(text):
        parts = [(m.start(), m.end(), "\n" in m[0]) for m in re.finditer(r"\s+", text[:last])]
        for a, b, broken in parts:
            number = text[a - 1 : a].isdigit() or text[b : b + 1].isdigit() or bool(inside[a])
            yield Candidate(a, ("break" if broken else "space",), ("number" if number else "none",), None, 1 if broken or not number else 0)
        if all(not broken and (text[a - 1 : a].isdigit() or text[b : b + 1].isdigit() or inside[a]) for a, b, broken in parts):
            for m in _PARTICLES.finditer(text):
                yield Candidate(m.end(), ("particle",), ("none",), None, 1 if m.end() == last else None)


class Model(NamedTuple):
    weights: np.ndarray
    ends: dict[str, tuple[int, int]]  # stops after a token: all, and those at the end of a paragraph
    share: float


def _rate(n: int, e: int, share: float) -> int:
    """How many doublings the stops of a token stay below the usual share at the ends of paragraphs; 0 if they don't."""
    return max(0, min(6, int(np.log2((n * share + 1) / (e + 0.5)))))


_OWN = ("key=", "prev=", "listed")
_SHORT = tuple(f"{n}{case}" for n in range(1, 5) for case in "Aa-")


def _names(left: tuple[str, ...], right: str, rate: int | None, known: bool = True) -> list[str]:
    """The features of a candidate; without those that name its tokens, if they are not ``known``."""
    if not known:
        return [x for x in _names(left, right, rate) if not x.startswith(_OWN)]
    out = [*left, f"{left[0]}|{right}", f"then={right}", "bias"]
    if rate is not None:
        short = left[3][5:] in _SHORT  # abbreviations are short
        out += [f"rarely ends>={k}{s}" for k in range(1, rate + 1) for s in ("", "|short")[: 1 + short]] + [f"{left[2]}|{right}", f"{left[3]}|{right}"]
    return out


def _index(features: list[str]) -> list[int]:
    return [zlib.crc32(f.encode()) % DIMS for f in features]


def train(texts: list[str], steps: int = STEPS, rate: float = 0.3, decay: float = 2e-6) -> Model:
    """The maximum-entropy (logistic) model, fitted on all reliable candidates by accelerated gradient steps."""
    found = [c for t in texts for c in candidates(t)]
    n = Counter(c.key for c in found if c.key is not None)
    e = Counter(c.key for c in found if c.key is not None and c.sure == 1 and len(c.right) > 1)
    share = (sum(e.values()) + 1) / (sum(n.values()) + 2)
    data: Counter = Counter()
    for c in found:
        if c.sure is None:
            continue
        at_end = c.sure == 1 and len(c.right) > 1
        told = None if c.key is None else _rate(n[c.key] - 1, e[c.key] - at_end, share)  # without this one
        for right in c.right if c.sure or c.key is None else (*c.right, "up "):
            for known in (True, False) if c.key is not None else (True,):  # the model has to do without the names too
                data[tuple(_index(_names(c.left, right, told, known))), c.sure] += 1 / len(c.right)
    w = np.zeros(DIMS)
    if data:
        f = np.array([i for (x, _), _ in data.items() for i in x])
        row = np.repeat(np.arange(len(data)), [len(x) for x, _ in data])
        y, many = np.array([y for _, y in data], float), np.sqrt(np.fromiter(data.values(), float))
        many /= many.sum()
        ahead = w
        for k in range(steps):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(row, ahead[f], minlength=len(y)), -30, 30)))
            new = ahead + rate * (np.bincount(f, (many * (y - p))[row], minlength=DIMS) - decay * ahead)
            w, ahead = new, new + k / (k + 3) * (new - w)
    return Model(w.astype(np.float32), {k: (n[k], e[k]) for k in n}, share)


def sentence_ends(text: str, model: Model) -> list[int]:
    """Ends of the sentences of a value, in code points."""
    last = len(text.rstrip())
    if not last:
        return []
    w = model.weights
    ends = {last}
    for m in _BLANK.finditer(text):
        a = m.start()
        while a > 0 and text[a - 1].isspace():
            a -= 1
        ends.add(a)
    for c in candidates(text):
        if len(c.right) > 1:
            continue  # the end of a paragraph
        told = None if c.key is None else _rate(*model.ends.get(c.key, (0, 0)), model.share)
        if w[_index(_names(c.left, c.right[0], told))].sum() > 0:
            ends.add(c.end)
    first = len(text) - len(text.lstrip())
    return sorted(x for x in ends if x > first)


def _unspaced(text: str) -> bool:
    letters = _LETTER.findall(text)
    return bool(letters) and 2 * len(_UNSPACED.findall(text)) > len(letters)


def fit(df: DataFrame, id_col: str, text_cols: list[str], sample: int = SAMPLE) -> Model:
    """The model of a table, from the values of at most ``sample`` ids, the least by hash."""
    rows = df.select(F.col(id_col).alias("id"), *text_cols).orderBy(F.xxhash64(F.col(id_col)), F.col(id_col), *text_cols).limit(sample).collect()
    seen = {t for r in rows for t in r[1:] if t and t.strip()}
    return train(sorted(seen))


def sentences(df: DataFrame, id_col: str, text_cols: list[str], sample: int = SAMPLE) -> DataFrame:
    """(id, field, end_pos): one row per sentence of each non-empty value of ``text_cols``."""
    told = df.sparkSession.sparkContext.broadcast(fit(df, id_col, text_cols, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = told.value
        for batch in batches:
            ids, fields, ends = [], [], []
            for k, name in enumerate(text_cols, 1):
                for i, t in zip(batch.column(0).to_pylist(), batch.column(k).to_pylist()):
                    if t:
                        e = sentence_ends(t, model)
                        ids += [i] * len(e)
                        fields += [name] * len(e)
                        ends += e
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fields, pa.string()), pa.array(ends, pa.int32())], names=["id", "field", "end_pos"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).cast("string") for c in text_cols])
    return rows.mapInArrow(run, "id long, field string, end_pos int").distinct()
