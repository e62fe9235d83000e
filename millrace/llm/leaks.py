"""Problem 8: evaluation texts leaking into training text.

The test items make a BM25 inverted index: for each term the items that hold it with their impacts, in blocks of
``BLOCK`` postings that know their greatest impact. Every passage of every document is a query against it. Passages are
windows of twice the run length at steps of the run length, so each run of a document lies whole in one. An item's
threshold is the least score of any of its runs, hence no passage with a run of the item falls below it. Items are
numbered by their thresholds, so the threshold of the item at hand holds for all after it. A passage whose terms' maxima
in one of ``RANGES`` ranges of items stay below the range's least threshold is
passed over there; in the other ranges the search is block-max WAND: cursors of the passage's terms move to the pivot, the first item that the terms' maxima can lift over its threshold;
if the maxima of the blocks there cannot, the blocks are skipped; else the item is scored, and one that reaches its
threshold is verified on the words themselves. All above the threshold are retrieved, there is no top k.

Words are compared in compatible form and lower case without punctuation, markup signs and white space; for Chinese items
letters and digits are compared one by one. Null, empty and short texts leak nothing; rows delivered again count once;
extra columns are ignored; documents of any length are taken whole. The size of an index is that of its postings. Items
of more than ``SHARD`` characters in all are indexed in shards of about that size, one at a time on the driver; the
documents are then searched once a shard.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS, CHARS, GRAM, BLOCK, RANGES, SHARD = 15, 24, 3, 16, 128, 8_000_000
K1, B = 1.2, 0.75
_WORD = re.compile(r"[^\W_]+(?:_+[^\W_]+)*")
_HAN = re.compile(r"[㐀-鿿]")


@cache
def _invisible() -> re.Pattern:
    return re.compile("[" + "".join(chr(c) for c in range(0x80, 0xE0080) if unicodedata.category(chr(c)) == "Cf") + "]")


def plain(text: str) -> str:
    """Compatible form, lower case, without invisible characters."""
    if text.isascii():
        return text.lower()
    return _invisible().sub("", unicodedata.normalize("NFKC", text).lower())


def word_terms(text: str) -> list[str]:
    return _WORD.findall(text)


def char_terms(text: str) -> list[str]:
    """The runs of ``GRAM`` letters and digits."""
    c = "".join(filter(str.isalnum, text))
    return [c[i : i + GRAM] for i in range(len(c) - GRAM + 1)]


class Index:
    """An inverted index of items over terms, in blocks with maxima; ``run`` terms in a row are a leak."""

    def __init__(self, items: list[tuple[int, list[str]]], run: int):
        self.run = run
        items = [(i, t) for i, t in items if len(t) >= run]
        df = Counter(t for _, terms in items for t in set(terms))
        self.term_ids = {t: k for k, t in enumerate(sorted(df))}
        mean = sum(len(t) for _, t in items) / max(1, len(items))
        rows = []
        for i, terms in items:
            weight = {}
            for t, tf in Counter(terms).items():
                idf = math.log(1 + (len(items) - df[t] + 0.5) / (df[t] + 0.5))
                weight[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(terms) / mean))
            x = np.concatenate([[0], np.cumsum([weight[t] for t in terms])])
            limit = float((x[run:] - x[:-run]).min()) * (1 - 1e-5) - 1e-4
            rows.append((limit, i, np.array([self.term_ids[t] for t in terms], np.int32).tobytes(), weight))
        rows.sort(key=lambda r: r[:3])
        self.limit, self.ids, self.texts = [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]
        found: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for k, (*_, weight) in enumerate(rows):
            for t, x in weight.items():
                found[self.term_ids[t]].append((k, x))
        # postings of term t: items and impacts, and per block the last item and the greatest impact
        self.items = [[k for k, _ in found[t]] for t in range(len(self.term_ids))]
        self.impacts = [[x for _, x in found[t]] for t in range(len(self.term_ids))]
        self.lasts = [p[BLOCK - 1 : -1 : BLOCK] + p[-1:] for p in self.items]
        self.maxima = [[max(p[a : a + BLOCK]) for a in range(0, len(p), BLOCK)] for p in self.impacts]
        self.top = np.array([max(m) for m in self.maxima])
        # ranges of items: per term the ranges that hold it with the greatest impact in each, and the least threshold of a range
        self.span = max(1, -(-len(rows) // RANGES))
        self.least = np.array(self.limit[:: self.span])
        ranges = [{} for _ in self.items]
        for r, held, impacts in zip(ranges, self.items, self.impacts):
            for k, x in zip(held, impacts):
                r[k // self.span] = max(x, r.get(k // self.span, 0.0))
        self.first = np.cumsum([0, *map(len, ranges), 0])
        self.range_of, self.range_top = np.array([k for r in ranges for k in r], np.int64), np.array([x for r in ranges for x in r.values()])

    def search(self, terms: list[str]) -> set[int]:
        """The items of which the terms hold a run."""
        run, found = self.run, set()
        if len(terms) < run or not self.ids:
            return found
        none, get = len(self.term_ids), self.term_ids.get
        q = np.fromiter((get(t, none) for t in terms), np.int32, len(terms))
        # bounds of all passages in all ranges: a place lies in the passage that starts at or before it and in the one before
        many = self.first[q + 1] - self.first[q]
        place = np.repeat(np.arange(len(q)), many)
        at = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.first[q], many)
        passages = max(1, -(-(len(q) - run + 1) // run))
        in_range, own = self.range_of[at], place // run
        bound = np.zeros(len(self.least) * passages)
        for w in (own, own - 1):
            ok = (w >= 0) & (w < passages)
            bound += np.bincount(in_range[ok] * passages + w[ok], self.range_top[at[ok]], len(bound))
        for w, r in np.argwhere((bound.reshape(len(self.least), passages) >= self.least[:, None]).T).tolist():
            passage = q[w * run : w * run + 2 * run]
            for k in self.retrieve(Counter(t for t in passage.tolist() if t != none), r * self.span, (r + 1) * self.span):
                if self.ids[k] not in found and any(self._holds(k, passage[i : i + run].tobytes()) for i in range(len(passage) - run + 1)):
                    found.add(self.ids[k])
        return found

    def _holds(self, item: int, run: bytes) -> bool:
        text = self.texts[item]
        at = text.find(run)
        while at >= 0 and at % 4:
            at = text.find(run, at + 1)
        return at >= 0

    def retrieve(self, query: dict[int, int], low: int = 0, size: int | None = None) -> Iterator[int]:
        """The numbers in low..size of all items whose score reaches their threshold, by block-max WAND."""
        limit, items, impacts, lasts, maxima = self.limit, self.items, self.impacts, self.lasts, self.maxima
        size = len(self.ids) if size is None else min(size, len(self.ids))
        cursors = []  # item, place, term, count, bound
        for t, c in query.items():
            at = bisect_left(items[t], low)
            if at < len(items[t]) and items[t][at] < size:
                cursors.append([items[t][at], at, t, c, c * float(self.top[t])])
        while cursors:
            cursors.sort(key=lambda x: x[0])
            bound, pivot = 0.0, -1
            for p, c in enumerate(cursors):
                bound += c[4]
                if bound >= limit[cursors[0][0]]:
                    pivot = p
                    break
            if pivot < 0:
                return
            k = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == k:
                pivot += 1
            upper, border = 0.0, size
            for c in cursors[: pivot + 1]:
                b = bisect_left(lasts[c[2]], k, c[1] // BLOCK)
                if b < len(lasts[c[2]]):
                    upper += c[3] * maxima[c[2]][b]
                    border = min(border, lasts[c[2]][b] + 1)
            if upper < limit[k]:  # no item up to the next border of a block, or the next cursor, can reach it
                to = max(k + 1, min(border, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else size))
            elif cursors[0][0] == k:
                if sum(c[3] * impacts[c[2]][c[1]] for c in cursors[: pivot + 1]) >= limit[k]:
                    yield k
                to = k + 1
            else:
                to = k
            for c in cursors[: pivot + 1]:
                if c[0] < to:
                    c[1] = bisect_left(items[c[2]], to, c[1])
                    c[0] = items[c[2]][c[1]] if c[1] < len(items[c[2]]) else size
            cursors = [c for c in cursors if c[0] < size]


def build(items: list[tuple[int, str, str | None]]) -> tuple[Index, Index]:
    """Indexes of the word items and of the Chinese items, from (id, text, lang)."""
    zh = lambda la: (la or "").lower().startswith("zh")
    texts = [(i, plain(t or ""), zh(la)) for i, t, la in items]
    return Index([(i, word_terms(t)) for i, t, z in texts if not z], WORDS), Index([(i, char_terms(t)) for i, t, z in texts if z], CHARS - GRAM + 1)


def leaks(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, item_lang: str) -> DataFrame:
    """(doc_id, item_id): the documents with a passage of a test item."""
    spark = docs.sparkSession
    own = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("t"), F.col(item_lang).cast("string").alias("l")).where(F.col("t") != "")
    shards = max(1, -(-(own.agg(F.sum(F.length("t"))).first()[0] or 0) // SHARD))
    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text")).where(F.col("text").isNotNull())

    def found(shard: int) -> DataFrame:
        rows = own.where(F.pmod(F.xxhash64("i"), F.lit(shards)) == shard).distinct().orderBy("i", "t", "l").collect()
        told = spark.sparkContext.broadcast(build([tuple(r) for r in rows]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, chars = told.value
            for batch in batches:
                ids, hit = [], []
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    t = plain(t)
                    got = words.search(word_terms(t))
                    if chars.ids and _HAN.search(t):
                        got |= chars.search(char_terms(t))
                    ids += [i] * len(got)
                    hit += sorted(got)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hit, pa.int64())], names=["doc_id", "item_id"])

        return x.mapInArrow(run, "doc_id long, item_id long")

    return reduce(DataFrame.unionByName, map(found, range(shards))).distinct()
