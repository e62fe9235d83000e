"""Problem 7: the whole corpus as token ids of a public byte-level BPE, by a streaming transducer.

The transducer reads bytes from left to right. For every prefix of a piece exactly one token can be the last of its
encoding: the one that is compatible with the last token of the prefix before it (two tokens are compatible if encoding
their bytes gives them back). A token that ends beyond the bytes read so far begins where they end in a proper prefix of
a token that the merge list makes: at most ``lookahead`` bytes back, which is computed from the merge list, and of these
places only where the bytes are such a prefix. So what the encodings of the prefixes up to these live places have in
common is stable: it is emitted and forgotten, and the transducer's memory stays constant whatever the length of the input.
Pieces of a text come from an iterator, one at a time. Ids go back to text by an incremental byte-to-text machine.

Null and empty texts give an empty list; strings that spell special tokens are ordinary text; texts are taken whole.
"""

from __future__ import annotations

import base64
import codecs
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: how this vocabulary splits text into pieces before merging
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 250_000
MEMO_BYTES = 64
LONG = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: token bytes and rank, which is the id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """What the transducer needs of a merge list: how each token was made, which pairs merge, and the lookahead."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for b, i in ranks.items():
            made = self._halves(b, i)
            if made:
                self.left[i], self.right[i] = made
                self.pairs[made] = i
            else:
                self.left[i] = self.right[i] = i
        # the longest proper prefix of a token that comes by merging
        self.lookahead = max((len(self.bytes_of[i]) - 1 for i in self.pairs.values()), default=0)
        self.starts: dict = {}
        for i in self.pairs.values():
            node = self.starts
            for c in self.bytes_of[i][:-1]:
                node = node.setdefault(c, {})
        self.ends: dict = {}
        for b, i in ranks.items():
            node = self.ends
            for c in reversed(b):
                node = node.setdefault(c, {})
            node[-1] = i
        self.known: dict[tuple[int, int], bool] = {}

    def _halves(self, b: bytes, own: int) -> tuple[int, int] | None:
        if len(b) < 2:
            return None
        parts = [b[i : i + 1] for i in range(len(b))]
        while len(parts) > 2:
            best, at = own, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], own)
                if r < best:
                    best, at = r, i
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of tokens a and b gives a, b: no merge across their border ever comes first."""
        key = (a, b)
        good = self.known.get(key)
        if good is None:
            good = self._compatible(a, b)
            if len(self.known) < 600_000:
                self.known[key] = good
        return good

    def _compatible(self, a: int, b: int) -> bool:
        # undo the merges of both sides from the last to the first and look across the border at each time;
        # of equal merges the left one comes first
        before = 1 << 62
        while True:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and self.pairs.get((a, b)) == across and across < before:
                return False
            whole_a, whole_b = self.right[a] == a, self.left[b] == b
            if whole_a and whole_b:
                return True
            if not whole_a and (whole_b or a > b):
                before = a
                a = self.right[a]
            else:
                before = b + 1
                b = self.left[b]


class Transducer:
    """Encodes one piece that is fed in parts; ids come out as soon as no later byte can change them."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.window = bytearray()  # bytes since the last emitted token
        self.last: list[int] = [-1]  # last token of each prefix of the window
        self.before: int = -1  # the token emitted before the window

    def feed(self, data: bytes) -> Iterator[int]:
        ends, ok, window, last, limit = self.m.ends, self.m.compatible, self.window, self.last, 2 * self.m.lookahead + 64
        for c in data:
            window.append(c)
            n = len(window)
            node, j, found = ends, n, -1
            while j:
                j -= 1
                node = node.get(window[j])
                if node is None:
                    break
                t = node.get(-1)
                if t is not None:
                    p = last[j] if j else self.before
                    if p == -1 or ok(p, t):
                        found = t
                        break
            last.append(found)
            if n >= limit:
                yield from self._stable()

    def _chain(self, end: int) -> list[int]:
        out = []
        while end > 0:
            t = self.last[end]
            out.append(t)
            end -= len(self.m.bytes_of[t])
        return out[::-1]

    def _live(self) -> list[int]:
        """Where a token that ends later can begin: the ends of the window that are proper prefixes of tokens, and its end."""
        n, out = len(self.window), []
        for at in range(max(0, n - self.m.lookahead), n):
            node = self.m.starts
            for c in self.window[at:]:
                node = node.get(c)
                if node is None:
                    break
            else:
                out.append(at)
        return [*out, n]

    def _stable(self) -> list[int]:
        chains = [self._chain(e) for e in self._live()]
        k = 0
        shortest = min(map(len, chains))
        while k < shortest and all(c[k] == chains[0][k] for c in chains):
            k += 1
        out = chains[0][:k]
        if k:
            cut = sum(len(self.m.bytes_of[t]) for t in out)
            del self.window[:cut]
            del self.last[:cut]
            self.before = out[-1]
            self.last[0] = -1
        return out

    def finish(self) -> list[int]:
        return self._chain(len(self.window))


class Encoder:
    """Texts to ids; short pieces are remembered, up to a fixed number."""

    def __init__(self, ranks: dict[bytes, int]):
        self.m = Merges(ranks)
        self.split = regex.compile(PIECES)
        self.memo: dict[str, tuple[int, ...]] = {}

    def piece(self, text: str) -> tuple[int, ...]:
        data = text.encode("utf-8")
        whole = self.m.ranks.get(data)
        if whole is not None:
            return (whole,)
        t = Transducer(self.m)
        return (*t.feed(data), *t.finish())

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        memo = self.memo
        # a long text's pieces aren't held at once
        for p in self.split.findall(text) if len(text) < LONG else map(regex.Match.group, self.split.finditer(text)):
            ids = memo.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(p) <= MEMO_BYTES and len(memo) < MEMO:
                    memo[p] = ids
            out += ids
        return out


def decode(bytes_of: dict[int, bytes], ids: Iterable[int]) -> Iterator[str]:
    """The text of ids in parts, each as soon as its bytes are whole; what is no UTF-8 becomes U+FFFD."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        part = machine.decode(bytes_of[i])
        if part:
            yield part
    rest = machine.decode(b"", True)
    if rest:
        yield rest


_WORKER: dict[str, Encoder] = {}


def _encoder(key: str, ranks: dict[bytes, int]) -> Encoder:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(ranks)
    return _WORKER[key]


def token_ids(df: DataFrame, id_col: str, text_col: str, path: str = VOCABULARY) -> DataFrame:
    """(id, ids): token ids of every row's text. The vocabulary (1 MB, fixed) is broadcast."""
    told, key = df.sparkSession.sparkContext.broadcast(read_ranks(path)), os.path.abspath(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(key, told.value)
        for batch in batches:
            ids = pa.array([enc.encode(t.as_py()) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, ids array<int>")


def round_trip(df: DataFrame, id_col: str, text_col: str, group_col: str, path: str = VOCABULARY) -> DataFrame:
    """Per group: texts, characters, tokens, and texts that decoding the ids doesn't give back (0)."""
    told, key = df.sparkSession.sparkContext.broadcast(read_ranks(path)), os.path.abspath(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(key, told.value)
        for batch in batches:
            chars, tokens, lost = [], [], []
            for t in batch.column(1):
                t = t.as_py() or ""
                ids = enc.encode(t)
                chars.append(len(t))
                tokens.append(len(ids))
                lost.append("".join(decode(enc.m.bytes_of, ids)) != t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64()), pa.array(lost, pa.bool_())], names=["grp", "chars", "tokens", "lost"])

    x = df.select(F.col(group_col).cast("string").alias("grp"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "grp string, chars long, tokens long, lost boolean")
    return x.groupBy("grp").agg(F.count("*").alias("texts"), F.sum("chars").alias("chars"), F.sum("tokens").alias("tokens"), F.sum(F.col("lost").cast("long")).alias("lost"))
