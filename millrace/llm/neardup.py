"""Problem 6: near-duplicate texts with small edits, by pigeonring filtering.

A text is the set of its distinct runs of ``width`` words, a point in Hamming space: the Jaccard similarity of A and B is
at least t exactly when their Hamming distance is at most tau = (|A| + |B|) (1 - t) / (1 + t).

1. ``features``: one narrow pass over the texts (Arrow buffers, numpy). Each set gets a 64-bit identity, so exact copies
   are one point from here on, and a ring of 16 segments of 16 bits (parities of its members), whose distances never
   exceed those of the sets' own segments. Nothing but this small table and the sets is kept.
2. ``candidates``: two sets within tau share ``SHARED`` members (all, if they need fewer) among the first
   |A| - ceil(t |A|) + SHARED of A and likewise of B in any common order; members common in the corpus go last. Members
   that stay hot are split into blocks, each pair of blocks a group of its own, so no task takes an unbounded group; groups
   are formed from sorted rows as they stream by. The list of common members has a fixed bound (``HOT_LIST``) and only
   orders members: no pair depends on it. It joins counts of members seen ``LOCAL_LEAST`` times in a task with all
   members of one in ``SAMPLED`` sets, so that a member spread thinly over many tasks is seen too.
3. ``pigeonring``: a pair stays only if from some segment on all chains of 1..L consecutive segments have cumulative
   differences of at most l tau / m. There must be such a start if the whole distance is at most tau, so no pair is lost;
   the whole ring isn't looked at. On sf0.1 chains of one segment leave 7,281 of 9,366 candidates, of two 5,256, of
   eight 3,661, of ``CHAIN`` = 12 3,510; 3,300 pass the full check.
4. The full Hamming check on the sets themselves, for the pairs that are left.

Classes of equal sets stay one point until the end; where pairs of texts are asked for, large classes go into the last
join in blocks of about ``HOT_BLOCK``, each pair of blocks for itself.

Null and short texts have no pairs; texts of any length are taken whole; rows delivered again count once; equal sets are
pairs of similarity 1. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shingles import mix, shingle_sets
from millrace.operators.joins import maybe_broadcast, prefiltered
from millrace.session import discard, stage

SEGMENTS, CHAIN = 16, 12
HOT_LIST, HOT_LEAST, LOCAL_LEAST, SAMPLED, HOT_BLOCK = 1 << 20, 16, 3, 32, 4096
SHARED = 2
_FEATURES = "id long, sid long, n int, first boolean, sk0 long, sk1 long, sk2 long, sk3 long, sh array<long>, hot array<long>, counts array<int>"
_SHIFT = np.uint64(56)
_KEY = np.uint64((1 << 48) - 1)


def features(df: DataFrame, id_col: str, text_col: str, width: int = 3, least_words: int = 30) -> DataFrame:
    """One row per text with enough words; besides, per task a row with null ``id`` that counts its common members.
    ``sh`` is kept with the first copy in a task only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        members: list[np.ndarray] = []
        sampled: list[np.ndarray] = []
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            cols: list[list] = [[] for _ in range(8)]
            sets: list[np.ndarray] = []
            lengths: list[int] = []
            for row, _, s in shingle_sets(batch.column(1), width, least_words):
                seed = (int(s.sum(dtype=np.uint64)) + len(s) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)
                sid = int(mix(np.array([seed], np.uint64))[0]) ^ int(np.bitwise_xor.reduce(s))
                first = sid not in seen
                bits = np.bincount((s >> _SHIFT).astype(np.int64), minlength=256) & 1
                sk = np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)
                for c, v in zip(cols, (ids[row], np.uint64(sid).astype(np.int64), len(s), first, *sk)):
                    c.append(v)
                lengths.append(len(s) if first else 0)
                if first:
                    seen.add(sid)
                    sets.append(s)
                    members.append(s)
                    if sid % SAMPLED == 0:
                        sampled.append(s)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            flat = pa.array((np.concatenate(sets) if sets else np.zeros(0, np.uint64)).view(np.int64))
            n = len(lengths)
            empty = pa.nulls(n, pa.list_(pa.int64()))
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.bool_())]
            arrays += [pa.array(c, pa.int64()) for c in cols[4:]] + [pa.ListArray.from_arrays(offsets, flat), empty, pa.nulls(n, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=_NAMES)
            if sum(map(len, members)) > 4_000_000:  # counts are partial then; they only order the members
                yield _common(members, LOCAL_LEAST, 1)
                members = []
        if members:
            yield _common(members, LOCAL_LEAST, 1)
        if sampled:
            yield _common(sampled, 1, SAMPLED)

    texts = df.select(F.col(id_col).cast("long"), F.col(text_col)).where(F.col(text_col).isNotNull())
    return texts.mapInArrow(run, _FEATURES)


_NAMES = ["id", "sid", "n", "first", "sk0", "sk1", "sk2", "sk3", "sh", "hot", "counts"]


def _common(members: list[np.ndarray], least: int, each: int) -> pa.RecordBatch:
    """A row with the members that occur ``least`` times and their counts; ``n`` says for how many sets each stands."""
    values, counts = np.unique(np.concatenate(members), return_counts=True)
    keep = counts >= least
    hot, counts = values[keep].view(np.int64), counts[keep].astype(np.int32)
    null = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.list_(pa.int64()))]
    null.insert(2, pa.array([each], pa.int32()))
    one = pa.array([0, len(hot)], pa.int32())
    return pa.RecordBatch.from_arrays([*null, pa.ListArray.from_arrays(one, pa.array(hot)), pa.ListArray.from_arrays(one, pa.array(counts))], names=_NAMES)


def _hot(feats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most common members and their counts: at most HOT_LIST of them, 16 MB, at every size."""
    rows = (
        feats.where(F.col("id").isNull())
        .select(F.col("n").alias("each"), F.explode(F.arrays_zip("hot", "counts")).alias("x"))
        .groupBy("x.hot")
        .agg(*[F.coalesce(F.sum(F.when(F.col("each") == k, F.col("x.counts"))), F.lit(0)).alias(c) for c, k in (("seen", 1), ("drawn", SAMPLED))])
        .select("hot", F.greatest("seen", F.when(F.col("drawn") >= HOT_LEAST, F.col("drawn") * SAMPLED)).alias("n"))
        .where(F.col("n") >= HOT_LEAST)
        .orderBy(F.desc("n"), "hot")
        .limit(HOT_LIST)
        .toPandas()
    )
    rows = rows.sort_values("hot")
    return rows["hot"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def candidates(feats: DataFrame, t_num: int, t_den: int) -> DataFrame:
    """Pairs (a, b) of set identities, a < b, that share enough members of their prefixes."""
    spark = feats.sparkSession
    hot, counts = _hot(feats)
    told = spark.sparkContext.broadcast((hot, counts))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, counts = told.value
        for batch in batches:
            sids, ns, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            offsets = np.asarray(lists.offsets)
            flat = np.asarray(lists.values)[: offsets[-1]]
            row = np.repeat(np.arange(len(sids)), np.diff(offsets))
            at = np.searchsorted(hot, flat)
            at[at == len(hot)] = 0
            is_hot = hot[at] == flat if len(hot) else np.zeros(len(flat), bool)
            load = np.where(is_hot, counts[at], 0) if len(hot) else np.zeros(len(flat), np.int64)
            order = np.lexsort((flat, load, row))  # rare members first, in the same order everywhere
            place = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))
            need = -(-ns.astype(np.int64) * t_num // t_den)
            keep = place < (ns - need + SHARED)[row]
            order, row = order[keep], row[keep]
            key, load = flat[order].view(np.uint64), load[order]
            sid, n = sids[row], ns[row]
            wide = load > HOT_BLOCK
            parts = [(key[~wide], sid[~wide], n[~wide])]
            for k, s, m, c in zip(key[wide], sid[wide], n[wide], load[wide]):
                b = int(-(-c // HOT_BLOCK))
                own = int(mix(np.array([s], np.int64).view(np.uint64))[0] % np.uint64(b))
                for other in range(b):
                    lo, hi = min(own, other), max(own, other)
                    parts.append((mix(np.array([k + np.uint64(lo * b + hi + 1)], np.uint64)), np.array([s]), np.array([m], np.int32)))
            key, sid, n = (np.concatenate(x) for x in zip(*parts))
            # 48 bits of a key: keys that fall together only add candidates, and a sixth less is shuffled
            yield pa.RecordBatch.from_arrays([pa.array((key & _KEY).view(np.int64)), pa.array(sid, pa.int64()), pa.array(n, pa.int32())], names=["key", "sid", "n"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by key; the last key of a batch waits for the next one
        rest = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        for batch in batches:
            new = [batch.column(k).to_numpy() for k in range(3)]
            rows = [np.concatenate(x) for x in zip(rest, new)]
            if not len(rows[0]):
                continue
            k = int(np.searchsorted(rows[0], rows[0][-1], "left"))
            rest = [x[k:] for x in rows]
            yield from _met(*[x[:k] for x in rows], t_num, t_den)
        yield from _met(*rest, t_num, t_den)

    flat = feats.where(F.col("first")).select("sid", "n", "sh").mapInArrow(prefixes, "key long, sid long, n int")
    met = flat.repartition("key").sortWithinPartitions("key").mapInArrow(pairs, "a long, b long, k int, need int")
    return met.groupBy("a", "b").agg(F.sum("k").alias("k"), F.max("need").alias("need")).where("k >= need").select("a", "b")


def _met(key: np.ndarray, sid: np.ndarray, n: np.ndarray, t_num: int, t_den: int) -> Iterator[pa.RecordBatch]:
    """The pairs of sets of fitting sizes within whole groups of equal keys, with the number of keys that they share."""
    if not len(key):
        return
    order = np.lexsort((sid, key))
    key, sid, n = key[order], sid[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
    key, sid, n = key[new], sid[new], n[new]
    end = np.searchsorted(key, key, "right")
    at, out, held, d = np.arange(len(key)), [], 0, 0
    while True:
        d += 1
        at = at[at + d < end[at]]
        if not len(at):
            break
        i = at[np.minimum(n[at], n[at + d]) * t_den >= np.maximum(n[at], n[at + d]) * t_num]
        need = -(-(n[i].astype(np.int64) + n[i + d]) * t_num // (t_num + t_den))
        out.append(np.stack([sid[i], sid[i + d], np.minimum(need, SHARED)]))
        held += len(i)
        if held > 2_000_000:
            yield _counted(out)
            out, held = [], 0
    if held:
        yield _counted(out)


def _counted(out: list[np.ndarray]) -> pa.RecordBatch:
    x = np.concatenate(out, axis=1)
    x = x[:, np.lexsort(x[:2])]
    new = np.ones(x.shape[1], bool)
    new[1:] = (x[:2, 1:] != x[:2, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    k = np.diff(np.append(at, x.shape[1])).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(x[0][at]), pa.array(x[1][at]), pa.array(k), pa.array(x[2][at].astype(np.int32))], names=["a", "b", "k", "need"])


def pigeonring(left: list[Column], right: list[Column], tau: Column, chain: int = CHAIN) -> Column:
    """Whether some segment starts chains of 1..chain segments, each within its share of tau. ``left`` and ``right``
    hold the ring, four segments of 16 bits to a number."""
    d = [
        F.bit_count(F.shiftrightunsigned(x.bitwiseXOR(y), 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int")
        for x, y in zip(left, right)
        for k in range(4)
    ]
    boxes = F.array(*d)
    budget = tau.cast("int")

    def starts(i: Column) -> Column:
        total, ok = F.lit(0), F.lit(True)
        for step in range(chain):
            total = total + F.element_at(boxes, F.pmod(i + step, F.lit(SEGMENTS)) + 1)
            ok = ok & (total * SEGMENTS <= budget * (step + 1))
        return ok

    return F.exists(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), starts)


def similar_sets(feats: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs (a, b, shared, na, nb) of different sets, a < b, with similarity of at least ``threshold``."""
    t_num, t_den = _fraction(threshold)
    pairs = candidates(feats, t_num, t_den)
    ring = feats.where(F.col("first")).select("sid", "n", "sk0", "sk1", "sk2", "sk3").groupBy("sid").agg(*[F.first(c).alias(c) for c in ("n", "sk0", "sk1", "sk2", "sk3")])
    side = lambda x: ring.select(F.col("sid").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("n", "sk0", "sk1", "sk2", "sk3")])
    tau = F.floor((F.col("a_n") + F.col("b_n")) * (t_den - t_num) / (t_den + t_num) + F.lit(1e-9))
    left = pairs.join(side("a"), "a").join(side("b"), "b")
    kept = left.where(pigeonring([F.col(f"a_sk{k}") for k in range(4)], [F.col(f"b_sk{k}") for k in range(4)], tau)).select("a", "b")
    kept = stage(kept, "pigeonring")
    wanted = kept.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    sets = prefiltered(feats.where(F.col("first")).select("sid", "sh"), "sid", wanted).join(wanted, "sid", "left_semi").groupBy("sid").agg(F.first("sh").alias("sh"))
    both = kept.join(sets.select(F.col("sid").alias("a"), F.col("sh").alias("sa")), "a").join(sets.select(F.col("sid").alias("b"), F.col("sh").alias("sb")), "b")
    full = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("shared"), F.size("sa").alias("na"), F.size("sb").alias("nb"))
    # the Hamming distance na + nb - 2 shared is within tau
    return full.where(F.col("shared") * (t_den + t_num) >= (F.col("na") + F.col("nb")) * t_num)


def _fraction(threshold: float) -> tuple[int, int]:
    num, den = round(threshold * 1000), 1000
    g = math.gcd(num, den)
    return num // g, den // g


def step_texts(steps: DataFrame) -> DataFrame:
    """(step_id, text): ``content`` of write actions and ``new_string`` of edit actions."""
    a = F.col("action")
    text = F.when(a.action_type == "write_file", a.content).when(a.action_type == "edit_file", a.new_string)
    return steps.where(a.action_type.isin("write_file", "edit_file")).select("step_id", text.alias("text"))


def members(feats: DataFrame) -> DataFrame:
    """(id, sid): the set of each text, once for every id."""
    return feats.where(F.col("id").isNotNull()).groupBy("id").agg(F.max("sid").alias("sid"))


def similar_pairs(df: DataFrame, id_col: str, text_col: str, width: int = 3, least_words: int = 30, threshold: float = 0.7) -> DataFrame:
    """All pairs (id_a, id_b), id_a < id_b, of texts at or above the threshold, exact copies with them."""
    feats = stage(features(df, id_col, text_col, width, least_words), "sets")
    return expanded(similar_sets(feats, threshold).select("a", "b"), members(feats))


def expanded(links: DataFrame, of: DataFrame) -> DataFrame:
    """(id_a, id_b): the pairs of ids, id_a < id_b, of linked sets (a, b) and of equal sets, from (id, sid). Classes of
    more than ``HOT_BLOCK`` ids are split into blocks, and pairs of blocks joined each for themselves."""
    size = of.groupBy("sid").agg(F.count("*").alias("k"))
    links = links.unionByName(size.where("k > 1").select(F.col("sid").alias("a"), F.col("sid").alias("b")))
    large = maybe_broadcast(size.where(F.col("k") > HOT_BLOCK).select("sid", F.ceil(F.col("k") / HOT_BLOCK).cast("int").alias("blocks")))
    for x in "ab":
        links = links.join(large.select(F.col("sid").alias(x), F.col("blocks").alias(f"{x}_blocks")), x, "left")
    every = lambda x: F.explode(F.sequence(F.lit(0), F.coalesce(f"{x}_blocks", F.lit(1)) - 1))
    links = links.withColumn("i", every("a")).withColumn("j", every("b")).where("a <> b or i <= j").select("a", "b", "i", "j")
    of = of.join(large, "sid", "left").select("id", "sid", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"))
    x = links.join(of.select(F.col("sid").alias("a"), F.col("block").alias("i"), F.col("id").alias("x")), ["a", "i"])
    x = x.join(of.select(F.col("sid").alias("b"), F.col("block").alias("j"), F.col("id").alias("y")), ["b", "j"])
    return x.where("a <> b or i < j or x < y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root): connected components of (a, b), root the least node, by alternating large and small stars until
    nothing changes (after a number of rounds that grows as the logarithm of the nodes); each round is a table in the shared
    folder, deleted once the next one stands."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        new = stage(small.where("u <> v").distinct(), "edges")
        same = new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty()
        discard(edges)
        discard(large)
        edges = new
        if same:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def groups(df: DataFrame, id_col: str, text_col: str, width: int = 3, least_words: int = 30, threshold: float = 0.7) -> DataFrame:
    """(id, group_id, links): per text the least id of its group and its number of similar texts (copies included)."""
    feats = stage(features(df, id_col, text_col, width, least_words), "sets")
    links = stage(similar_sets(feats, threshold).select("a", "b"), "links")
    of = members(feats)
    size = of.groupBy("sid").agg(F.count("*").alias("k"))
    roots = components(links)
    near = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = near.join(size.select(F.col("sid").alias("b"), "k"), "b").groupBy(F.col("a").alias("sid")).agg(F.sum("k").alias("others"))
    x = of.join(size, "sid").join(near, "sid", "left").join(roots.withColumnRenamed("node", "sid"), "sid", "left")
    x = x.select("id", F.coalesce("root", "sid").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("k") - 1).alias("links")).where("links > 0")
    least = x.groupBy("root").agg(F.min("id").alias("group_id"))
    return x.join(least, "root").select("id", "group_id", "links")
