"""Joins by key, set, range, prefix and tier. A side is broadcast only where its size is checked or fixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 200_000


def maybe_broadcast(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint if counting up to the bound shows that the side is small; else a shuffle join takes place."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def exclude(df: DataFrame, key: str, held: DataFrame, held_key: str) -> DataFrame:
    """Rows whose key is not held out; null keys stay."""
    return df.join(held.select(F.col(held_key).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def keep_only(df: DataFrame, key: str, held: DataFrame, held_key: str) -> DataFrame:
    return df.join(held.select(F.col(held_key).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


FILTER_BITS = 1 << 23


def prefiltered(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be among those of ``wanted``, before a join shuffles wide rows: a bitmap of FILTER_BITS bits
    (1 MB at every size, in blocks of 4 KB) is built by aggregation and broadcast. Rows that get through wrongly are for
    the join to drop; with far more keys than bits the filter lets more through and nothing else changes."""
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(FILTER_BITS)) + 1
    bits = wanted.select(place.alias("_p")).groupBy(F.bitmap_bucket_number("_p").alias("_block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    x = df.withColumn("_block", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "_block")
    return x.where(F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2 == 1).drop("_block", "_bits")


def compared(left: DataFrame, right: DataFrame, key: str, digest: str) -> DataFrame:
    """Full outer comparison of two manifests: only_left, only_right, differs or same per key."""
    x = left.select(key, F.col(digest).alias("l"), F.lit(True).alias("has_l")).join(right.select(key, F.col(digest).alias("r"), F.lit(True).alias("has_r")), key, "full_outer")
    status = F.when(F.col("has_r").isNull(), "only_left").when(F.col("has_l").isNull(), "only_right").when(F.col("l").eqNullSafe(F.col("r")), "same").otherwise("differs")
    return x.select(key, status.alias("status"))


def manifest_verdicts(current: DataFrame, allowed: DataFrame, exceptions: DataFrame, path: str, digest: str, mode: str) -> DataFrame:
    """(path, verdict) of a three-way comparison: present, allowed and excepted files, by presence and digest.

    Mode ``strict`` takes no exception; mode ``lenient`` holds an excepted file to the digest of its exception."""
    c = current.select(path, F.col(digest).alias("c"), F.lit(True).alias("in_c"))
    a = allowed.select(path, F.col(digest).alias("a"), F.lit(True).alias("in_a"))
    e = exceptions.select(path, F.col(digest).alias("e"), F.lit(True).alias("in_e"))
    return presence_verdicts(c.join(a, path, "full_outer").join(e, path, "full_outer"), path, mode)


def presence_verdicts(x: DataFrame, path: str, mode: str) -> DataFrame:
    """The same of a table with a row for each path: digests ``c``, ``a`` and ``e`` and whether the path is there, ``in_c``,
    ``in_a`` and ``in_e`` (null: not). One grouping makes it of manifests that come from one table."""
    here, ok, exc = F.col("in_c").isNotNull(), F.col("in_a").isNotNull(), F.col("in_e").isNotNull()
    same_a, same_e = F.col("c").eqNullSafe(F.col("a")), F.col("c").eqNullSafe(F.col("e"))
    strict = (
        F.when(~here & ok, "FAIL missing").when(here & ~ok & exc, "FAIL unpromoted").when(here & ~ok, "FAIL unapproved")
        .when(here & exc, "FAIL unpromoted").when(here & ~same_a, "FAIL modified").when(here, "PASS")
    )
    lenient = (
        F.when(exc & ~here, "FAIL missing exception").when(exc & ~same_e, "FAIL mismatch").when(exc, "PASS")
        .when(~here & ok, "FAIL missing").when(ok & ~same_a, "FAIL modified").when(ok, "PASS").otherwise("FAIL unapproved")
    )
    verdict = strict if mode == "strict" else lenient
    return x.select(path, verdict.alias("verdict")).where("verdict is not null")


def first_tier(queries: DataFrame, key: str, tiers: list[DataFrame], order: str) -> DataFrame:
    """Per query key the hit of the first tier that has one; ties go to the least ``order``. A tier has key and order."""
    hits = None
    for n, t in enumerate(tiers, 1):
        t = t.withColumn("tier", F.lit(n))
        hits = t if hits is None else hits.unionByName(t)
    best = hits.groupBy(key).agg(F.min_by(F.struct(*[c for c in hits.columns if c != key]), F.struct("tier", F.col(order).alias("o"))).alias("b"))
    return queries.select(key).distinct().join(best, key, "left").select(key, "b.*")


def in_range(points: DataFrame, ranges: DataFrame, group: list[str], at: str, low: str, high: str, width: int) -> DataFrame:
    """Points joined with the ranges of their group that hold them: ranges are cut into bins, so it is an equi-join."""
    cut = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    p = points.withColumn("_bin", F.floor(F.col(at) / width))
    return p.join(cut, [*group, "_bin"]).where((F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))).drop("_bin")


def innermost(points: DataFrame, ranges: DataFrame, group: list[str], key: list[str], at: str, low: str, high: str, label: str, width: int = 64) -> DataFrame:
    """Each point with the label of the shortest range around it (ties: the first to begin), null without any."""
    hit = in_range(points.select(*group, *key, at), ranges.select(*group, low, high, label), group, at, low, high, width)
    best = hit.groupBy(*group, *key).agg(F.min_by(label, F.struct((F.col(high) - F.col(low)).alias("s"), F.col(low).alias("l"), F.col(label).alias("n"))).alias(label))
    return points.join(best, [*group, *key], "left")


def neighbours(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node, neighbour, direction) of every edge, both ways, distinct."""
    out = edges.select(F.col(source).alias("node"), F.col(target).alias("neighbour"), F.lit("out").alias("direction"))
    return out.unionByName(edges.select(F.col(target).alias("node"), F.col(source).alias("neighbour"), F.lit("in").alias("direction"))).distinct()


def induced(edges: DataFrame, source: str, target: str, nodes: DataFrame, node: str) -> DataFrame:
    """Edges whose ends are both among ``nodes``."""
    n = nodes.select(node).distinct()
    return edges.join(n.withColumnRenamed(node, source), source, "left_semi").join(n.withColumnRenamed(node, target), target, "left_semi")


def reachable(edges: DataFrame, source: str, target: str, seeds: DataFrame, node: str, hops: int) -> DataFrame:
    """(node, distance) within ``hops`` edges of the seeds; a node already reached isn't expanded again."""
    seen = seeds.select(F.col(node).alias("node")).distinct().withColumn("distance", F.lit(0))
    front, e = seen, edges.select(F.col(source).alias("node"), F.col(target).alias("next")).distinct()
    for h in range(1, hops + 1):
        front = front.join(e, "node").select(F.col("next").alias("node")).distinct().join(seen.select("node"), "node", "left_anti").withColumn("distance", F.lit(h))
        seen = seen.unionByName(front)
    return seen


def asof(left: DataFrame, right: DataFrame, key: list[str], left_time: str, right_time: str, value: str, name: str) -> DataFrame:
    """Each left row with the value of the last right row of its key at or before its time, the greatest of those at the same
    time. Rows are sorted within a key's days only, so a hot key is many partitions; what a day has from the days before it
    comes from a table of one row for each key and day. Null keys are equal, null times have no value."""
    from functools import reduce

    from pyspark.sql import Window

    cols = left.columns
    timed = left.schema[left_time].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")
    day = lambda t: F.to_date(t) if timed else F.floor(F.col(t) / 86_400)
    none = F.lit(None).cast(right.schema[value].dataType)
    a = left.select(*cols, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), none.alias("_v"))
    b = right.where(F.col(right_time).isNotNull()).select(*[F.col(c) if c in key else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols], F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"))
    w = Window.partitionBy(*key, "_day").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    x = a.unionByName(b).withColumn("_day", day("_t")).withColumn("_own", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    days = a.where("_t is not null").select(*key, day("_t").alias("_day"), none.alias("_v")).distinct()
    lasts = b.where("_v is not null").groupBy(*key, day("_t").alias("_day")).agg(F.max_by("_v", F.struct("_t", "_v")).alias("_v"))
    days = days.unionByName(lasts).groupBy(*key, "_day").agg(F.max("_v").alias("_v"))
    before = F.last("_v", ignorenulls=True).over(Window.partitionBy(*key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1))
    days = days.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(key)], F.col("_day").alias("_of"), before.alias("_before")).where("_before is not null")
    same = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(key)])
    x = x.join(days, same & (F.col("_day") == F.col("_of")), "left")
    return x.select(*cols, F.coalesce("_own", "_before").alias(name))


def labelled(df: DataFrame, checks: list[tuple[str, Column]], name: str = "reason") -> DataFrame:
    """Rows with the name of the first check that fails, null where all hold: rejects keep their reason."""
    out = F.lit(None).cast("string")
    for label, ok in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), label).otherwise(out)
    return df.withColumn(name, out)
