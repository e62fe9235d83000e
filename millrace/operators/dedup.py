"""Keyed deduplication, quotas, top-n and deterministic splits. Every order ends in a key, so ties are settled.

Empty inputs give empty outputs; null keys form a group of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """One row per key, that with the greatest ``order``.

    A ranked window over keys that are nearly unique: unlike an aggregate of whole rows, only the columns that are used
    later are read and shuffled, and tasks keep one row per key before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(df: DataFrame, key: str, order: list[Column], qualified: Column | None = None) -> DataFrame:
    """The first row of each key in ``order`` among those that qualify: what fails doesn't count as seen."""
    if qualified is not None:
        df = df.where(qualified)
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])).alias("_row"))
    return picked.select(key, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group with their place ``rank``; Spark limits groups before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def quota(df: DataFrame, source: str, order: list[Column], caps: dict[str, int]) -> DataFrame:
    """At most ``caps[source]`` rows of each source in scan order; sources without a cap give none."""
    cap = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])[F.col(source)]
    top = top_per_group(df.where(F.col(source).isin(list(caps))), [source], order, max(caps.values(), default=0))
    return top.where(F.col("rank") <= cap)


def backfilled_quota(df: DataFrame, source: str, first: str, second: str, order: list[Column], n: int) -> DataFrame:
    """Up to n/2 rows of ``first``, then of ``second`` up to n in all, then more of ``first`` until n."""
    ranked = top_per_group(df.where(F.col(source).isin(first, second)), [source], order, n)
    counts = ranked.groupBy().agg(F.sum((F.col(source) == first).cast("long")).alias("a"), F.sum((F.col(source) == second).cast("long")).alias("b"))
    a1 = F.least(F.coalesce("a", F.lit(0)), F.lit(n // 2))
    b1 = F.least(F.coalesce("b", F.lit(0)), F.lit(n) - a1)
    plan = counts.select(F.least(F.coalesce("a", F.lit(0)), F.lit(n) - b1).alias("take_a"), b1.alias("take_b"))
    out = ranked.join(F.broadcast(plan), F.lit(True))  # one row
    return out.where(F.col("rank") <= F.when(F.col(source) == first, F.col("take_a")).otherwise(F.col("take_b"))).drop("take_a", "take_b")


def validation_count(n: Column) -> Column:
    """How many of n go to validation: a fifth, at least one of 2 or more, none of 1."""
    return F.when(n > 3, F.greatest(F.lit(1), F.round(n * 0.2).cast("long"))).when(n > 1, F.lit(1)).otherwise(F.lit(0)).cast("long")


def grouped_split(df: DataFrame, item: str, group: str, salt: str = "42") -> DataFrame:
    """(item, group, part): the items of each group in an order of hashes, the first into ``val``, the rest ``train``."""
    items = df.select(item, group).where(F.col(item).isNotNull()).distinct()
    mixed = F.md5(F.concat(F.lit(salt + ":"), F.col(item).cast("string")))
    w = Window.partitionBy(group)
    x = items.withColumn("n", F.count("*").over(w)).withColumn("k", F.row_number().over(w.orderBy(mixed, F.col(item))))
    return x.select(item, group, F.when(F.col("k") <= validation_count(F.col("n")), "val").otherwise("train").alias("part"))


def selected(catalog: DataFrame, key: str, index: str, done: DataFrame, failed: DataFrame, start: int = 0, target: str | None = None, retry_failed: bool = False, force: bool = False) -> DataFrame:
    """The part of a catalog to work on, by the first choice made: what failed, a target (its key, its number or a part of
    its key), all from ``start``, or what is not done from ``start``. ``done`` and ``failed`` have the column ``key``."""
    if retry_failed:
        return catalog.join(failed.select(key).distinct(), key, "left_semi")
    if target is not None:
        return catalog.where(F.contains(F.col(key), F.lit(target)) | (F.col(index).cast("string") == target))
    rest = catalog.where(F.col(index) >= start)
    return rest if force else rest.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def remapped(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under their own name from the first of their names that has a value; names that the table lacks don't count."""
    for name, others in aliases.items():
        held = [c for c in (name, *others) if c in df.columns]
        df = df.withColumn(name, F.coalesce(*held) if held else F.lit(None).cast("string"))
    return df.drop(*[o for others in aliases.values() for o in others])


DIGEST_BLOCK = 10_000


def content_digest(df: DataFrame, group: list[str], key: str, text: str) -> DataFrame:
    """(group, texts, digest): per group a SHA-256 of all texts in the order of ``key``, as a tree: blocks of ``DIGEST_BLOCK``
    digests make a digest each, level by level, so no task holds a group. Null texts count as empty."""
    from millrace.operators.ordering import numbered

    own = [f"_g{k}" for k in range(len(group))]
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(o)) for g, o in zip(group, own)])
    x = numbered(df.select(*group, F.col(key).alias("_k"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_d")), [*group, "_k"], "_n")
    texts = x.groupBy(*[F.col(g).alias(o) for g, o in zip(group, own)]).agg(F.count("*").alias("texts"), F.min("_n").alias("_first"))
    x = x.join(texts, same).select(*group, (F.col("_n") - F.col("_first")).alias("_n"), "_d")
    most = texts.agg(F.max("texts")).first()[0] or 0
    while True:
        x = x.groupBy(*group, F.floor(F.col("_n") / DIGEST_BLOCK).alias("_b")).agg(F.sort_array(F.collect_list(F.struct("_n", "_d"))).alias("_all"))
        x = x.select(*group, F.col("_b").alias("_n"), F.sha2(F.array_join(F.col("_all._d"), ""), 256).alias("_d"))
        most = -(-most // DIGEST_BLOCK)
        if most <= 1:
            break
    # the root
    x = x.select(*group, F.sha2("_d", 256).alias("digest"))
    return x.join(texts, same).select(*group, "texts", "digest")
