"""Generated inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 10_000


def combinations(sets: list[DataFrame]) -> DataFrame:
    """Every combination of the rows of small sets. Each set is checked to have at most MOST rows and its rows become a
    literal array, so the product is an explode of literals and no join."""
    out = None
    for s in sets:
        rows = s.limit(MOST + 1).collect()
        if len(rows) > MOST:
            raise ValueError(f"a set of a combination has more than {MOST} rows")
        if not rows:
            return sets[0].sparkSession.createDataFrame([], ", ".join(f"{n} {t}" for x in sets for n, t in x.dtypes))
        if out is None:
            out = s
        else:
            item = F.array(*[F.struct(*[F.lit(r[c]).cast(t).alias(c) for c, t in s.dtypes]) for r in rows])
            out = out.withColumn("_x", F.explode(item)).select(*out.columns, "_x.*")
    return out
