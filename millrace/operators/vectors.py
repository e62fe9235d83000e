"""Nearest vectors by cosine. The query set is checked and broadcast in blocks; every row meets every query of a block
inside a map-side top k, so no pairs are shuffled beyond k per query and task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 4096


def nearest(df: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """(query_id, id, cosine, rank): the k nearest other rows of each query row, ties by id.

    Null, empty and zero vectors are nobody's neighbours; vectors of other lengths than the query's neither. The queries are
    read in blocks of QUERY_BLOCK of one length."""
    spark = df.sparkSession
    rows = queries.select(F.col(id_col).cast("long").alias("q"), F.col(vec_col).cast("array<double>").alias("v")).where(F.size(vec_col) > 0).orderBy("q").toLocalIterator()
    out, blocks = None, {}

    def search(block: list) -> DataFrame:
        told = spark.sparkContext.broadcast((np.array([r.q for r in block]), _unit(np.array([r.v for r in block], float))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qs, m = told.value
            best_c = np.full((len(qs), 0), -2.0)
            best_i = np.zeros((len(qs), 0), np.int64)
            for batch in batches:
                lens = np.diff(np.asarray(batch.column(1).offsets))
                ok = np.flatnonzero((lens == m.shape[1]) & np.asarray(batch.column(1).is_valid()))
                if not len(ok):
                    continue
                x = _unit(np.array([batch.column(1)[int(i)].as_py() for i in ok], float))
                own = batch.column(0).to_numpy()[ok]
                c = np.round(m @ x.T, 12)
                c[:, ~x.any(axis=1)] = -2
                c[qs[:, None] == own[None, :]] = -2
                best_c, best_i = np.hstack([best_c, c]), np.hstack([best_i, np.broadcast_to(own, c.shape)])
                order = np.lexsort((best_i, -best_c), axis=1)[:, :k]
                best_c, best_i = np.take_along_axis(best_c, order, 1), np.take_along_axis(best_i, order, 1)
            q = np.repeat(qs, best_c.shape[1])
            keep = best_c.ravel() > -2
            yield pa.RecordBatch.from_arrays([pa.array(q[keep], pa.int64()), pa.array(best_i.ravel()[keep], pa.int64()), pa.array(best_c.ravel()[keep], pa.float64())], names=["query_id", "id", "cosine"])

        vectors = df.select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>"))
        return vectors.mapInArrow(run, "query_id long, id long, cosine double")

    for r in rows:
        block = blocks.setdefault(len(r.v), [])
        block.append(r)
        if len(block) == QUERY_BLOCK:
            found = search(blocks.pop(len(r.v)))
            out = found if out is None else out.unionByName(found)
    for size in sorted(blocks):
        found = search(blocks[size])
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, id long, cosine double, rank long")
    w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "id")
    return out.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)
