"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into segments; a segment is known by its mean and its deviation
(the norm of what the mean leaves).  For two vectors the inner product is at
most ``sum(n * mean * mean' + dev * dev')`` over the segments, which is the same
as a lower bound of their distance.  Levels go from one segment to many; a level
only looks at pairs the level before could not rule out against the k-th best
exact score known so far, and what survives the last is computed exactly.

The stated queries meet all rows in blocks: both sides are stacked into
matrices of ``BLOCK`` rows, each pair of blocks is one row, and only the k best
of a pair of blocks leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import written

BLOCK = 2048
LEVELS = (1, 4, 16)


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products are the upper bounds: scaled means, then deviations."""
    parts = []
    for seg in np.array_split(vectors.astype(np.float64), min(segments, vectors.shape[1]), axis=1):
        mean = seg.mean(axis=1)
        parts += [mean * np.sqrt(seg.shape[1]), np.sqrt(((seg - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(parts, axis=1)


def block_best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """(query row, candidate row, score) of the k best candidates of each query; its own id is no candidate."""
    if not c.shape[1]:
        scores = np.zeros((len(q), len(c)), np.int64)
        pairs = [(i, np.flatnonzero(c_ids != q_ids[i])) for i in range(len(q))]
        return [(i, j, 0) for i, js in pairs for j in js[np.argsort(c_ids[js], kind="stable")][:k]]
    levels = [(segment_statistics(q, n), segment_statistics(c, n)) for n in LEVELS if n <= c.shape[1]]
    slack = 1e-9 * (np.abs(q).astype(float) @ np.abs(c).max(axis=0).astype(float)) + 1e-6
    coarse = levels[0][0] @ levels[0][1].T
    best = []
    for i in range(len(q)):
        own = c_ids != q_ids[i]
        left = np.flatnonzero(own)
        if len(left) > k:
            # the k most hopeful at the finest level give the first threshold
            hope = left[np.argpartition(coarse[i, left], -k)[-min(4 * k, len(left)):]] if len(left) > 4 * k else left
            fine = levels[-1][1][hope] @ levels[-1][0][i]
            hope = hope[np.argpartition(fine, -k)[-k:]]
            least = (c[hope] @ q[i]).min() - slack[i]
            left = left[coarse[i, left] >= least]
            for qs, cs in levels[1:]:
                left = left[cs[left] @ qs[i] >= least]
        score = c[left] @ q[i]
        for j in np.lexsort((c_ids[left], -score))[:k]:
            best.append((i, left[j], score[j]))
    return best


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``; components are
    floor(``scale`` * x).  Rows whose id or vector is null, or with null or
    non-finite components, take no part; vectors meet those of their own length
    only; rows that repeat an id are each candidates, but for that id's own
    queries; a repeated query is asked once per distinct vector.  An empty table
    gives no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~bad).select(
        "vec_id", F.transform("x", lambda x: F.floor(x * F.lit(scale))).alias("x"), F.size("x").alias("dim"))

    def stack(batches):
        """Rows of one partition as blocks of one length: ids and the matrix, as bytes."""
        held: dict[int, list] = {}

        def block(dim):
            rows = held.pop(dim)
            ids = np.array([r[0] for r in rows], "<i8")
            data = np.array([r[1] for r in rows], "<i8").reshape(len(rows), dim)
            return pa.record_batch([pa.array([x], t) for x, t in (
                (dim, pa.int32()), (ids.tobytes(), pa.binary()), (data.tobytes(), pa.binary()))], names=["dim", "ids", "data"])
        for b in batches:
            for vec_id, x, dim in zip(*(b[c].to_pylist() for c in ("vec_id", "x", "dim"))):
                held.setdefault(dim, []).append((vec_id, x))
                if len(held[dim]) == BLOCK:
                    yield block(dim)
        for dim in list(held):
            yield block(dim)

    stacked = "dim int, ids binary, data binary"
    candidates = written(v.mapInArrow(stack, stacked), "candidates")
    queries = written(v.where(F.col("vec_id") % every == 0).distinct().mapInArrow(stack, stacked), "queries")

    def search(batches):
        for b in batches:
            for dim, qi, qd, ci, cd in zip(*(b[c].to_pylist() for c in ("dim", "q_ids", "q_data", "ids", "data"))):
                q_ids, c_ids = np.frombuffer(qi, "<i8"), np.frombuffer(ci, "<i8")
                best = block_best(q_ids, np.frombuffer(qd, "<i8").reshape(len(q_ids), dim),
                                  c_ids, np.frombuffer(cd, "<i8").reshape(len(c_ids), dim), k)
                i, j, s = (np.array(x, np.int64) for x in (zip(*best) if best else ((), (), ())))
                yield pa.record_batch([pa.array(q_ids[i]), pa.array(c_ids[j]), pa.array(s)],
                                      names=["query_id", "vec_id", "score"])

    key = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(256, int(key))))
    # blocks of the stated query set against blocks of all rows, dealt out evenly
    pairs = candidates.join(queries.select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data")), "dim")
    scored = pairs.repartition(F.xxhash64("ids"), F.xxhash64("q_ids")).mapInArrow(
        search, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
