"""Vectors: normalisation, distances, day keys, day-range KNN, duplicate
detection and retention (SC-6, SC-8..SC-10, J-11, W-2, W-5, O-4, U-1, M-7,
M-9, F-11, F-12, F-14, F-16, ST-7, K-4).

Day-range KNN at scale
----------------------
A query vector published on day ``d`` is compared with the stored vectors of the
days ``d - N .. d`` (whole UTC days, both ends included).  The distances are
metrics in disguise: a cosine distance of ``t`` is a distance of ``sqrt(2 t)``
between normalised vectors, L2 is squared.  So a task parts its stored vectors into
cells around ``pivots`` vectors, and a cell's members lie between two distances
from its pivot.  By the triangle inequality a query meets a cell only if its own
distance from the pivot is within the threshold of that range; cells out of reach
are skipped.  (IP is no metric: every cell is met.)

A task holds one part of a day, at most ``PART_VALUES`` numbers, and streams a slice
of the day's queries past it, one matrix product for ``block_rows`` vectors.  A day
has as many slices as its share of the stored vectors asks for, so a day that holds
most of them is still dealt over the cluster.  A stored vector is shuffled once for
each slice of its day, a query once for each part of its days, however many blocks
the part has; where ``k`` hits are asked for, or the best alone, no part gives a query
more.  Results are exact: no pair in reach is left out, nothing is sampled or capped
but the choice of the pivots.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsflow import schemas
from newsflow.functions.text import utc_literal
from newsflow.operators.common import bounded_broadcast, first_per_key

SPACES = ("L2", "IP", "COSINE")
DAY_FORMAT = "yyyy-MM-dd"


def check_space(space: str) -> str:
    """Distance names: exactly L2, IP or COSINE (anything else is invalid)."""
    if space not in SPACES:
        raise ValueError(f"invalid space type {space!r}")
    return space


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def l2_normalize(col) -> Column:
    """SC-6: v / |v| as array<float>; the zero vector is returned unchanged."""
    v = _c(col)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(v, lambda x: (x.cast("double") / norm).cast("float"))) \
            .otherwise(F.transform(v, lambda x: x.cast("float")))


def distance(a, b, space: str = "COSINE") -> Column:
    """SC-8: COSINE = 1 - cos, IP = 1 - dot, L2 = squared Euclidean; double math, float result."""
    check_space(space)
    a, b = _c(a), _c(b)
    zipped = F.arrays_zip(a.alias("x"), b.alias("y"))
    dot = F.aggregate(zipped, F.lit(0.0), lambda acc, p: acc + p["x"].cast("double") * p["y"].cast("double"))
    if space == "IP":
        d = 1.0 - dot
    elif space == "L2":
        d = F.aggregate(zipped, F.lit(0.0),
                        lambda acc, p: acc + (p["x"].cast("double") - p["y"].cast("double"))
                        * (p["x"].cast("double") - p["y"].cast("double")))
    else:
        na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
        nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
        d = 1.0 - F.try_divide(dot, na * nb)  # NULL for the zero vector, which has no direction
    return d.cast("float")


def utc_day(ts) -> Column:
    """SC-9: UTC calendar day of a timestamp (session time zone is UTC)."""
    return F.to_date(_c(ts))


def day_key(ts, prefix: str = "") -> Column:
    """SC-9: ``prefix + YYYY-MM-DD`` of the UTC day."""
    return F.concat(F.lit(prefix), F.date_format(_c(ts), DAY_FORMAT))


def day_range(day, days_back: int) -> Column:
    """SC-10: inclusive array of days ``day - N .. day``."""
    d = _c(day)
    return F.sequence(F.date_sub(d, days_back), d, F.expr("INTERVAL 1 DAY"))


# ------------------------------------------------------------ blocked KNN

def _distances(q: np.ndarray, c: np.ndarray, space: str) -> np.ndarray:
    dot = q @ c.T
    if space == "IP":
        return 1.0 - dot
    if space == "L2":
        return np.maximum((q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * dot, 0.0)
    nq = np.linalg.norm(q, axis=1)[:, None]
    nc = np.linalg.norm(c, axis=1)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - dot / (nq * nc)


PART_VALUES = 1 << 24  # numbers of the stored vectors that a task holds
SLICES = 4  # slices of the queries for each core, over all days
PIVOTS_MAX = 256  # the pivots are held by every task: 256 vectors


def _unit(x: np.ndarray, space: str) -> np.ndarray:
    """Vectors whose Euclidean distances give those of ``space``; the zero vector stays."""
    if space != "COSINE":
        return x
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1.0)


def _reach(threshold: float, space: str) -> float:
    """Euclidean distance within which every hit lies, rounding allowed for."""
    if space == "IP":
        return np.inf
    wide = max(0.0, threshold) * (1 + 1e-6) + 1e-6
    return float(np.sqrt(2 * wide if space == "COSINE" else wide)) + 1e-6


def _vectors_of(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; every list has the length of the first."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.array(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _pivots(vectors: DataFrame, rows: int, block_rows: int, space: str) -> np.ndarray:
    """The finite ones of the vectors of the least id hashes, one for each block of rows, ``PIVOTS_MAX`` at most."""
    n = min(PIVOTS_MAX, max(1, rows // block_rows))
    rows = vectors.where("data IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(n).select("data").collect()
    if not rows:
        return np.empty((0, 0))
    x = _unit(np.array([r["data"] for r in rows], dtype=np.float64), space)
    finite = x[np.isfinite(x).all(1)]
    return finite if len(finite) else np.zeros((1, x.shape[1]))


def _apart(x: np.ndarray, pivots: np.ndarray, space: str) -> np.ndarray:
    """Distances of vectors from the pivots."""
    x = _unit(x, space)
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T, 0))


def _blocks(ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, space: str, rows: int) -> list[tuple]:
    """Stored vectors as blocks (cell, least and largest distance from its pivot, ids, vectors) of one cell each.

    A vector that is not finite is in no reach; without a metric all are one cell.
    """
    if space == "IP":
        return [(0, 0.0, np.inf, ids[at:at + rows], x[at:at + rows]) for at in range(0, len(ids), rows)]
    cell, own = np.empty(len(ids), np.int64), np.empty(len(ids))
    for at in range(0, len(ids), 8192):
        d = _apart(x[at:at + 8192], pivots, space)
        cell[at:at + 8192] = d.argmin(1)
        own[at:at + 8192] = d.min(1)
    order = np.argsort(cell, kind="stable")
    order = order[np.isfinite(own[order])]
    edges = np.searchsorted(cell[order], np.arange(len(pivots) + 1))
    cuts = [(c, order[at:min(at + rows, hi)]) for c, (lo, hi) in enumerate(zip(edges, edges[1:])) for at in range(lo, hi, rows)]
    return [(c, own[part].min(), own[part].max(), ids[part], x[part]) for c, part in cuts]


def _best_rows(d: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, candidate) of the hits, the first ``k`` in (distance, id) of each query."""
    qi, ci = np.nonzero(ok)
    if k is None or not len(qi):
        return qi, ci
    order = np.lexsort((ids[ci], d[qi, ci], qi))
    qi, ci = qi[order], ci[order]
    rank = _rank(qi)
    return qi[rank < k], ci[rank < k]


def _rank(groups: np.ndarray) -> np.ndarray:
    """Place of each row in its run of equal values, from 0."""
    first = np.flatnonzero(np.diff(groups, prepend=-1))
    return np.arange(len(groups)) - np.repeat(first, np.diff(np.append(first, len(groups))))


def knn_pairs(queries: DataFrame, vectors: DataFrame, timeframe_days: int, threshold: float,
              space: str = "COSINE", block_rows: int = 4096, smaller_only: bool = False,
              exclude_self: bool = False, k: int | None = None) -> DataFrame:
    """Hits (qid, id, distance) of every query against stored vectors of days
    ``day - N .. day`` with ``distance <= threshold`` (float32 comparison).

    ``queries`` and ``vectors`` have columns (id, day, data).  With
    ``smaller_only`` only candidates with a smaller id count, and each part of a
    day emits at most the best hit per query; with ``k`` at most its ``k`` best.
    """
    check_space(space)
    spark = vectors.sparkSession
    q, c = (df.select(*[F.col(x).alias(x) for x in ("id", "day", "data")]) for df in (queries, vectors))
    q, c = (df.withColumn("data", F.col("data").cast("array<float>")).where("day IS NOT NULL") for df in (q, c))
    rows = c.count()
    pivots = _pivots(c, rows, block_rows, space)
    if not len(pivots):
        return spark.createDataFrame([], "qid long, id long, distance float")
    reach, limit, top = _reach(threshold, space), np.float32(threshold), 1 if smaller_only else k
    q, c = (df.where("data IS NOT NULL") for df in (q, c))
    key = ["c_day", "part", "slice"]

    # one row a day: into how many parts its vectors go, and into how many slices its queries
    part_rows = max(block_rows, PART_VALUES // max(1, pivots.shape[1]))
    slices = SLICES * spark.sparkContext.defaultParallelism
    days = bounded_broadcast(c.groupBy(F.col("day").alias("c_day")).agg(F.count(F.lit(1)).alias("n")).select(
        "c_day", F.ceil(F.col("n") / F.lit(part_rows)).cast("int").alias("parts"),
        F.ceil(F.col("n") * F.lit(slices) / F.lit(rows)).cast("int").alias("slices")))
    stored = (c.withColumnRenamed("day", "c_day").join(days, "c_day")
              .select("c_day", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"),
                      F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("side"), "id", "data"))
    asked = (q.withColumn("c_day", F.explode(day_range("day", timeframe_days))).join(days, "c_day")
             .select("c_day", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                     F.pmod(F.xxhash64("id"), "slices").cast("int").alias("slice"), F.lit(1).alias("side"), "id", "data"))

    def hits_of(qid, data, blocks):
        apart = _apart(data, pivots, space) if space != "IP" else np.zeros((len(qid), 1))
        found = []
        for cell, lo, hi, ids, x in blocks:
            met = np.flatnonzero((apart[:, cell] - reach <= hi) & (apart[:, cell] + reach >= lo))
            if not len(met):
                continue
            d = _distances(data[met], x, space).astype(np.float32)
            ok = d <= limit  # a distance that is no number is no hit
            if smaller_only:
                ok &= ids[None, :] < qid[met, None]
            elif exclude_self:
                ok &= ids[None, :] != qid[met, None]
            qi, ci = _best_rows(d, ok, ids, top)
            if top is None:  # every hit counts: they leave block by block
                yield qid[met[qi]], ids[ci], d[qi, ci]
            elif len(qi):
                found.append((met[qi], ids[ci], d[qi, ci]))
        if found:
            qi, ids, d = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((ids, d, qi))
            order = order[_rank(qi[order]) < top]
            yield qid[qi[order]], ids[order], d[order]

    def search(batches):
        group, blocks = None, None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            keys = list(zip(*(b[n].to_pylist() for n in key)))
            side = np.array(b["side"])
            # runs of one part, slice and side
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or side[i] != side[i - 1]), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                rows = b.slice(lo, hi - lo)
                own, data = np.array(rows["id"]), _vectors_of(rows["data"])
                if keys[lo] != group:
                    group, held, blocks = keys[lo], [], None
                if side[lo] == 0:
                    held.append((own, data))
                    continue
                if blocks is None:
                    blocks = _blocks(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]),
                                     pivots, space, block_rows) if held else []
                    held = []
                for at in range(0, len(own), 512):
                    for hits in hits_of(own[at:at + 512], data[at:at + 512], blocks):
                        yield pa.record_batch([pa.array(x) for x in hits], names=["qid", "id", "distance"])

    # a fixed number of partitions: the work is the product of both sides, which sizes do not show
    width = max(slices, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (stored.unionByName(asked).repartition(width, *key).sortWithinPartitions(*key, "side")
            .mapInArrow(search, "qid long, id long, distance float"))


def knn(queries: DataFrame, vectors: DataFrame, timeframe_days: int, threshold: float,
        space: str = "COSINE", k: int | None = None, block_rows: int = 4096,
        exclude_self: bool = False) -> DataFrame:
    """J-11 + U-1 + O-4 + W-5 + F-14: hits (qid, id, distance, rank) sorted by
    (distance, id) per query; ``k`` keeps the first k (K nearest), ``None``
    keeps every hit within the threshold."""
    hits = knn_pairs(queries, vectors, timeframe_days, threshold, space, block_rows, exclude_self=exclude_self, k=k)
    w = Window.partitionBy("qid").orderBy("distance", "id")
    hits = hits.withColumn("rank", F.row_number().over(w))
    if k is not None:
        hits = hits.where(F.col("rank") <= k)
    return hits


def detect_duplicates(articles: DataFrame, vectors: DataFrame, similarity_infos: DataFrame | None,
                      timeframe_days: int, threshold: float, space: str = "COSINE",
                      select_top_hit: Callable[[Column], Column] | None = None,
                      block_rows: int = 4096) -> DataFrame:
    """M-7 + W-2 (+ M-9): similarity_infos rows for articles not yet checked
    (F-11) that have a vector (F-12).

    Parent = first hit in (distance, id) order among stored vectors of the
    day range with a smaller id and distance <= threshold; no hit -> NULL
    parent and distance.  ``select_top_hit`` (optional) receives the array
    of all such hits ``array<struct<distance,id>>`` sorted, and returns the
    chosen struct or NULL.
    """
    arts = articles.select("id", F.to_date("publish_date").alias("day"))
    if similarity_infos is not None:
        arts = arts.join(similarity_infos.select(F.col("web_article_id").alias("id")), "id", "left_anti")
    vec = vectors.select(F.col("web_article_id").alias("id"), "data", F.col("publish_day").alias("day"))
    queries = arts.join(vec.select("id", "data"), "id")           # F-12 (inner join)
    if select_top_hit is None:
        hits = knn_pairs(queries, vec, timeframe_days, threshold, space, block_rows, smaller_only=True)
        top = hits.groupBy("qid").agg(F.min(F.struct("distance", "id")).alias("hit"))
    else:
        hits = knn_pairs(queries, vec, timeframe_days, threshold, space, block_rows)
        hits = hits.where(F.col("id") < F.col("qid"))
        top = hits.groupBy("qid").agg(
            select_top_hit(F.array_sort(F.collect_list(F.struct("distance", "id")))).alias("hit"))
    return (queries.select("id").join(top.withColumnRenamed("qid", "id"), "id", "left")
            .select(F.col("id").alias("web_article_id"), F.col("hit.id").alias("parent_id"),
                    F.col("hit.distance").alias("distance")))


# ------------------------------------------------------------ retention / sink

def retain(vectors: DataFrame, now: _dt.datetime, days: int) -> tuple[DataFrame, DataFrame]:
    """F-16 + ST-7: split into (kept, expired) by UTC day; a day strictly before
    ``day(now - days)`` is expired.  Partition filters prune at the scan."""
    cutoff = F.to_date(utc_literal(now) - F.make_dt_interval(F.lit(days)))
    return vectors.where(F.col("publish_day") >= cutoff), vectors.where(F.col("publish_day") < cutoff)


def expired_days(spark, path: str, now: _dt.datetime, days: int, prefix: str = "publish_day=") -> list[str]:
    """Day partitions of a stored vector table older than the cut-off (names
    must have the prefix and an exact ``YYYY-MM-DD`` suffix)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    cutoff = (now - _dt.timedelta(days=days)).astimezone(_dt.timezone.utc).date() \
        if now.tzinfo else (now - _dt.timedelta(days=days)).date()
    out = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if not name.startswith(prefix) or len(name) != len(prefix) + 10:
            continue
        try:
            day = _dt.date.fromisoformat(name[len(prefix):])
        except ValueError:
            continue
        if day < cutoff:
            out.append(st.getPath().toString())
    return sorted(out)


def purge_vectors(spark, path: str, now: _dt.datetime, days: int) -> list[str]:
    """ST-7: drop expired day partitions of a stored vector table."""
    jvm = spark._jvm
    removed = []
    for p in expired_days(spark, path, now, days):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hp, True)
        removed.append(p)
    return removed


def write_vectors(vectors: DataFrame, path: str, replace: bool = False) -> None:
    """K-4: store vectors in the partition of their UTC publish day, one row for each article.

    A vector that its day holds already is left out, so a replayed batch adds
    nothing; only the id column of the batch's own days is read.  The append is one
    job and is committed as a whole.  With ``replace`` the batch's vectors take the
    place of the stored ones: the days touched are merged on ``web_article_id`` and
    rewritten by a dynamic partition overwrite, the other days are not opened.
    """
    from newsflow.session import cut_lineage
    spark = vectors.sparkSession
    new = vectors.select("web_article_id", "data", "publish_day")
    if replace or _stored(spark, path):
        # the days of a batch are few; they prune the partitions that are read
        days = [r["publish_day"] for r in new.select("publish_day").distinct().collect()]
    new = first_per_key(new, ["publish_day", "web_article_id"], ["data"])
    if _stored(spark, path):
        old = spark.read.schema(schemas.SCHEMAS["vectors"]).parquet(path).where(F.col("publish_day").isin(days))
        key = ["publish_day", "web_article_id"]
        if replace:
            kept = old.select("web_article_id", "data", "publish_day").join(new.select(*key), key, "left_anti")
            # read before the days are overwritten
            cut_lineage(kept.unionByName(new)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("publish_day").parquet(path)
            return
        new = new.join(old.select(*key), key, "left_anti")
    new.write.mode("append").partitionBy("publish_day").parquet(path)


def read_vectors(spark, path: str) -> DataFrame:
    return spark.read.schema(schemas.SCHEMAS["vectors"]).parquet(path).select("web_article_id", "data", "publish_day")


def _stored(spark, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)
