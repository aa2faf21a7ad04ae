"""Helpers shared by operators: size-checked broadcast and first-per-key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A side input (rules, templates, profiles, code tables, day counts) is
# broadcast only after its row count was checked against this bound.
BROADCAST_MAX_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` if it provably holds at most ``max_rows`` rows.

    The check is a cheap count of a small side input; a side beyond the
    bound is returned unchanged so the planner falls back to a shuffle
    join (AQE may still convert it at runtime from real sizes).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Keep the first row per key in ``order`` (deterministic: callers give a total order).

    With plain (ascending) order columns this is an aggregate,
    ``min_by(row, order)``, so partial aggregation collapses a hot key on
    the map side before the shuffle: a URL carried by a third of all rows
    costs one row per map task, not one giant window partition.  Ordering
    expressions such as ``col.desc()`` fall back to a window.
    """
    if all(isinstance(o, str) for o in order):
        rest = [c for c in df.columns if c not in keys]
        agg = df.groupBy(*keys).agg(
            F.min_by(F.struct(*rest), F.struct(*[F.col(o) for o in order])).alias("_first"))
        return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


ARROW_ROWS = 256


def small_batches(spark) -> None:
    """Arrow batches of few rows, as one row can be a very long text."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin a few-partition input over the cluster before heavy per-row work.

    A large table arrives in thousands of scan partitions and is left alone;
    an input with fewer partitions than ``factor`` x default parallelism (a
    small file, one row group) is repartitioned so that the expensive
    expression work is not done by a single task.
    """
    target = df.sparkSession.sparkContext.defaultParallelism * factor
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
