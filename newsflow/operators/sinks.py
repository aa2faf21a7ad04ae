"""Sinks: insert-if-absent, dense id assignment, optimistic versioned update (K-1, K-2, K-3, K-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from newsflow import schemas
from newsflow.functions.text import utc_literal
from newsflow.operators.common import first_per_key
from newsflow.session import cut_lineage


def insert_if_absent(new: DataFrame, table: DataFrame, keys: list[list[str]],
                     order: list[Column | str]) -> DataFrame:
    """K-1: rows of ``new`` whose unique keys are all free.

    Within the batch the first row per key (in ``order``) wins; a key
    already in ``table`` is skipped, not an error.  Each unique key costs one
    shuffle of the batch and one anti-join against the key column of the
    table (only the key columns of the table are read).
    """
    out = new
    for key in keys:
        out = first_per_key(out, key, order)
        out = out.join(table.select(*key).distinct(), key, "left_anti")
    return out


def append_results(rows: DataFrame, name: str, path: str, epoch: int) -> None:
    """K-3: append a stage's result rows to the stored table ``name``, keyed and replayable.

    A batch is one ``epoch``, a partition of the table.  Rows whose unique key
    (``schemas.UNIQUE_KEYS``) an other epoch holds are left out, and of equal keys in
    the batch the first by its values stays.  A replayed epoch overwrites its own
    partition, with the same rows; the other epochs are only read, by their key columns.
    """
    spark = rows.sparkSession
    new = schemas.conform(rows, name)
    keys = schemas.UNIQUE_KEYS[name]
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        stored = spark.read.schema(_with_epoch(name)).parquet(path).where(F.col("epoch") != epoch)
    else:
        stored = schemas.empty(spark, name)
    rest = [c for c in new.columns if c not in {k for key in keys for k in key}]
    insert_if_absent(new, stored, keys, rest).write.mode("overwrite").parquet(f"{path}/epoch={int(epoch)}")


def read_results(spark, name: str, path: str) -> DataFrame:
    """The rows of all epochs of a table written by ``append_results``."""
    return spark.read.schema(_with_epoch(name)).parquet(path).drop("epoch")


def _with_epoch(name: str) -> T.StructType:
    return T.StructType([*schemas.SCHEMAS[name].fields, T.StructField("epoch", T.LongType())])


def assign_ids(df: DataFrame, start: int | DataFrame, order: list[Column | str],
               id_col: str = "id", num_partitions: int | None = None) -> DataFrame:
    """K-5: dense ids ``start + 1, start + 2, ...`` in ``order`` (give a total order).

    ``start`` is an int or a table whose ``max(id)`` continues the sequence.
    Distributed: range-partition by the order, count rows per partition
    (a table with one row per partition), turn counts into offsets, number
    rows within each partition.  No single-partition window over the data.
    Range bounds are sampled anew by every run of the exchange, so its result
    is checkpointed once; counts and numbers then belong to the same ranges.
    """
    if isinstance(start, DataFrame):
        base = start.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("_base"))
    else:
        base = df.sparkSession.range(1).select(F.lit(int(start)).cast("long").alias("_base"))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    offsets = offsets.withColumn("_base", base.select("_base").scalar())
    w = Window.partitionBy("_pid").orderBy(*order)
    # one row per partition: the size bound is n, known before running
    out = (ranged.join(F.broadcast(offsets.select("_pid", "_off", "_base")), "_pid")
           .withColumn(id_col, F.col("_base") + F.col("_off") + F.row_number().over(w)))
    return out.drop("_pid", "_off", "_base")


def versioned_update(target: DataFrame, updates: DataFrame, key: str = "id",
                     base_version: str = "base_version", now=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """K-2: optimistic update.

    ``updates`` holds the key, the version the writer read (``base_version``)
    and the new values of any target columns.  An update applies only when the
    stored version equals the read version; the stored row then takes the new
    values, ``version + 1`` and ``updated_at = now``.  Returns
    ``(snapshot, applied, stale)`` where ``snapshot`` is the new table state.
    """
    value_cols = [c for c in updates.columns if c not in (key, base_version) and c in target.columns
                  and c not in ("version", "created_at")]
    u = updates.select(key, base_version, *[F.col(c).alias(f"_u_{c}") for c in value_cols])
    # several updates of one id: one is tried (the newest read version, then by value), the others are stale
    turn = Window.partitionBy(key).orderBy(F.desc(base_version), *[f"_u_{c}" for c in value_cols])
    u = u.withColumn("_turn", F.row_number().over(turn))
    joined = target.join(u.where("_turn = 1").drop("_turn"), key, "left")
    hit = F.col(base_version).isNotNull() & (F.col("version") == F.col(base_version))
    cols = []
    for c in target.columns:
        if c in value_cols:
            cols.append(F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        elif c == "version":
            cols.append(F.when(hit, F.col("version") + 1).otherwise(F.col("version")).alias(c))
        elif c == "updated_at" and now is not None:
            cols.append(F.when(hit, utc_literal(now).cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    marked = joined.select(*cols, hit.alias("_applied"), F.col(base_version).isNotNull().alias("_touched"))
    snapshot = marked.drop("_applied", "_touched")
    applied = marked.where("_applied").drop("_applied", "_touched")
    stale = (u.join(target.select(key, "version"), key, "left")
             .where(F.col("version").isNull() | (F.col("version") != F.col(base_version)) | (F.col("_turn") > 1))
             .select(key, base_version, F.col("version").alias("stored_version")))
    return snapshot, applied, stale
