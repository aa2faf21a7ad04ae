"""Streaming stages: landed files in, idempotent table appends out.

Each stage is one streaming query: ``readStream`` of a landed-file source,
``foreachBatch`` running the batch operator against the current table
snapshots, and appends keyed on natural keys (K-1), so a replayed
micro-batch after a failure changes nothing (effectively once, ST-6).
Periodic scans (ST-1) are the trigger: ``processingTime`` in production,
``availableNow`` for catch-up runs and tests.

Tables are parquet folders.  A state table that is rewritten per batch
(source health) is stored as versioned snapshots ``<path>/v=<epoch>``;
reading the newest snapshot and writing the next one cuts the lineage
every batch, and re-running an epoch overwrites its own snapshot.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from newsflow import schemas
from newsflow.functions.text import go_trim
from newsflow.operators.ingest import normalize_feed_items
from newsflow.operators.sinks import assign_ids
from newsflow.operators.state import source_health
from newsflow.session import cut_lineage


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def latest_snapshot(spark: SparkSession, path: str, schema) -> tuple[DataFrame | None, int]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None, -1
    versions = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and name[2:].isdigit():
            fs_ok = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            if fs_ok:
                versions.append(int(name[2:]))
    if not versions:
        return None, -1
    v = max(versions)
    return spark.read.schema(schema).parquet(f"{path}/v={v}"), v


# ------------------------------------------------ tables looked up by URL (ST-8)

BUCKET = "url_bucket"


def url_bucket(url: str | F.Column = "url", buckets: int = 1024) -> F.Column:
    """Partition of a URL in the tables that are looked up by URL."""
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, name: str, path: str, wanted: list[int]) -> DataFrame:
    """The rows of table ``name`` in the partitions ``wanted``; no file of another partition is opened.

    The filter is a literal list of at most as many numbers as there are partitions.  A
    table that was written without partitions is refused: its rows would not be found.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return schemas.empty(spark, name)
    if any(st.isFile() and not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p)):
        raise ValueError(f"{path} is not partitioned by {BUCKET}: write its rows once with append_buckets")
    return _with_bucket(spark, name, path).where(F.col(BUCKET).isin(wanted)).drop(BUCKET)


def _with_bucket(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.read.schema(StructType([*schemas.SCHEMAS[name].fields, StructField(BUCKET, IntegerType())])).parquet(path)


def append_buckets(rows: DataFrame, name: str, path: str, buckets: int) -> None:
    """Append ``rows`` (a column ``url`` next to those of the table) to the partitions of their URLs.

    One file for each partition touched: rows are dealt by partition before the write.
    """
    keyed = schemas.conform(rows.withColumn(BUCKET, url_bucket("url", buckets)), name, extra=(BUCKET,))
    keyed.repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)


def compact_buckets(spark: SparkSession, name: str, path: str, files: int = 64) -> list[int]:
    """Write each partition with more than ``files`` files as one file; returns those partitions.

    To be run between batches.  The rows are checkpointed before their partitions are overwritten.
    """
    fs, p = _fs(spark, path)
    many = [int(st.getPath().getName().split("=")[1]) for st in fs.listStatus(p)
            if st.getPath().getName().startswith(f"{BUCKET}=")
            and sum(f.getPath().getName().endswith(".parquet") for f in fs.listStatus(st.getPath())) > files]
    if many:
        rows = cut_lineage(_with_bucket(spark, name, path).where(F.col(BUCKET).isin(many)))
        rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(BUCKET).parquet(path)
    return sorted(many)


IDS_SCHEMA = "last_id long, buckets int"


def reserve_ids(spark: SparkSession, path: str, n: int, table: str, buckets: int) -> int:
    """Take ``n`` ids of ``table``: the number before the first of them.

    What is reserved is written before the rows that use it, so a batch that dies in between
    leaves a gap and its replay takes new ids: never one id twice.  The last number is
    a snapshot of one row at ``path``, so the table is read for its largest id only
    where there is no snapshot.  One writer at a time, as a stream's batches are.
    """
    stored, v = latest_snapshot(spark, path, IDS_SCHEMA)
    if stored is not None:
        last, had = stored.first()
        if had != buckets:
            raise ValueError(f"{table} has {had} URL partitions, not {buckets}")
    else:
        fs, p = _fs(spark, table)
        last = (spark.read.schema("id long").parquet(table).agg(F.max("id")).first()[0] or 0) if fs.exists(p) else 0
    if n:
        spark.createDataFrame([(last + n, buckets)], IDS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/v={v + 1}")
        if v > 0:      # the snapshot before is kept, older ones have no reader
            fs, old = _fs(spark, f"{path}/v={v - 1}")
            fs.delete(old, True)
    return last


def run_stream(source: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str,
               trigger: dict | None = None, name: str | None = None):
    """Start a ``foreachBatch`` query; ``trigger`` e.g. ``{"processingTime": "5 minutes"}``
    or ``{"availableNow": True}``."""
    w = source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"processingTime": "5 minutes"}))
    return w.start()


def feed_items_batch(tables: str, langs: list[str], cutoff: _dt.datetime | None = None,
                     profiles_path: str | None = None, feed_ids: DataFrame | None = None, buckets: int = 1024):
    """``foreachBatch`` body: normalise landed feed items, append new
    web_resources and feed_items (P-1 + J-1 + K-1 + K-5 + ST-8).

    Both tables lie in ``buckets`` partitions by hash of the resource's URL (a fixed number for
    the life of the tables; set it so that one partition stays a few files).  A batch reads and
    writes only the partitions of its own URLs, and takes its ids from a reservation.
    """
    def process(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        res_path, fi_path = f"{tables}/web_resources", f"{tables}/feed_items"
        items = batch.withColumnRenamed("link", "url")
        if "feed_id" not in items.columns:
            items = items.withColumn("feed_id", F.lit(0).cast("long"))
        items = cut_lineage(items)     # parsed once: its partitions, then its outcomes
        wanted = [b for (b,) in items.where("url IS NOT NULL").select(url_bucket(go_trim("url"), buckets)).distinct().collect()]
        resources = read_buckets(spark, "web_resources", res_path, wanted)
        stored = read_buckets(spark, "feed_items", fi_path, wanted)
        profiles = spark.read.parquet(profiles_path) if profiles_path else None
        if profiles is None and "language" not in items.columns:
            raise ValueError("feed items need a language column or language profiles")
        out = normalize_feed_items(items, resources, stored, langs=langs, cutoff=cutoff, profiles=profiles)
        out = out.where("outcome IN ('new', 'attach')").transform(cut_lineage)
        now = _dt.datetime.now(_dt.timezone.utc)
        new = out.where("outcome = 'new'")
        new = assign_ids(new, reserve_ids(
            spark, f"{tables}/_ids/web_resources", new.count(), res_path, buckets), ["url"], id_col="resource_id")
        new = cut_lineage(new)   # ids are persisted: compute them once
        append_buckets(new.select(F.col("resource_id").alias("id"), F.lit(now).alias("created_at"),
                                  F.lit(now).alias("updated_at"), F.lit(0).cast("long").alias("version"), "url"),
                       "web_resources", res_path, buckets)
        attach = out.where("outcome = 'attach'").unionByName(new)
        rows = attach.select(F.col("resource_id").alias("web_resource_id"), "feed_id", "title", "description",
                             "content", "language", "published_at", "url")
        rows = assign_ids(rows, reserve_ids(
            spark, f"{tables}/_ids/feed_items", rows.count(), fi_path, buckets), ["web_resource_id"])
        rows = rows.withColumn("created_at", F.lit(now)).withColumn("updated_at", F.lit(now)) \
                   .withColumn("version", F.lit(0).cast("long"))
        append_buckets(rows, "feed_items", fi_path, buckets)
    return process


HEALTH_SCHEMA = ("source_id long, failures_count int, last_error string, last_retrieved_at timestamp, "
                 "enabled boolean, attempts long")


def health_batch(state_path: str, max_failures: int | None):
    """``foreachBatch`` body folding fetch attempts into the source-health
    state table (A-3 / A-4) as a new snapshot per epoch."""
    from pyspark.sql.types import _parse_datatype_string

    def process(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        prev, _ = latest_snapshot(spark, state_path, _parse_datatype_string(HEALTH_SCHEMA))
        new = source_health(batch, max_failures=max_failures, initial=prev)
        if prev is not None:
            # attempts counts accumulate across epochs
            new = (new.join(prev.select("source_id", F.col("attempts").alias("_a0")), "source_id", "left")
                   .withColumn("attempts", F.col("attempts") + F.coalesce("_a0", F.lit(0))).drop("_a0"))
        new.select(*[c.split(" ")[0] for c in HEALTH_SCHEMA.split(", ")]) \
           .write.mode("overwrite").parquet(f"{state_path}/v={epoch_id}")
    return process


def read_health(spark: SparkSession, state_path: str) -> DataFrame | None:
    from pyspark.sql.types import _parse_datatype_string
    df, _ = latest_snapshot(spark, state_path, _parse_datatype_string(HEALTH_SCHEMA))
    return df
