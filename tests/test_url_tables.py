"""Tables looked up by URL: a micro-batch opens only the partitions of its own URLs."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

COLS = "item_seq long, link string, title string, description string, content string, language string, published_at timestamp"


def _batch(spark, first, urls):
    return spark.createDataFrame([(first + i, u, f"title {u}", "", "", "en", None) for i, u in enumerate(urls)], COLS)


def _ids(spark, path):
    return sorted(r.id for r in spark.read.schema("id long").parquet(path).collect())


def test_batches_read_and_write_their_own_partitions(spark):
    from newsflow.streaming.runner import BUCKET, compact_buckets, feed_items_batch, read_buckets, url_bucket
    d = tempfile.mkdtemp(prefix="newsflow-urls-")
    step = feed_items_batch(d, ["en"], buckets=16)
    first = [f"https://n.example/{i}" for i in range(40)]
    step(_batch(spark, 0, first), 0)
    step(_batch(spark, 100, [" https://n.example/3 ", "https://n.example/new", "https://n.example/new", None]), 1)
    step(_batch(spark, 100, ["https://n.example/3", "https://n.example/new"]), 1)      # replayed
    res, items = os.path.join(d, "web_resources"), os.path.join(d, "feed_items")
    assert _ids(spark, res) == list(range(1, 42)) and _ids(spark, items) == list(range(1, 42))
    stored = spark.read.parquet(res)
    assert stored.where(url_bucket("url", 16) != F.col(BUCKET)).count() == 0
    assert stored.select("url").distinct().count() == 41
    both = spark.read.parquet(items).join(stored.select(F.col("id").alias("web_resource_id"), "url"), "web_resource_id")
    assert both.count() == 41 and both.where(F.col("title") != F.concat(F.lit("title "), "url")).count() == 0
    # the scan of one URL's partition
    (b,) = spark.createDataFrame([("https://n.example/3",)], "url string").select(url_bucket("url", 16)).first()
    one = read_buckets(spark, "web_resources", res, [b])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(f"{BUCKET}={b}/" in f for f in one.select(F.input_file_name().alias("f")).toPandas()["f"])
    # compaction keeps the rows
    (n,) = spark.createDataFrame([("https://n.example/new",)], "url string").select(url_bucket("url", 16)).first()
    assert n in compact_buckets(spark, "web_resources", res, files=1)
    assert len([f for f in os.listdir(os.path.join(res, f"{BUCKET}={n}")) if f.endswith(".parquet")]) == 1
    assert _ids(spark, res) == list(range(1, 42))


def test_a_dead_batch_leaves_a_gap_and_no_id_twice(spark):
    from newsflow.streaming.runner import feed_items_batch, reserve_ids
    d = tempfile.mkdtemp(prefix="newsflow-urls-")
    res = os.path.join(d, "web_resources")
    feed_items_batch(d, ["en"], buckets=4)(_batch(spark, 0, ["https://n.example/a"]), 0)
    assert reserve_ids(spark, f"{d}/_ids/web_resources", 5, res, 4) == 1     # reserved, never written
    feed_items_batch(d, ["en"], buckets=4)(_batch(spark, 1, ["https://n.example/b", "https://n.example/c"]), 1)
    assert _ids(spark, res) == [1, 7, 8]
    with pytest.raises(ValueError, match="has 4 URL partitions"):
        feed_items_batch(d, ["en"], buckets=8)(_batch(spark, 3, ["https://n.example/d"]), 2)
    # without the snapshot the table is asked
    assert reserve_ids(spark, f"{d}/_elsewhere", 1, res, 4) == 8


def test_a_table_without_partitions_is_refused(spark):
    from newsflow.streaming.runner import feed_items_batch
    d = tempfile.mkdtemp(prefix="newsflow-urls-")
    spark.range(1).write.parquet(os.path.join(d, "web_resources"))
    with pytest.raises(ValueError, match="not partitioned"):
        feed_items_batch(d, ["en"], buckets=4)(_batch(spark, 0, ["https://n.example/a"]), 0)


def test_an_empty_batch_writes_no_row(spark):
    from newsflow.streaming.runner import feed_items_batch, read_buckets
    d = tempfile.mkdtemp(prefix="newsflow-urls-")
    feed_items_batch(d, ["en"], buckets=4)(_batch(spark, 0, ["https://n.example/a"]).where("false"), 0)
    assert read_buckets(spark, "web_resources", os.path.join(d, "web_resources"), [0, 1, 2, 3]).count() == 0
