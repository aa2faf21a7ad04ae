"""Dense ids at size, duplicate updates, unquoted exports, soft-deleted rows."""

import datetime as dt

from pyspark.sql import functions as F

from newsflow.functions.text import decode_charset
from newsflow.operators.manage import apply_deletes, apply_updates
from newsflow.operators.sinks import assign_ids, versioned_update
from newsflow.sources.landed import GDELT_SCHEMA, read_gdelt_events
from tests.conftest import SF_MID


def test_dense_ids_of_three_million_rows(spark):
    rows = spark.range(3_000_000, numPartitions=24).select((F.col("id") * 7919 % 3_000_017).alias("k"))
    got = assign_ids(rows, 10, ["k"], num_partitions=24)
    n, distinct, low, high = got.agg(F.count("id"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
    assert (n, distinct, low, high) == (3_000_000, 3_000_000, 11, 3_000_010)


def test_dense_ids_follow_the_order(spark):
    lines = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    got = assign_ids(lines, 0, ["l_orderkey", "l_linenumber"]).orderBy("id").toPandas()
    assert got["id"].tolist() == list(range(1, len(got) + 1))
    assert got[["l_orderkey", "l_linenumber"]].apply(tuple, axis=1).is_monotonic_increasing


def test_second_update_of_one_id_is_stale(spark):
    target = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "id long, version int, title string")
    updates = spark.createDataFrame([(1, 0, "x"), (1, 0, "y")], "id long, base_version int, title string")
    snapshot, applied, stale = versioned_update(target, updates)
    assert snapshot.count() == 2 and applied.count() == 1 and stale.count() == 1


def test_export_fields_keep_lone_quotes(spark, tmp_path):
    names = [f.name for f in GDELT_SCHEMA.fields]
    row = {n: "" for n in names} | {"GLOBALEVENTID": "7", "ActionGeo_FullName": 'Place "of', names[-1]: "http://x.org/a"}
    (tmp_path / "a.export.CSV").write_text("\t".join(row[n] for n in names) + "\n")
    events = read_gdelt_events(spark, str(tmp_path)).collect()
    assert len(events) == 1 and "http://x.org/a" in [v for v in events[0] if isinstance(v, str)]
    assert 'Place "of' in [v for v in events[0] if isinstance(v, str)]


def test_soft_deleted_rows_are_not_found(spark):
    now = dt.datetime(2024, 3, 1)
    target = spark.createDataFrame([(1, 1, "a", None), (2, 1, "b", now), (3, 1, "c", None)],
                                   "id long, version int, title string, deleted_at timestamp")
    updates = spark.createDataFrame([(1, "y"), (1, "x"), (2, "z"), (9, "z")], "id long, title string")
    snapshot, not_found = apply_updates(target, updates, now)
    assert sorted((r.id, r.version, r.title) for r in snapshot.collect()) == [(1, 2, "x"), (2, 1, "b"), (3, 1, "c")]
    assert sorted(r.id for r in not_found.collect()) == [2, 9]
    children = spark.createDataFrame([(3,)], "feed_id long")
    _, report = apply_deletes(target, target.select("id"), [(children, "feed_id")], now)
    assert sorted(tuple(r) for r in report.collect()) == [(1, "hard"), (3, "soft")]


def test_malformed_utf8_is_replaced(spark):
    rows = spark.createDataFrame([(1, bytearray(b"caf\xe9 x"), "UTF-8"), (2, bytearray("caf\u00e9".encode()), "UTF-8"),
                                  (3, None, "UTF-8")], "id int, body binary, charset string")
    got = {r.id: r.t for r in rows.select("id", decode_charset().alias("t")).collect()}
    assert got == {1: "caf\ufffd x", 2: "caf\u00e9", 3: None}
