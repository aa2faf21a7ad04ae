"""Landed-file readers (S-1..S-4) and streaming stages, on files written into a scratch folder."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

RSS = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>F</title>
<item><title>First item</title><link>https://n.example/a</link><description>d1</description>
<content:encoded>body one</content:encoded><pubDate>Mon, 02 Jan 2006 15:04:05 -0700</pubDate></item>
<item><title>Second item</title><link> https://n.example/b </link><description>d2</description></item>
<item><title>Dup of first</title><link>https://n.example/a</link><pubDate>Tue, 03 Jan 2006 10:00:00 +0000</pubDate></item>
</channel></rss>"""

ATOM = """<?xml version="1.0" encoding="utf-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title>
<entry><title>Atom entry</title><link rel="alternate" href="https://n.example/c"/><link rel="self" href="https://x/self"/>
<summary>s</summary><published>2006-01-04T08:00:00Z</published></entry>
</feed>"""


def _scratch():
    return tempfile.mkdtemp(prefix="newsflow-test-")


def test_read_feed_items(spark):
    from newsflow.sources.landed import read_feed_items
    d = _scratch()
    open(os.path.join(d, "rss.xml"), "w").write(RSS)
    open(os.path.join(d, "atom.xml"), "w").write(ATOM)
    rows = {(r.link, r.title): r for r in read_feed_items(spark, d).collect()}
    assert ("https://n.example/b", "Second item") in rows
    first = rows[("https://n.example/a", "First item")]
    assert first.content == "body one"
    assert first.published_at == dt.datetime(2006, 1, 2, 22, 4, 5)
    assert rows[("https://n.example/b", "Second item")].published_at is None
    assert rows[("https://n.example/c", "Atom entry")].published_at == dt.datetime(2006, 1, 4, 8)


def test_read_gdelt_events(spark):
    from newsflow.sources.landed import GDELT_COLUMNS, read_gdelt_events
    d = _scratch()
    rows = []
    for i, (url, root, added) in enumerate([("https://n.example/g1", "04", "20240101120000"),
                                             ("", "14", "20240101120000"),
                                             ("https://n.example/g1", "19", "20240101130000")]):
        vals = [""] * len(GDELT_COLUMNS)
        vals[0], vals[26], vals[27], vals[28] = str(100 + i), root + "1", root + "1", root
        vals[51], vals[52], vals[53], vals[56], vals[57] = "4", "Paris, France", "FR", "48.85", "2.35"
        vals[59], vals[60] = added, url
        rows.append("\t".join(vals))
    open(os.path.join(d, "1.export.CSV"), "w").write("\n".join(rows) + "\n")
    ev = read_gdelt_events(spark, d)
    assert ev.count() == 3
    from newsflow import schemas
    from newsflow.operators.ingest import normalize_gdelt_events
    cc = spark.createDataFrame([("FR", "FR")], "fips string, iso string")
    out = normalize_gdelt_events(ev, schemas.empty(spark, "web_resources"), schemas.empty(spark, "gdelt_events"),
                                 cc, codes=[]).collect()
    by_url = {r.source_url: r for r in out}
    assert by_url["https://n.example/g1"].outcome == "new"
    assert by_url["https://n.example/g1"].global_event_id == 100          # first per URL
    assert by_url["https://n.example/g1"].location_type == "WORLDCITY"
    assert by_url["https://n.example/g1"].coordinates == (2.35, 48.85)
    assert by_url[""].outcome == "skip"


def test_read_tweets_and_sources(spark):
    from newsflow.operators.ingest import tweets_of_sources
    from newsflow.sources.landed import read_tweets
    d = _scratch()
    with open(os.path.join(d, "t.json"), "w") as f:
        for i, (u, t) in enumerate([("alice", "Hello World"), ("bob", "the world cup"), ("carol", "nothing")]):
            f.write(json.dumps({"id": str(i), "text": t, "time": "2024-01-01T00:00:00Z", "username": u,
                                "user_id": u, "permanent_url": f"https://t/{i}", "photos": []}) + "\n")
    tw = read_tweets(spark, d)
    src = spark.createDataFrame([(1, "user", "alice", True, None), (2, "search", "WORLD", True, None),
                                 (3, "weird", "x", True, None)],
                                "id long, type string, text string, enabled boolean, deleted_at timestamp")
    got = sorted((r.twitter_source_id, r.id, r.outcome) for r in tweets_of_sources(tw, src).collect())
    assert got == [(1, "0", "ok"), (2, "0", "ok"), (2, "1", "ok"), (3, None, "error")]


def test_decode_other_charset(spark):
    from newsflow.functions.text import decode_body
    body = "café".encode("cp1252")
    df = spark.createDataFrame([(bytearray(body), "text/html; charset=windows-1252"),
                                (bytearray("naïve".encode("utf-8")), "text/html")], "body binary, content_type string")
    assert [r.t for r in df.select(decode_body().alias("t")).collect()] == ["café", "naïve"]


def test_feed_stream_is_idempotent(spark):
    from newsflow.sources.landed import read_feed_items
    from newsflow.streaming.runner import feed_items_batch, run_stream
    d = _scratch()
    land, tables, ck = os.path.join(d, "land"), os.path.join(d, "tables"), os.path.join(d, "ck")
    os.makedirs(land)
    open(os.path.join(land, "rss.xml"), "w").write(RSS)
    stream = read_feed_items(spark, land, stream=True).withColumn("language", F.lit("en"))
    q = run_stream(stream, feed_items_batch(tables, ["en"]), ck, {"availableNow": True})
    q.awaitTermination(300)
    res = spark.read.parquet(os.path.join(tables, "web_resources"))
    assert sorted(r.url for r in res.collect()) == ["https://n.example/a", "https://n.example/b"]
    # replaying the same batch (new checkpoint) changes nothing
    q2 = run_stream(read_feed_items(spark, land, stream=True).withColumn("language", F.lit("en")),
                    feed_items_batch(tables, ["en"]), ck + "2", {"availableNow": True})
    q2.awaitTermination(300)
    assert spark.read.parquet(os.path.join(tables, "web_resources")).count() == 2
    fi = spark.read.parquet(os.path.join(tables, "feed_items"))
    assert fi.count() == 2 and fi.select("web_resource_id").distinct().count() == 2


def test_health_stream_fold(spark):
    from newsflow.streaming.runner import health_batch, read_health, run_stream
    d = _scratch()
    land, state, ck = os.path.join(d, "att"), os.path.join(d, "health"), os.path.join(d, "ck")
    os.makedirs(land)
    schema = "source_id long, seq long, attempted_at timestamp, failed boolean, error string"
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, 1, t0, True, "a"), (1, 2, t0, True, "b")], schema).write.parquet(os.path.join(land, "b1"))
    stream = spark.readStream.schema(schema).parquet(os.path.join(land, "*"))
    run_stream(stream, health_batch(state, 2), ck, {"availableNow": True}).awaitTermination(300)
    assert read_health(spark, state).first().failures_count == 2
    spark.createDataFrame([(1, 3, t0, True, "c")], schema).write.parquet(os.path.join(land, "b2"))
    stream = spark.readStream.schema(schema).parquet(os.path.join(land, "*"))
    run_stream(stream, health_batch(state, 2), ck, {"availableNow": True}).awaitTermination(300)
    h = read_health(spark, state).first()
    assert (h.failures_count, h.enabled, h.last_error, h.attempts) == (3, False, "c", 3)


def test_decode_python_fallback(spark):
    """Without Java charsets the odd charsets go through the Arrow-batched decoder."""
    from newsflow.functions.text import decode_body
    spark.conf.set("spark.sql.legacy.javaCharsets", "false")
    try:
        df = spark.createDataFrame([(bytearray("café".encode("cp1252")), "text/html; charset=windows-1252")],
                                   "body binary, content_type string")
        assert df.select(decode_body().alias("t")).first().t == "café"
    finally:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
