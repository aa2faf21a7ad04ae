"""Hooks, sinks and management paths not covered by the oracle queries."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F


def test_write_and_purge_vectors(spark):
    from newsflow.operators.knn import expired_days, purge_vectors, write_vectors
    d = tempfile.mkdtemp(prefix="newsflow-vec-")
    path = os.path.join(d, "vectors")
    rows = [(i, [1.0, 0.0], dt.date(2000, 1, 29) + dt.timedelta(days=i)) for i in range(5)]
    write_vectors(spark.createDataFrame(rows, "web_article_id long, data array<float>, publish_day date"), path)
    assert len(os.listdir(path)) >= 5
    now = dt.datetime(2000, 2, 4)
    assert [p.rsplit("=", 1)[1] for p in expired_days(spark, path, now, 3)] == ["2000-01-29", "2000-01-30", "2000-01-31"]
    purge_vectors(spark, path, now, 3)
    assert sorted(str(r.publish_day) for r in spark.read.parquet(path).collect()) == ["2000-02-01", "2000-02-02"]


def test_custom_top_hit_selection(spark):
    from newsflow.operators.knn import detect_duplicates
    day = dt.date(2024, 1, 1)
    arts = spark.createDataFrame([(3, dt.datetime(2024, 1, 1, 9))], "id long, publish_date timestamp")
    vec = spark.createDataFrame([(1, [1.0, 0.0], day), (2, [0.9, 0.1], day), (3, [1.0, 0.0], day)],
                                "web_article_id long, data array<float>, publish_day date")
    # pick the hit with the largest id instead of the nearest one
    pick_last = lambda hits: F.element_at(hits, -1)
    r = detect_duplicates(arts, vec, None, 1, 0.5, select_top_hit=pick_last).first()
    assert r.parent_id == 2
    assert detect_duplicates(arts, vec, None, 1, 0.5).first().parent_id == 1


def test_custom_stage_in_chain(spark):
    from newsflow.plans.chain import StageResult, run_chain
    arts = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "ccc")], "id long, title string")

    def long_titles(a):
        keep = a.where(F.length("title") >= 2)
        return StageResult("custom", keep, keep.select("id"))

    def count_stage(a):
        return StageResult("count", a.groupBy().count(), a.select("id"))
    res = run_chain(arts, [long_titles, count_stage])
    assert res[1].results.first()[0] == 2


def test_numeric_id_parse_fails_loudly(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("12x",)], "s string").select(F.col("s").cast("long")).collect()


def test_feed_language_wins_over_detection(spark, profiles):
    from newsflow import schemas
    from newsflow.operators.ingest import articles_from_pages
    html = "<html><head><title>this is my text</title></head><body>x</body></html>"
    pages = spark.createDataFrame([(1, html), (2, html.replace("my text", "the other text"))], "web_resource_id long, text string")
    res = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "u1"), (2, dt.datetime(2024, 1, 2), "u2")],
                                "id long, created_at timestamp, url string")
    fi = spark.createDataFrame([(1, "Feed title", "de", dt.datetime(2023, 12, 31))],
                               "web_resource_id long, title string, language string, published_at timestamp")
    out = {r.web_resource_id: r for r in articles_from_pages(
        pages, res, schemas.empty(spark, "web_articles"), fi, schemas.empty(spark, "gdelt_events"),
        langs=["de", "en"], profiles=profiles).collect()}
    assert (out[1].language, out[1].title, out[1].publish_date) == ("de", "Feed title", dt.datetime(2023, 12, 31))
    assert (out[2].language, out[2].publish_date) == ("en", dt.datetime(2024, 1, 2))


def test_label_create_requires_template(spark):
    from newsflow import schemas
    from newsflow.operators.manage import apply_creates
    templates = spark.createDataFrame([(1,)], "id long")
    labels = schemas.empty(spark, "zero_shot_hypothesis_labels")
    creates = spark.createDataFrame([(1, "a", True), (9, "b", True), (1, "a", True)],
                                    "zero_shot_hypothesis_template_id long, text string, enabled boolean")
    _, created = apply_creates(labels, creates, [["zero_shot_hypothesis_template_id", "text"]], dt.datetime(2024, 1, 1),
                               parent=(templates, "zero_shot_hypothesis_template_id"))
    rows = created.collect()
    assert [(r.id, r.text) for r in rows] == [(1, "a")]


def test_label_creates_without_a_live_template_are_reported(spark):
    from newsflow import schemas
    from newsflow.operators.manage import apply_creates, missing_parents
    fk = "zero_shot_hypothesis_template_id"
    templates = spark.createDataFrame([(1, None), (2, dt.datetime(2023, 5, 1))], "id long, deleted_at timestamp")
    creates = spark.createDataFrame([(1, "a", True), (2, "b", True), (9, "c", True), (None, "d", True)],
                                    f"{fk} long, text string, enabled boolean")
    _, created = apply_creates(schemas.empty(spark, "zero_shot_hypothesis_labels"), creates, [[fk, "text"]],
                               dt.datetime(2024, 1, 1), parent=(templates, fk))
    assert [r.text for r in created.collect()] == ["a"]
    assert sorted(r.text for r in missing_parents(creates, (templates, fk)).collect()) == ["b", "c", "d"]


def test_versioned_update_stale(spark):
    from newsflow.operators.sinks import versioned_update
    t = spark.createDataFrame([(1, 0, "a"), (2, 3, "b")], "id long, version long, url string")
    u = spark.createDataFrame([(1, 0, "a2"), (2, 2, "b2"), (7, 0, "x")], "id long, base_version long, url string")
    snap, applied, stale = versioned_update(t, u)
    assert {(r.id, r.version, r.url) for r in snap.collect()} == {(1, 1, "a2"), (2, 3, "b")}
    assert sorted(r.id for r in stale.collect()) == [2, 7]


def test_model_hook_runs_in_batches(spark):
    import pandas as pd
    from newsflow.operators.models import translate
    arts = spark.createDataFrame([(1, "hola mundo", "es", None, None)],
                                 "id long, title string, language string, translated_title string, translation_language string")

    def model(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(translated_title=pdf["title"].str.upper())
    r = translate(arts, ["es"], "en", model=model).first()
    assert (r.translated_title, r.translation_language, r.outcome) == ("HOLA MUNDO", "en", "translated")


def test_blocking_does_not_change_results(spark):
    """Tiny blocks (many block pairs per day range) give the same hits and parents as one block per day."""
    from newsflow.operators.knn import detect_duplicates, knn
    from newsflow.plans import testbed as TB
    d = "/root/testdata/sf0.001"
    v = TB.vectors(spark, d).where(F.col("publish_day") <= F.lit("2024-01-04").cast("date"))
    q = v.select(F.col("web_article_id").alias("id"), F.col("publish_day").alias("day"), "data")
    # BLAS sums block shapes in different orders: compare distances to 5 digits
    sel = lambda h: {(r.qid, r.id, round(r.distance, 5)) for r in h.select("qid", "id", "distance").collect()}
    a = sel(knn(q, q, 3, 0.7, block_rows=3))
    b = sel(knn(q, q, 3, 0.7, block_rows=10_000))
    assert a == b and len(a) > 0
    arts = TB.vector_articles(spark, d)
    dd = lambda br: {(r.web_article_id, r.parent_id, None if r.distance is None else round(r.distance, 5))
                     for r in detect_duplicates(arts, v, None, 3, 0.7, block_rows=br).collect()}
    x, y = dd(3), dd(10_000)
    assert x == y


def test_health_blocks_do_not_change_results(spark):
    """Tiny seq blocks (the failure runs and the disabling attempt cross block edges) give the
    same health as one block per source, with and without a carried initial state."""
    from newsflow.operators.state import source_health
    from newsflow.plans import testbed as TB
    att = TB.fetch_attempts(spark, "/root/testdata/sf0.001")
    init = source_health(att.where("seq % 3 = 0"), 2).select(
        "source_id", "failures_count", "last_error", "last_retrieved_at", "enabled")
    def run(width, mx, initial=None):
        return sorted(tuple(r) for r in source_health(att, mx, block_width=width, initial=initial).collect())
    for mx in (2, 5, None):
        ref = run(1 << 20, mx)
        assert ref and all(run(w, mx) == ref for w in (1, 2, 3, 7))
    ref = run(1 << 20, 3, init)
    assert all(run(w, 3, init) == ref for w in (1, 3))


def test_detection_keeps_every_row(spark, profiles):
    """Rows without letters (NULL, empty, digits) come back with a NULL language; other columns are untouched."""
    from newsflow.operators.lang import detect_language
    df = spark.createDataFrame([(1, "the cat sat on the mat with the other cats", "a"), (2, None, "b"),
                                (3, "", "c"), (4, "1234 5678", None)], "id long, title string, extra string")
    got = {r.id: (r.extra, r.detected_language) for r in detect_language(df, "id", "title", profiles).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1][0] == "a" and got[1][1] is not None
    assert got[2] == ("b", None) and got[3] == ("c", None) and got[4] == (None, None)
