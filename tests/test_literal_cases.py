"""Literal cases of the reference tests and boundary cases taken from its code (FIXTURES.md part 1)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F


def _vec_at(d):
    """2-d unit vector at cosine distance ``d`` from (1, 0)."""
    c = 1.0 - d
    return [c, math.sqrt(max(0.0, 1.0 - c * c))]


def test_day_key_berlin(spark):
    from newsflow.operators.knn import day_key
    df = spark.createDataFrame([("2000-02-02T00:00:00+01:00",)], "s string")
    out = df.select(day_key(F.to_timestamp("s"), "test_").alias("k")).first()["k"]
    assert out == "test_2000-02-01"


def _knn(spark, cands, q_day, days, t):
    from newsflow.operators.knn import knn
    q = spark.createDataFrame([(1000, dt.date.fromisoformat(q_day), [1.0, 0.0])], "id long, day date, data array<double>")
    c = spark.createDataFrame([(i, dt.date.fromisoformat(day), _vec_at(d)) for i, day, d in cands],
                              "id long, day date, data array<double>")
    rows = knn(q, c, days, t).orderBy("rank").collect()
    return [(r["id"], round(r["distance"], 4)) for r in rows]


def test_knn_one_day_threshold(spark):
    got = _knn(spark, [(33, "2000-02-01", .6), (22, "2000-02-01", .4), (11, "2000-02-01", .2)], "2000-02-01", 0, 0.5)
    assert got == [(11, .2), (22, .4)]


def test_knn_many_days_missing_day(spark):
    cands = [(1, "2000-02-01", .1), (2, "2000-02-01", .3), (3, "2000-02-01", .6),
             (4, "2000-02-02", .2), (5, "2000-02-02", .4), (6, "2000-02-02", .7),
             (7, "2000-02-04", .3), (8, "2000-02-04", .8), (9, "2000-02-04", .9)]
    assert _knn(spark, cands, "2000-02-04", 3, 0.5) == [(1, .1), (4, .2), (2, .3), (7, .3), (5, .4)]


def test_knn_no_partition(spark):
    assert _knn(spark, [(1, "1999-01-01", .1)], "2000-02-04", 3, 0.5) == []


def test_knn_threshold_equality_kept(spark):
    assert _knn(spark, [(5, "2000-02-01", .5)], "2000-02-01", 0, 0.5) == [(5, .5)]


def test_retention(spark):
    from newsflow.operators.knn import retain
    days = ["2000-01-30", "2000-01-31", "2000-02-01", "2000-02-02"]
    v = spark.createDataFrame([(i, dt.date.fromisoformat(d)) for i, d in enumerate(days)], "web_article_id long, publish_day date")
    kept, gone = retain(v, dt.datetime(2000, 2, 4, 10), 3)
    assert sorted(str(r[0]) for r in gone.select("publish_day").collect()) == ["2000-01-30", "2000-01-31"]
    assert kept.count() == 2


def test_hit_order(spark):
    hits = spark.createDataFrame([(4, 40.0), (1, 10.0), (3, 23.0), (1, 11.0), (2, 23.0)], "id long, distance double")
    got = [(r.id, r.distance) for r in hits.orderBy("distance", "id").collect()]
    assert got == [(1, 10.0), (1, 11.0), (2, 23.0), (3, 23.0), (4, 40.0)]
    top = hits.agg(F.min(F.struct("distance", "id")).alias("h")).first()["h"]
    assert (top["id"], top["distance"]) == (1, 10.0)


def test_distance_names():
    from newsflow.operators.knn import check_space
    for ok in ("L2", "IP", "COSINE"):
        assert check_space(ok) == ok
    for bad in ("", " ", "foo"):
        with pytest.raises(ValueError):
            check_space(bad)


def test_language_detection(spark, profiles):
    from newsflow.operators.lang import detect_language
    df = spark.createDataFrame([(1, ""), (2, " \t\n"), (3, "42"), (4, "this is my text")], "id long, t string")
    got = {r.id: r.detected_language for r in detect_language(df, "id", "t", profiles).collect()}
    assert got == {1: None, 2: None, 3: None, 4: "en"}


def test_geo_reply(spark):
    from newsflow.operators.geo import geo_from_reply
    js = ('{"results":{"places":{"focus":{"cities":[{"countryCode":"AD","score":0.1},{"countryCode":"AE","score":0.2}],'
          '"countries":[{"countryCode":"BA","score":0.3},{"countryCode":"BB","score":0.4}],'
          '"states":[{"countryCode":"CC","score":0.5},{"countryCode":"CD","score":0.6}]}}}}')
    r = geo_from_reply(spark.createDataFrame([(js,)], "reply string")).first()
    assert [l["countryCode"] for l in r["locations"]] == ["AD", "AE", "BA", "BB", "CC", "CD"]
    assert r["country_code"] == "CD"


def test_best_location_tie_keeps_first(spark):
    from newsflow.operators.geo import geo_from_reply
    js = ('{"results":{"places":{"focus":{"cities":[{"countryCode":"AA","score":0.5}],'
          '"countries":[{"countryCode":"BB","score":0.5}],"states":[]}}}}')
    assert geo_from_reply(spark.createDataFrame([(js,)], "reply string")).first()["country_code"] == "AA"


def test_regexp_check(spark):
    from newsflow.operators.manage import validate_rules
    rules = spark.createDataFrame([(1, ""), (2, "foo (bar) [a-z]? baz"), (3, "(")], "id long, answer_regexp string")
    valid, invalid = validate_rules(rules)
    assert sorted(r.id for r in valid.collect()) == [1, 2]
    assert [r.id for r in invalid.collect()] == [3]


def test_re2_rewrite():
    from newsflow.operators.manage import re2_to_java
    assert re2_to_java("(?P<x>a)$") == r"(?:a)\z"
    assert re2_to_java("(?i)é") == "(?iu)é"
    assert re2_to_java("^[[:alpha:]]") == r"^[\p{Alpha}]"
    assert re2_to_java(r"a\$") == r"a\$"


def test_string_set(spark):
    df = spark.range(1).select(F.array().cast("array<string>").alias("s"))
    df = df.select(F.array_union("s", F.array(F.lit("foo"), F.lit("bar"))).alias("s"))
    df = df.select(F.array_remove("s", "foo").alias("s"))
    assert df.first()["s"] == ["bar"]


# ------------------------------------------------------------ boundary cases from code

def test_null_date_kept_and_strict_cutoff(spark):
    from newsflow.functions.text import not_older_than
    cut = dt.datetime(2024, 1, 10)
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 10)), (3, dt.datetime(2024, 1, 9))], "id long, p timestamp")
    assert sorted(r.id for r in df.where(not_older_than("p", cut)).collect()) == [1, 2]


def test_allow_list_asymmetry(spark):
    from newsflow.functions.text import code_allowed, language_allowed
    df = spark.createDataFrame([("en", "04")], "l string, c string")
    assert df.where(language_allowed("l", [])).count() == 0
    assert df.where(code_allowed("c", [])).count() == 1


def test_disabled_at_max_plus_one(spark):
    from newsflow.operators.state import source_health
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, i, t0 + dt.timedelta(minutes=i), True, f"e{i}") for i in range(1, 6)]
    h = source_health(spark.createDataFrame(rows, "source_id long, seq long, attempted_at timestamp, failed boolean, error string"), 3).first()
    assert (h.failures_count, h.enabled, h.last_error) == (4, False, "e4")
    h2 = source_health(spark.createDataFrame(rows[:3], "source_id long, seq long, attempted_at timestamp, failed boolean, error string"), 3).first()
    assert (h2.failures_count, h2.enabled) == (3, True)


def test_success_resets(spark):
    from newsflow.operators.state import source_health
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, 1, t0, True, "a"), (1, 2, t0 + dt.timedelta(hours=1), False, None), (1, 3, t0 + dt.timedelta(hours=2), True, "b")]
    h = source_health(spark.createDataFrame(rows, "source_id long, seq long, attempted_at timestamp, failed boolean, error string"), None).first()
    assert (h.failures_count, h.last_error, h.last_retrieved_at, h.enabled) == (1, "b", t0 + dt.timedelta(hours=1), True)


def test_health_fold_carries_state(spark):
    from newsflow.operators.state import source_health
    t0 = dt.datetime(2024, 1, 1)
    schema = "source_id long, seq long, attempted_at timestamp, failed boolean, error string"
    init = spark.createDataFrame([(1, 2, "x", None, True, 2), (2, 9, "y", None, False, 9)],
                                 "source_id long, failures_count int, last_error string, last_retrieved_at timestamp, enabled boolean, attempts long")
    batch = spark.createDataFrame([(1, 10, t0, True, "z"), (2, 11, t0, False, None)], schema)
    got = {r.source_id: r for r in source_health(batch, 2, initial=init).collect()}
    assert (got[1].failures_count, got[1].enabled) == (3, False)
    assert (got[2].failures_count, got[2].enabled) == (9, False)      # disabled stays disabled


def test_self_and_larger_ids_never_parents(spark):
    from newsflow.operators.knn import detect_duplicates
    day = dt.date(2024, 1, 1)
    arts = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 1, 6))], "id long, publish_date timestamp")
    vec = spark.createDataFrame([(1, [1.0, 0.0], day), (2, [1.0, 0.0], day)], "web_article_id long, data array<float>, publish_day date")
    got = {r.web_article_id: r.parent_id for r in detect_duplicates(arts, vec, None, 3, 0.3).collect()}
    assert got == {1: None, 2: 1}


def test_blank_translation_drops_article(spark):
    from newsflow.operators.models import with_title
    df = spark.createDataFrame([(1, "a title", " "), (2, "another", None)], "id long, title string, translated_title string")
    assert [r.id for r in with_title(df).collect()] == [2]


def test_confidence_equality_passes(spark):
    from newsflow.operators.models import extract_info
    arts = spark.createDataFrame([(1, "The cat sat.", None)], "id long, title string, translated_title string")
    rules = spark.createDataFrame([(7, "cat sat", "", 1.0, True, None)],
                                  "id long, question string, answer_regexp string, threshold float, enabled boolean, deleted_at timestamp")
    got = extract_info(arts, rules).collect()
    assert [(r.info_extraction_rule_id, r.text, r.confidence) for r in got] == [(7, "the cat sat", 1.0)]


def test_unicode_trim(spark):
    from newsflow.functions.text import go_trim
    df = spark.createDataFrame([("   title 　\n",)], "s string")
    assert df.select(go_trim("s").alias("t")).first()["t"] == "title"


def test_parse_id_accepts_only_plain_digits(spark):
    from newsflow.functions.text import parse_id
    texts = ["825", "0", "9223372036854775807", "9223372036854775808", "99999999999999999999",
             "+1", "-1", " 1", "1 ", "12\n", "1.0", "0x1f", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", parse_id("t").alias("p")).orderBy("i").collect()
    got = [(r.p.id, r.p.error is not None) for r in rows]
    assert got[:3] == [(825, False), (0, False), (9223372036854775807, False)]
    assert all(g == (None, True) for g in got[3:-1])
    assert got[-1] == (None, False)
