"""Chain outcomes and branches, keyed result sinks, and nearest neighbours against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.operators.knn import detect_duplicates, distance, knn, read_vectors, write_vectors
from newsflow.operators.sinks import append_results, read_results
from newsflow.plans import chain as C
from newsflow.plans import literals as L

DAY = dt.date(2024, 1, 1)


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Scan ")


def test_chain_routes_by_outcome_and_keeps_plans_short(spark):
    rows = [(1, "the cat sat and the dog sat", "en", None, None), (2, "the cat sat and the dog sat", "en", None, None),
            (3, " ", "en", None, None), (4, "le chat et la souris", "fr", None, None),
            (5, "already done", "fr", "done", "en"), (6, "the end of it", "en", None, None), (7, "unlabelled zebra", "xx", None, None)]
    arts = spark.createDataFrame(rows, "id long, title string, language string, translated_title string, "
                                       "translation_language string").withColumn("publish_date", F.timestamp_seconds(F.lit(1.7e9)))
    done = spark.createDataFrame([(6,)], "web_article_id long")
    stop = lambda classes: F.size(F.coalesce(classes, F.array())) > 0
    run = C.run_chain(arts, [
        C.translation_stage(["fr"], "en", lexicon=L.frame(spark, L.LEXICON)),
        C.zero_shot_stage(L.frame(spark, L.TEMPLATES), L.frame(spark, L.LABELS), results=done),
        C.text_class_stage(L.frame(spark, L.KEYWORDS), should_continue=stop), C.geo_stage(L.frame(spark, L.GAZETTEER)),
        C.vector_stage(32), C.duplicate_stage(threshold=0.01, duplicates_to="copies"),
        C.extraction_stage(L.frame(spark, L.RULES))])
    found = {}
    for r in run.outcomes().collect():
        found.setdefault(r["id"], {})[r["stage"]] = r["outcome"]
    assert found[3] == {"translator": "skip"} and found[5] == {"translator": "skip"}
    assert found[4]["translator"] == "translated"
    assert found[6] == {"translator": "pass", "zero_shot_classifier": "skip"}        # a stored result ends the way
    assert found[7]["text_classifier"] == "stopped" and "geo_parser" not in found[7]  # refused by the hook
    assert found[1]["duplicate_detector"] == "original" and "information_extractor" in found[1]
    assert found[2]["duplicate_detector"] == "duplicate" and "information_extractor" not in found[2]
    assert [r["id"] for r in run.branches["copies"].collect()] == [2]
    translated = {r["id"]: r["translated_title"] for r in run.articles.collect()}
    assert translated[4].startswith("the chat and the") and translated[5] == "done" and translated[1] is None
    # every stage starts from one written table: the plan does not grow along the chain
    assert scans(run.articles) == 1
    assert {scans(df) for df in run.results.values()} == {1}


def test_translation_of_a_listed_target_language(spark):
    from newsflow.operators.models import translate
    a = spark.createDataFrame([(1, "le chat", "en", None, None)], "id long, title string, language string, "
                              "translated_title string, translation_language string")
    out = translate(a, ["en"], "en", lexicon=L.frame(spark, L.LEXICON)).first()
    assert (out["outcome"], out["translated_title"]) == ("translated", "le chat")


def test_results_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "classes")
    rows = spark.createDataFrame([(1, "t", "a", 0.5), (1, "t", "b", 0.5), (2, "t", "a", 1.0), (1, "t", "a", 0.7)],
                                 "web_article_id long, type string, label string, confidence float")
    append_results(rows, "text_classes", path, 0)
    append_results(rows, "text_classes", path, 0)                                       # replay
    append_results(rows.unionByName(rows.withColumn("label", F.lit("c"))), "text_classes", path, 1)
    append_results(rows.limit(0), "text_classes", path, 2)
    got = sorted((r["web_article_id"], r["label"], round(r["confidence"], 1)) for r in read_results(spark, "text_classes", path).collect())
    assert got == [(1, "a", 0.5), (1, "b", 0.5), (1, "c", 0.5), (2, "a", 1.0), (2, "c", 1.0)]


def test_vectors_are_stored_once(spark, tmp_path):
    path = str(tmp_path / "vectors")
    schema = "web_article_id long, data array<float>, publish_day date"
    day = [DAY + dt.timedelta(days=k) for k in range(3)]
    first = spark.createDataFrame([(1, [1.0], day[0]), (2, [2.0], day[0]), (3, [3.0], day[1]), (3, [3.0], day[1])], schema)
    write_vectors(first, path)
    write_vectors(first, path)
    write_vectors(spark.createDataFrame([(2, [9.0], day[0]), (4, [4.0], day[2])], schema), path)
    stored = lambda: sorted((r[0], r[1][0], r[2]) for r in read_vectors(spark, path).collect())
    assert stored() == [(1, 1.0, day[0]), (2, 2.0, day[0]), (3, 3.0, day[1]), (4, 4.0, day[2])]
    write_vectors(spark.createDataFrame([(2, [9.0], day[0]), (5, [5.0], day[0])], schema), path, replace=True)
    assert stored() == [(1, 1.0, day[0]), (2, 9.0, day[0]), (3, 3.0, day[1]), (4, 4.0, day[2]), (5, 5.0, day[0])]


@pytest.mark.parametrize("space, threshold", [("COSINE", 0.05), ("COSINE", 0.6), ("L2", 0.5), ("IP", -1.0)])
def test_neighbours_against_all_pairs(spark, space, threshold):
    """Clusters, equal vectors, a zero vector and a day that holds most rows, in blocks of eight."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 5))
    x = np.concatenate([c + 0.15 * rng.normal(size=(25, 5)) for c in centres] + [np.repeat(centres[:1], 30, axis=0), np.zeros((1, 5))])
    x = x.astype(np.float32)
    days = [DAY + dt.timedelta(days=int(k)) for k in rng.choice([0, 1, 5], len(x), p=[.6, .3, .1])]
    df = spark.createDataFrame([(i, d, v.tolist()) for i, (d, v) in enumerate(zip(days, x))], "id long, day date, data array<float>")
    q = df.where("id % 4 = 0").select("id", "day", "data").toDF("qid", "qday", "q")
    pairs = q.join(df, (F.col("qid") != F.col("id")) & F.col("day").between(F.date_sub("qday", 2), F.col("qday"))).select(
        "qid", "id", distance("q", "data", space).alias("d")).where((F.col("d") <= F.lit(threshold).cast("float")) & ~F.isnan("d"))
    want = {}
    for r in pairs.collect():
        want.setdefault(r["qid"], []).append((round(r["d"], 4), r["id"]))
    for k in (None, 3):
        hits = {}
        for r in knn(df.where("id % 4 = 0"), df, 2, threshold, space, k=k, block_rows=8, exclude_self=True).collect():
            hits.setdefault(r["qid"], []).append((r["rank"], round(r["distance"], 4), r["id"]))
        assert set(hits) == set(want)
        for qid, own in hits.items():
            best = sorted(want[qid])[:k]
            assert [d for _, d, _ in sorted(own)] == pytest.approx([d for d, _ in best], abs=2e-4)
            if k is None:
                assert {i for _, _, i in own} == {i for _, i in want[qid]}


def test_nearest_smaller_id_is_the_parent(spark):
    rows = [(i, [1.0, float(i % 3), 0.0]) for i in range(60)]
    vec = spark.createDataFrame([(i, v, DAY) for i, v in rows], "web_article_id long, data array<float>, publish_day date")
    arts = vec.select(F.col("web_article_id").alias("id"), F.col("publish_day").cast("timestamp").alias("publish_date"))
    got = {r["web_article_id"]: r["parent_id"] for r in detect_duplicates(arts, vec, None, 1, 0.001, block_rows=8).collect()}
    assert got == {i: (i % 3 if i >= 3 else None) for i in range(60)}
    none = vec.where("false")
    assert detect_duplicates(arts, none, None, 1, 0.1).count() == 0


def test_search_terms_by_their_rarest_trigram(spark):
    from newsflow.operators.ingest import tweets_of_sources
    texts = ["The cat", "THE DOG and the cat", "a.b (c) d", "ça été là", "x", None, "aaaa", "\nthe\n end"]
    tweets = spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(texts)], "upstream_id long, username string, text string")
    terms = ["the", "THE C", "b (", "été", "x", "aa", "aaa", "zzz", "the\n e", "A", "dog and", ""]
    sources = spark.createDataFrame([(k, "search", t, True, None) for k, t in enumerate(terms)],
                                    "id long, type string, text string, enabled boolean, deleted_at timestamp")
    got = sorted((r["twitter_source_id"], r["upstream_id"]) for r in tweets_of_sources(tweets, sources).collect())
    assert got == sorted((k, i) for k, q in enumerate(terms) for i, t in enumerate(texts) if t is not None and q.lower() in t.lower())


def test_malformed_bodies_are_isolated_in_every_charset(spark):
    from newsflow.functions.text import decode_charset
    rows = [(b"caf\xe9 \x80 \x81", "US-ASCII", "caf\xe9 € \x81"), (b"caf\xe9 \x93x\x94", "ISO-8859-1", "caf\xe9 “x”"),
            (b"abc\xff", "UTF-8", "abc�"), (b"\x00\x00\x00a\x00", "UTF-32", None), (b"\x83\x65\x81", "SHIFT_JIS", None),
            (b"a\x00b", "UTF-16LE", None), ("дом".encode("cp1251"), "WINDOWS-1251", "дом")]
    df = spark.createDataFrame([(b, c) for b, c, _ in rows], "body binary, charset string")
    for on in ("true", "false"):
        was = spark.conf.get("spark.sql.legacy.codingErrorAction")
        try:
            spark.conf.set("spark.sql.legacy.codingErrorAction", on)
            got = {r["charset"]: r["t"] for r in df.select("charset", decode_charset().alias("t")).collect()}
        finally:
            spark.conf.set("spark.sql.legacy.codingErrorAction", was)
        assert {c: got[c] for _, c, t in rows if t is not None} == {c: t for _, c, t in rows if t is not None}
        assert all(t is not None for t in got.values())


def test_times_without_zone_are_utc_on_any_machine(spark):
    import os
    import time
    from newsflow.functions.text import not_older_than
    from newsflow.operators.state import stale_pending
    was = os.environ.get("TZ")
    df = spark.sql("SELECT 1L AS id, TIMESTAMP '2024-01-10 00:00:00' AS created_at "
                   "UNION ALL SELECT 2L, TIMESTAMP '2024-01-09 23:59:59'")
    try:
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            os.environ["TZ"] = zone
            time.tzset()
            for at in (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))):
                kept = df.where(not_older_than("created_at", at)).select("id").collect()
                assert [r["id"] for r in kept] == [1]
        assert [r["id"] for r in stale_pending(df, dt.datetime(2024, 1, 10, 1), dt.timedelta(hours=1)).collect()] == [2]
    finally:
        os.environ.pop("TZ", None) if was is None else os.environ.update(TZ=was)
        time.tzset()


def test_updates_of_one_id_are_applied_in_turn(spark):
    from newsflow.operators.manage import apply_updates
    target = spark.createDataFrame([(1, "a", 3), (2, "b", 0)], "id long, url string, version long")
    updates = spark.createDataFrame([(1, "z", 1), (1, "m", 3), (1, "x", 2), (9, "q", 1)], "id long, url string, seq long")
    snapshot, missing = apply_updates(target, updates, dt.datetime(2024, 1, 1), order=["seq"])
    assert sorted(tuple(r) for r in snapshot.collect()) == [(1, "m", 6), (2, "b", 0)]
    assert [r["id"] for r in missing.collect()] == [9]
