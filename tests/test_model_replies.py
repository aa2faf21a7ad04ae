"""Error outcomes of classifier replies, models built once a worker, language detection in the row."""

import collections
import os
import tempfile

import pytest
from pyspark.sql import functions as F

TEMPLATES = [(1, "About {}.", False, True, None), (2, "Tone {}.", True, True, None), (3, "No labels {}.", False, True, None)]
LABELS = [(1, 1, "sport", True, None), (2, 1, "politics", True, None), (3, 2, "good", True, None)]
T_COLS = "id bigint, text string, multi_class boolean, enabled boolean, deleted_at timestamp"
L_COLS = "id bigint, zero_shot_hypothesis_template_id bigint, text string, enabled boolean, deleted_at timestamp"
REPLIES = "web_article_id long, template_id long, distribution array<struct<class:string,confidence:float>>"


@pytest.fixture(scope="module")
def config(spark):
    return spark.createDataFrame(TEMPLATES, T_COLS), spark.createDataFrame(LABELS, L_COLS)


@pytest.fixture(scope="module")
def articles(spark):
    rows = [(1, "sport news", None), (2, "x", None), (3, "y", None), (4, "z", None), (5, " ", None), (6, "w", None)]
    return spark.createDataFrame(rows, "id long, title string, translated_title string")


def test_replies_are_checked(spark, config, articles):
    from newsflow.operators.models import class_rows, classes_from_replies
    ok = [("politics", 0.7), ("sport", 0.3)]
    replies = spark.createDataFrame(
        [(1, 1, ok), (1, 2, [("good", 0.5)]), (2, 1, [("weather", 0.9)]), (2, 2, []), (3, 1, ok), (3, 2, []),
         (4, 1, ok), (6, 1, None), (6, 2, [("good", 0.5)])], REPLIES)
    checked = classes_from_replies(articles, *config, replies).cache()
    got = {r.id: (r.outcome, r.error, r.error_template_id) for r in checked.collect()}
    assert got == {1: ("classified", None, None), 2: ("error", "unknown class", 1), 3: ("error", "empty distribution", 2),
                   4: ("error", "no reply", 2), 6: ("error", "no reply", 1)}        # 5 has no title: not taken
    rows = sorted((r.web_article_id, r.zero_shot_hypothesis_template_id, r.zero_shot_hypothesis_label_id, r.best)
                  for r in class_rows(checked).collect())
    assert rows == [(1, 1, 1, False), (1, 1, 2, True), (1, 2, 3, True)]


def test_a_repeated_label_is_an_error_of_every_article(spark, config, articles):
    from newsflow.operators.models import classes_from_replies, zero_shot_classify
    from newsflow.plans import chain as C
    templates, labels = config
    twice = labels.unionByName(spark.createDataFrame([(9, 1, "sport", True, None)], L_COLS))
    replies = spark.createDataFrame([(1, 1, [("sport", 0.5)]), (1, 2, [("good", 0.5)])], REPLIES)
    first = classes_from_replies(articles.where("id = 1"), templates, twice, replies).first()
    assert (first.outcome, first.error, first.classes) == ("error", "duplicate label", [])
    assert zero_shot_classify(articles, templates, twice).count() == 0
    run = C.run_chain(articles, [C.zero_shot_stage(templates, twice)])
    assert {r.id: r.outcome for r in run.outcomes().collect()} == {
        1: "error", 2: "error", 3: "error", 4: "error", 5: "skip", 6: "error"}
    run = C.run_chain(articles.where("id in (1, 5)"), [C.zero_shot_stage(templates, labels, replies=replies)])
    assert {r.id: r.outcome for r in run.outcomes().collect()} == {1: "classified", 5: "skip"}


def test_no_template_and_no_article(spark, config, articles):
    from newsflow.operators.models import classes_from_replies
    templates, labels = config
    replies = spark.createDataFrame([], REPLIES)
    none = classes_from_replies(articles, templates.where("false"), labels, replies)
    assert {r.outcome for r in none.collect()} == {"none"}
    assert classes_from_replies(articles.where("false"), templates, labels, replies).count() == 0


def test_a_model_is_built_once_a_worker(spark, config, articles):
    from newsflow.operators.models import classes_from_replies, per_worker, zero_shot_replies
    folder = tempfile.mkdtemp(prefix="newsflow-hook-")

    def factory():
        import os
        import uuid
        open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()

        def model(pdf):
            out = pdf[["id", "template_id"]].copy()
            out["distribution"] = [[{"class": c, "confidence": 1.0} for c in labels] for labels in pdf["labels"]]
            return out
        return model
    many = spark.range(200).select("id", F.lit("a title").alias("title"), F.lit(None).cast("string").alias("translated_title"))
    many = many.repartition(24).checkpoint()
    replies = zero_shot_replies(many, *config, per_worker(factory))
    assert replies.count() == 400
    built = [f.split("-")[0] for f in os.listdir(folder)]
    assert built and max(collections.Counter(built).values()) == 1      # never twice in one worker
    assert len(built) < 24                                              # fewer than tasks
    assert {r.outcome for r in classes_from_replies(many, *config, replies).collect()} == {"classified"}


def _operators(plan):
    """Names of a plan's operators, without those of its scalar subqueries."""
    yield plan.nodeName()
    for i in range(plan.children().size()):
        yield from _operators(plan.children().apply(i))


def test_language_in_the_row_equals_counting(spark, profiles):
    """Whole texts, long ones too, against the out-of-place measure written out."""
    from newsflow.operators.lang import TOP, detect_language, normalized_text
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "42 !"), (-4, "a"), (-5, "the " * 30000), (-5, "und der")],
                                "doc_id long, text string")
    rows = detect_language(docs.unionByName(odd), "doc_id", "text", profiles, out="lang") \
        .select("doc_id", "lang", normalized_text("text").alias("norm"))
    assert not {"Exchange", "Generate", "HashAggregate", "Window"} & set(_operators(rows._jdf.queryExecution().executedPlan().initialPlan()))
    prof = collections.defaultdict(list)
    for r in profiles.collect():
        prof[r.trigram].append((r.lang, r["rank"]))
    n = 0
    for r in rows.collect():
        counts = collections.Counter(r.norm[i:i + 3] for i in range(len(r.norm) - 2)) if r.norm else {}
        score = collections.Counter()
        for k, (t, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:TOP], 1):
            for lang, rank in prof[t]:
                score[lang] += TOP - abs(k - rank)
        assert r.lang == min(score, key=lambda x: (-score[x], x), default=None), r.doc_id
        n += 1
    assert n == docs.count() + 6
