"""The article enrichment chain (ST-2, ST-3, M-11).

One frame of articles goes through the stages.  A stage sees the articles that
reached it and answers with an outcome for each: what happened, and which way it
goes on.  ``forward`` names that way: ``NEXT`` is the stage that follows, ``None``
is the end, and any other name leads to the branch of that name (duplicates and
originals part so).  The frame keeps one column ``outcome_<stage>`` a stage.  A simple
stage may give only the ids it forwards; the others then have the outcome 'stop'.

Between stages the frame is written into the shared folder of the session, so
the plan of a stage reads one table whatever came before, and an executor lost in
stage seven does not run the model of stage one again.  A stage writes its
result rows once: its outcomes and its table are then two reads of one evaluation.
Stages are plain functions, so a custom stage (M-11) is any callable of that shape.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import effective_title, has_text
from newsflow.session import stored_frame

NEXT = "next"


@dataclass
class StageResult:
    name: str
    results: DataFrame | None = None    # rows for the stage's result table
    forward: DataFrame | None = None    # (id) of the articles handed on, if there are no ``outcomes``
    articles: DataFrame | None = None   # updated article rows, if there are no ``changes``
    outcomes: DataFrame | None = None   # (id, outcome, forward), one row for each article that reached the stage
    changes: DataFrame | None = None    # (id, columns...): new values of article columns, one row an article


Stage = Callable[[DataFrame], StageResult]


@dataclass
class ChainRun:
    articles: DataFrame                                       # every article with its outcome_<stage> columns
    stages: list[str]
    results: dict[str, DataFrame] = field(default_factory=dict)
    branches: dict[str, DataFrame] = field(default_factory=dict)   # articles that left the chain by a named way
    steps: list[StageResult] = field(default_factory=list)

    def __getitem__(self, i: int) -> StageResult:
        return self.steps[i]

    def outcomes(self) -> DataFrame:
        """(id, stage_no, stage, outcome) of every stage that an article reached."""
        every = F.array(*[F.struct(F.lit(k).alias("stage_no"), F.lit(s).alias("stage"), F.col(f"outcome_{s}").alias("outcome"))
                          for k, s in enumerate(self.stages, 1)])
        return self.articles.select("id", F.explode(every).alias("s")).where("s.outcome IS NOT NULL").select("id", "s.*")


def run_chain(articles: DataFrame, stages: list[Stage], cut: Callable[[DataFrame], DataFrame] = stored_frame) -> ChainRun:
    """Run ``stages`` in order over ``articles`` (unique ``id``); ``cut`` writes the frame after each stage."""
    own = articles.columns
    frame = articles.withColumn("_way", F.lit(NEXT))
    run = ChainRun(frame, [])
    for stage in stages:
        reached = frame.where(F.col("_way") == NEXT).select(*own)
        res = stage(reached)
        run.steps.append(res)
        if res.results is not None:
            run.results[res.name] = res.results
        outcomes, changes = res.outcomes, res.changes
        if outcomes is None:
            on = res.forward.select("id").distinct().withColumn("_on", F.lit(True))
            outcomes = outcome(reached.select("id").join(on, "id", "left"), F.when(F.col("_on"), "forward").otherwise("stop"),
                               onward("forward"))
        if changes is None and res.articles is not None:
            changes = res.articles.select("id", *[c for c in own if c != "id" and c in res.articles.columns])
        step = outcomes.select("id", F.col("outcome").alias(f"outcome_{res.name}"), F.col("forward").alias("_to"))
        if changes is not None:
            new = [c for c in changes.columns if c != "id"]
            step = step.join(changes.select("id", F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in new]),
                             "id", "left")
        frame = frame.join(step, "id", "left")
        if changes is not None:
            frame = frame.withColumns({c: F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in new})
            frame = frame.drop("_new", *[f"_new_{c}" for c in new])
        # an article that did not reach the stage keeps the way it left by
        frame = cut(frame.withColumn("_way", F.when(F.col("_way") == NEXT, F.col("_to")).otherwise(F.col("_way"))).drop("_to"))
        run.stages.append(res.name)
    run.articles = frame.drop("_way")
    for (name,) in frame.where(F.col("_way") != NEXT).select("_way").distinct().collect():  # ways are few names of the code
        run.branches[name] = frame.where(F.col("_way") == name).select(*own)
    return run


def outcome(articles: DataFrame, route: Column, forward: Column) -> DataFrame:
    """(id, outcome, forward) by the outcome's name."""
    return articles.withColumn("outcome", route).select("id", "outcome", forward.alias("forward"))


def onward(*names: str) -> Column:
    """Articles with one of these outcomes go to the next stage, the others nowhere."""
    return F.when(F.col("outcome").isin(*names), F.lit(NEXT))


def settled(articles: DataFrame, results: DataFrame | None, rows: DataFrame, found: str,
            key: str = "web_article_id") -> DataFrame:
    """Articles as 'skip' (a stored result, F-11, or a blank title, F-10), ``found`` (rows were made) or 'none'."""
    own = articles.select("id", has_text(effective_title()).alias("_text"))
    made = rows.select(F.col(key).alias("id")).distinct().withColumn("_made", F.lit(True))
    own = own.join(made, "id", "left")
    if results is not None:
        own = own.join(results.select(F.col(key).alias("id")).distinct().withColumn("_done", F.lit(True)), "id", "left")
    else:
        own = own.withColumn("_done", F.lit(None).cast("boolean"))
    route = F.when(F.col("_done") | ~F.coalesce("_text", F.lit(False)), "skip").when(F.col("_made"), found).otherwise("none")
    return outcome(own, route, onward(found, "none"))


# ------------------------------------------------------------- standard stages

def translation_stage(langs, target="en", lexicon=None, model=None) -> Stage:
    from newsflow.operators.models import translate

    def stage(a: DataFrame) -> StageResult:
        t = stored_frame(translate(a, langs, target, lexicon=lexicon, model=model)
                        .select("id", "outcome", "translated_title", "translation_language"))
        return StageResult("translator", outcomes=outcome(t, F.col("outcome"), onward("pass", "translated")),
                           changes=t.where("outcome = 'translated'").drop("outcome"))
    return stage


def zero_shot_stage(templates, labels, results=None, model=None, replies=None) -> Stage:
    """An article whose reply or labels are at fault ends here as 'error' and has no rows (J-13).

    ``replies`` (see ``classes_from_replies``) takes the place of the default scores and of ``model``.
    """
    from newsflow.operators.models import class_rows, classes_from_replies, repeated_label, zero_shot_classify

    def from_replies(a: DataFrame) -> StageResult:
        checked = stored_frame(classes_from_replies(a, templates, labels, replies, results))
        own = a.select("id").join(checked.select("id", F.col("outcome").alias("_o")), "id", "left")
        return StageResult("zero_shot_classifier", class_rows(checked), outcomes=outcome(
            own, F.coalesce("_o", F.lit("skip")), onward("classified", "none")))

    def stage(a: DataFrame) -> StageResult:
        if replies is not None:
            return from_replies(a)
        rows = stored_frame(zero_shot_classify(a, templates, labels, results, model))
        out = settled(a, results, rows, "classified")
        bad = repeated_label(templates, labels) & (F.col("outcome") != "skip")
        return StageResult("zero_shot_classifier", rows, outcomes=out.select(
            "id", F.when(bad, "error").otherwise(F.col("outcome")).alias("outcome"),
            F.when(~bad, F.col("forward")).alias("forward")))
    return stage


def text_class_stage(keywords=None, results=None, model=None, should_continue=None) -> Stage:
    """M-10: an article that ``should_continue`` refuses ends here as 'stopped', its classes are stored all the same."""
    from newsflow.operators.models import classify_text

    def stage(a: DataFrame) -> StageResult:
        rows, go = classify_text(a, keywords, results, model, should_continue)
        rows = stored_frame(rows)
        out = settled(a, results, rows, "classified")
        if should_continue is not None:
            go = go.select(F.col("web_article_id").alias("id"), F.lit(True).alias("_go"))
            stop = F.col("forward").isNotNull() & F.col("_go").isNull()
            out = out.join(go, "id", "left").select(
                "id", F.when(stop, "stopped").otherwise(F.col("outcome")).alias("outcome"),
                F.when(~stop, F.col("forward")).alias("forward"))
        return StageResult("text_classifier", rows, outcomes=out)
    return stage


def geo_stage(gazetteer) -> Stage:
    """An article that has a country leaves the chain; one without a find goes on."""
    from newsflow.operators.geo import geo_parse

    def stage(a: DataFrame) -> StageResult:
        known = F.col("country_code").isNotNull() if "country_code" in a.columns else F.lit(False)
        found = stored_frame(geo_parse(a.where(~known), gazetteer).where("country_code IS NOT NULL"))
        own = a.select("id", known.alias("_known")).join(found.select("id", F.lit(True).alias("_made")), "id", "left")
        route = F.when(F.col("_known"), "skip").when(F.col("_made"), "found").otherwise("none")
        return StageResult("geo_parser", found, outcomes=outcome(own, route, onward("found", "none")),
                           changes=found if "country_code" in a.columns else None)
    return stage


def vector_stage(dim=64, results=None, model=None) -> Stage:
    from newsflow.operators.models import vectorize

    def stage(a: DataFrame) -> StageResult:
        rows = stored_frame(vectorize(a, dim, results, model))
        out = settled(a, results, rows, "vectorized")
        # a hook that gives no vector for a title ends the article's way
        return StageResult("vectorizer", rows, outcomes=out.withColumn("forward", F.when(F.col("outcome") == "vectorized", NEXT)))
    return stage


def duplicate_stage(vectors: DataFrame | None = None, similarity_infos=None, timeframe_days=3, threshold=0.3,
                    duplicates_to: str | None = None, vector_of=None, dim=32) -> Stage:
    """ST-3's fork: originals go on, duplicates go to ``duplicates_to`` (nowhere by default, ``NEXT`` to keep them).

    ``vectors`` are the stored vectors, those of this run included.  Without them the
    vectors of the articles at hand are computed by ``vector_of`` (default: ``vectorize``).
    """
    from newsflow.operators.knn import detect_duplicates
    from newsflow.operators.models import vectorize

    def stage(a: DataFrame) -> StageResult:
        known = vectors if vectors is not None else stored_frame((vector_of or (lambda x: vectorize(x, dim)))(a))
        rows = stored_frame(detect_duplicates(a, known, similarity_infos, timeframe_days, threshold))
        own = a.select("id").join(rows.select(F.col("web_article_id").alias("id"), "parent_id", F.lit(True).alias("_made")),
                                  "id", "left")
        route = (F.when(F.col("_made").isNull(), "skip").when(F.col("parent_id").isNull(), "original")
                 .otherwise("duplicate"))
        way = onward("original") if duplicates_to is None else F.when(
            F.col("outcome") == "duplicate", F.lit(duplicates_to)).otherwise(onward("original"))
        return StageResult("duplicate_detector", rows, outcomes=outcome(own, route, way))
    return stage


def extraction_stage(rules, results=None, model=None) -> Stage:
    from newsflow.operators.models import extract_info

    def stage(a: DataFrame) -> StageResult:
        rows = stored_frame(extract_info(a, rules, results, model))
        return StageResult("information_extractor", rows, outcomes=settled(a, results, rows, "extracted"))
    return stage
