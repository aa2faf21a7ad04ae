"""Model-backed enrichment stages (M-1..M-3, M-6, M-8, M-10, J-6, J-9, J-10, J-13, P-10, A-7, W-1, F-13, F-15).

Each operator takes an optional ``model``: a Python callable over pandas
batches, run through ``mapInPandas`` (Arrow batches; ``per_worker`` builds one once per
Python worker).  Without a model, a deterministic default runs in the JVM, its counts of
tokens and trigrams in NumPy, so results are reproducible and checkable by SQL.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from newsflow.functions.text import effective_title, go_trim, has_text, language_allowed
from newsflow.operators.common import bounded_broadcast, small_batches
from newsflow.operators.lang import letters_of, trigrams, trigrams_among
from newsflow.operators.side import explode_side, side_rows

PandasModel = Callable[[pd.DataFrame], pd.DataFrame]


def tokens(col) -> Column:
    """Lower-case letter/digit tokens of a text (whole text)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(F.lower(col), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) > 0)


def _run_model(df: DataFrame, model: PandasModel, schema: str) -> DataFrame:
    def apply(batches):
        for pdf in batches:
            yield model(pdf)
    return df.mapInPandas(apply, schema)


def per_worker(factory: Callable[[], PandasModel]) -> PandasModel:
    """A hook whose model ``factory()`` builds once in each Python worker, however many batches and tasks it serves.

    Only the factory is pickled.  The models of a worker live in a module of their own,
    because a hook is unpickled anew for every task; the library itself need not be
    importable there.
    """
    key = uuid.uuid4().hex

    def hook(pdf: pd.DataFrame) -> pd.DataFrame:
        import sys
        import types
        models = sys.modules.setdefault("newsflow_worker_models", types.ModuleType("newsflow_worker_models")).__dict__
        if key not in models:
            models[key] = factory()
        return models[key](pdf)
    return hook


def pending_for(articles: DataFrame, results: DataFrame | None, key: str = "web_article_id") -> DataFrame:
    """F-11: articles without a stored result of this stage."""
    if results is None:
        return articles
    done = results.select(F.col(key).alias("id")).distinct()
    return articles.join(done, "id", "left_anti")


def with_title(articles: DataFrame) -> DataFrame:
    """P-5 + F-10: effective title, articles with a blank one leave the chain."""
    return articles.withColumn("title_eff", effective_title()).where(has_text("title_eff"))


# ----------------------------------------------------------------- M-1

def translate(articles: DataFrame, langs: list[str], target: str = "en",
              lexicon: DataFrame | None = None, model: PandasModel | None = None) -> DataFrame:
    """M-1: set ``translated_title`` and ``translation_language``.

    Already translated articles (both fields set) and blank titles are
    skipped; articles whose language is not white-listed pass through unchanged
    with ``outcome='pass'``; a white-listed one is translated even if its language
    is the target's.  The default model
    replaces each token found in ``lexicon(lang, source, target)``.
    Returns all input rows with an ``outcome`` column: skip / pass / translated.
    """
    done = F.col("translated_title").isNotNull() & F.col("translation_language").isNotNull()
    blank = ~has_text(go_trim("title"))
    route = (F.when(done, F.lit("skip")).when(blank, F.lit("skip"))
             .when(~language_allowed("language", langs), F.lit("pass"))
             .otherwise(F.lit("translate")))
    staged = articles.withColumn("outcome", route)
    todo = staged.where("outcome = 'translate'")
    rest = staged.where("outcome <> 'translate'")
    if model is not None:
        out_schema = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in todo.schema.fields)
        translated = _run_model(todo, model, out_schema)
    else:
        if lexicon is None:
            raise ValueError("the default translator needs a lexicon(lang, source, target)")
        lex = bounded_broadcast(lexicon.select("lang", "source", "target"))
        words = (todo.select("id", "language", F.posexplode(F.split(go_trim("title"), r"\s+")).alias("pos", "word"))
                 .withColumn("source", F.lower(F.regexp_replace("word", r"[^\p{L}\p{N}]", ""))))
        mapped = (words.join(lex, (words.language == lex.lang) & (words.source == lex.source), "left")
                  .select("id", "pos", F.coalesce(lex.target, words.word).alias("w")))
        joined = mapped.groupBy("id").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "w"))), lambda s: s["w"]), " ")
            .alias("_tt"))
        translated = (todo.join(joined, "id", "left")
                      .withColumn("translated_title", go_trim("_tt")).drop("_tt"))
    translated = (translated.withColumn("translation_language", F.lit(target))
                  .withColumn("outcome", F.when(has_text("translated_title"), F.lit("translated"))
                              .otherwise(F.lit("error"))))
    return rest.unionByName(translated.select(*rest.columns))


# ----------------------------------------------------------------- M-2

def hypotheses(templates: DataFrame, labels: DataFrame) -> DataFrame:
    """J-6 + P-10 + J-13: enabled live templates x their enabled live labels.

    A template without an enabled label yields nothing; ``dup_label`` flags
    a label text repeated within a template (an error in the stage).
    """
    t = templates.where("enabled AND deleted_at IS NULL").select(
        F.col("id").alias("template_id"), F.col("text").alias("template"), "multi_class")
    l = labels.where("enabled AND deleted_at IS NULL").select(
        F.col("id").alias("label_id"), F.col("zero_shot_hypothesis_template_id").alias("template_id"),
        F.col("text").alias("label"))
    h = t.join(l, "template_id")
    w = Window.partitionBy("template_id", "label")
    return h.select("template_id", "label_id", "label", "multi_class",
                    F.replace("template", F.lit("{}"), F.col("label")).alias("hypothesis"),
                    (F.count(F.lit(1)).over(w) > 1).alias("dup_label"))


def default_nli_logit(premise="title_eff", label="label") -> Column:
    """Default entailment score: distinct label trigrams found in the premise."""
    return F.size(F.array_intersect(F.coalesce(trigrams(premise), F.array()),
                                    F.coalesce(trigrams(label), F.array()))).cast("double")


def zero_shot_classify(articles: DataFrame, templates: DataFrame, labels: DataFrame,
                       results: DataFrame | None = None, model: PandasModel | None = None) -> DataFrame:
    """M-2: rows (web_article_id, label id, template id, best, confidence).

    Single-label templates: softmax over the template's labels (A-7);
    multi-class templates: independent sigmoid.  ``best`` marks the first
    label of the descending distribution, ties by label id (W-1).  A label text
    repeated within a template is an error of every article (J-13): no rows.
    """
    arts = with_title(pending_for(articles, results)).select("id", "title_eff")
    arts = arts.where(~repeated_label(templates, labels))
    hyp = hypotheses(templates, labels).drop("dup_label")
    if model is not None:
        pairs = explode_side(arts, hyp)
        scored = _run_model(pairs, model, "id long, template_id long, label_id long, multi_class boolean, logit double")
    else:
        # the article's trigrams that any label has, and each label's, once; then one intersect per pair
        small_batches(articles.sparkSession)
        wanted = {t for r in side_rows(hyp.select(trigrams("label").alias("t"))) for t in r["t"] or ()}
        arts = arts.select("id", trigrams_among(wanted)(letters_of("title_eff")).alias("_tri"))
        hyp = hyp.withColumn("_ltri", F.array_distinct(F.coalesce(trigrams("label"), F.array())))
        pairs = explode_side(arts, hyp.select("template_id", "label_id", "multi_class", "_ltri"))
        scored = pairs.select("id", "template_id", "label_id", "multi_class",
                              F.size(F.array_intersect("_tri", "_ltri")).cast("double").alias("logit"))
    w = Window.partitionBy("id", "template_id")
    shifted = F.exp(F.col("logit") - F.max("logit").over(w))  # no overflow, whatever the hook's logits
    conf = F.when(F.col("multi_class"), 1.0 / (1.0 + F.exp(-F.col("logit")))) \
            .otherwise(shifted / F.sum(shifted).over(w))
    scored = scored.withColumn("confidence", conf.cast("float"))
    rank = Window.partitionBy("id", "template_id").orderBy(F.col("confidence").desc(), F.col("label_id"))
    return scored.select(
        F.col("id").alias("web_article_id"),
        F.col("label_id").alias("zero_shot_hypothesis_label_id"),
        F.col("template_id").alias("zero_shot_hypothesis_template_id"),
        (F.row_number().over(rank) == 1).alias("best"), "confidence")


def repeated_label(templates: DataFrame, labels: DataFrame) -> Column:
    """Whether any template in use repeats a label text (a scalar subquery, one value for the whole plan)."""
    return hypotheses(templates, labels).select(F.coalesce(F.bool_or("dup_label"), F.lit(False))).scalar()


def label_sets(templates: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each live enabled template that has labels: (template_id, template, multi_class, labels, repeated)."""
    h = hypotheses(templates, labels)
    sets = h.groupBy("template_id", "multi_class").agg(
        F.sort_array(F.collect_list(F.struct("label_id", "label"))).alias("labels"), F.bool_or("dup_label").alias("repeated"))
    return sets.join(templates.select(F.col("id").alias("template_id"), F.col("text").alias("template")), "template_id")


REPLY = "array<struct<class:string,confidence:float>>"


def zero_shot_replies(articles: DataFrame, templates: DataFrame, labels: DataFrame, model: PandasModel,
                      results: DataFrame | None = None) -> DataFrame:
    """(web_article_id, template_id, distribution): ``model`` asked once for each pending article and template.

    The model gets (id, title_eff, template_id, template, multi_class, labels: list of texts)
    and returns (id, template_id, distribution), most likely class first.
    """
    arts = with_title(pending_for(articles, results)).select("id", "title_eff")
    asked = explode_side(arts, label_sets(templates, labels).where("NOT repeated").drop("repeated"))
    asked = asked.withColumn("labels", F.col("labels.label"))
    return _run_model(asked, model, f"id long, template_id long, distribution {REPLY}") \
        .withColumnRenamed("id", "web_article_id")


def classes_from_replies(articles: DataFrame, templates: DataFrame, labels: DataFrame, replies: DataFrame,
                         results: DataFrame | None = None) -> DataFrame:
    """M-2 + J-13: replies of a classifier, checked -> one row for each article that the stage takes.

    ``replies(web_article_id, template_id, distribution)`` holds at most one reply for an
    article and template; class texts are matched with the template's labels.  Returns
    (id, outcome, error, error_template_id, classes).  An article is 'classified', 'none' (no
    template has labels) or 'error'; the error is that of its first template by id: 'duplicate
    label', 'no reply', 'empty distribution' or 'unknown class'.  An article with an error has
    no classes at all, so a later run takes it again.  ``classes`` has the columns of
    ``zero_shot_classes``; the first of a distribution is ``best``.
    """
    arts = with_title(pending_for(articles, results)).select("id")
    asked = explode_side(arts, label_sets(templates, labels).select("template_id", "labels", "repeated"))
    answered = asked.join(replies.select(F.col("web_article_id").alias("id"), "template_id", "distribution"),
                          ["id", "template_id"], "left")
    found = F.transform("distribution", lambda c, i: F.struct(
        F.get(F.filter("labels", lambda x: x["label"] == c["class"]), 0)["label_id"].alias("label_id"),
        (i == 0).alias("best"), c["confidence"].cast("float").alias("confidence")))
    error = (F.when(F.col("repeated"), "duplicate label").when(F.col("distribution").isNull(), "no reply")
             .when(F.size("distribution") == 0, "empty distribution")
             .when(F.exists("found", lambda c: c["label_id"].isNull()), "unknown class"))
    checked = answered.withColumn("found", found).select("id", "template_id", error.alias("error"), "found")
    # an article's templates are as many as the configuration has, whose size explode_side checks
    whole = checked.groupBy("id").agg(
        F.min(F.when(F.col("error").isNotNull(), F.struct("template_id", "error"))).alias("e"),
        F.sort_array(F.collect_list(F.struct("template_id", "found"))).alias("t"))
    rows = F.flatten(F.transform("t", lambda t: F.transform(t["found"], lambda c: F.struct(
        c["label_id"].alias("zero_shot_hypothesis_label_id"), t["template_id"].alias("zero_shot_hypothesis_template_id"),
        c["best"].alias("best"), c["confidence"].alias("confidence")))))
    empty = F.array().cast("array<struct<zero_shot_hypothesis_label_id:bigint,zero_shot_hypothesis_template_id:bigint,"
                           "best:boolean,confidence:float>>")
    out = arts.join(whole, "id", "left")
    return out.select("id", F.when(F.col("e").isNotNull(), "error").when(F.col("t").isNotNull(), "classified")
                      .otherwise("none").alias("outcome"), F.col("e.error").alias("error"),
                      F.col("e.template_id").alias("error_template_id"),
                      F.coalesce(F.when(F.col("e").isNull(), rows), empty).alias("classes"))


def class_rows(checked: DataFrame) -> DataFrame:
    """The rows of ``zero_shot_classes`` of ``classes_from_replies``."""
    return checked.select(F.col("id").alias("web_article_id"), F.explode("classes").alias("c")).select("web_article_id", "c.*")


# ----------------------------------------------------------------- M-3

def classify_text(articles: DataFrame, keywords: DataFrame | None = None,
                  results: DataFrame | None = None, model: PandasModel | None = None,
                  should_continue: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """M-3 + M-10: 0..n (type, label, confidence) rows per article, and the
    ids to forward.  Default model: ``keywords(type, label, keyword, weight)``
    joined on title tokens; confidence = label weight / type weight.
    ``should_continue`` maps ``array<struct<type,label,confidence>>`` to a
    boolean column (default: always continue)."""
    arts = with_title(pending_for(articles, results)).select("id", "title_eff")
    if model is not None:
        classes = _run_model(arts, model, "id long, type string, label string, confidence float")
    else:
        kw = bounded_broadcast(keywords.select("type", "label", "keyword", "weight"))
        toks = arts.select("id", F.explode(F.array_distinct(tokens("title_eff"))).alias("keyword"))
        hits = toks.join(kw, "keyword").groupBy("id", "type", "label").agg(F.sum("weight").alias("w"))
        tw = Window.partitionBy("id", "type")
        classes = hits.select("id", "type", "label",
                              (F.col("w") / F.sum("w").over(tw)).cast("float").alias("confidence"))
    classes = classes.select(F.col("id").alias("web_article_id"), "type", "label", "confidence")
    per_article = classes.groupBy("web_article_id").agg(
        F.collect_list(F.struct("type", "label", "confidence")).alias("classes"))
    forward = arts.select(F.col("id").alias("web_article_id")).join(per_article, "web_article_id", "left")
    cond = should_continue(F.col("classes")) if should_continue else F.lit(True)
    forward = forward.where(cond).select("web_article_id")
    return classes, forward


# ----------------------------------------------------------------- M-6

def token_words(col) -> Column:
    """The ``tokens`` of a text, joined by single spaces."""
    col = F.col(col) if isinstance(col, str) else col
    return F.trim(F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", " "))


KNOWN_TOKENS = 1_000_000  # buckets of tokens that a Python worker keeps


def hashed_token_counts(dim: int):
    """A column function: how many tokens of ``token_words`` fall into each of ``dim`` buckets.

    A token's bucket is the first 28 bits of its MD5, modulo ``dim``; a worker hashes a token once.
    """
    class Buckets(dict):
        def __missing__(self, token):
            if len(self) >= KNOWN_TOKENS:
                self.clear()
            found = self[token] = int(hashlib.md5(token.encode()).hexdigest()[:7], 16) % dim
            return found
    known: dict[str, int] = {}

    @F.arrow_udf("array<double>")
    def counts(words: pa.Array) -> pa.Array:
        nonlocal known
        if not known:
            known = Buckets()
        rows = [np.bincount([known[t] for t in x.split(" ")] if x else [], minlength=dim) for x in words.to_pylist()]
        flat = np.concatenate(rows).astype(np.float64) if rows else np.empty(0)
        return pa.ListArray.from_arrays(np.arange(0, dim * len(rows) + 1, dim, dtype=np.int32), pa.array(flat))
    return counts.asNondeterministic()  # so that the optimizer does not run it for each mention of its result


def vectorize(articles: DataFrame, dim: int = 64, results: DataFrame | None = None,
              model: PandasModel | None = None) -> DataFrame:
    """M-6: (web_article_id, data array<float>, publish_day) L2-normalised vectors.

    Default model: hashed token counts, counted row by row in Arrow batches,
    no explode or shuffle.
    """
    from newsflow.operators.knn import l2_normalize
    arts = with_title(pending_for(articles, results))
    if model is not None:
        vec = _run_model(arts.select("id", "title_eff", "publish_date"), model,
                         "id long, data array<float>, publish_date timestamp")
    else:
        small_batches(articles.sparkSession)
        vec = arts.select("id", hashed_token_counts(dim)(token_words("title_eff")).alias("data"), "publish_date")
    return vec.select(F.col("id").alias("web_article_id"),
                      l2_normalize("data").alias("data"),
                      F.to_date("publish_date").alias("publish_day"))


# ----------------------------------------------------------------- M-8

def sentences(col) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.filter(F.transform(F.split(col, r"[.!?;\n]+"), lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def default_answers(passage="passage", question="question") -> Column:
    """Default Q/A model: the sentence sharing most tokens with the question.

    Returns ``array<struct<text,confidence>>`` best first (empty when nothing
    overlaps); confidence = shared distinct tokens / distinct question tokens.
    """
    q = F.array_distinct(tokens(question))
    scored = F.transform(sentences(passage), lambda s, i: F.struct(
        (F.size(F.array_intersect(F.array_distinct(tokens(s)), q)) / F.greatest(F.size(q), F.lit(1)))
        .cast("float").alias("confidence"), (-i).alias("neg_pos"), s.alias("text")))
    ranked = F.reverse(F.array_sort(F.filter(scored, lambda a: a["confidence"] > 0)))
    return F.transform(ranked, lambda a: F.struct(a["text"].alias("text"), a["confidence"].alias("confidence")))


def _best_answers(sent: Column, q: Column) -> Column:
    """``default_answers`` over precomputed (text, token set) sentences and question tokens."""
    scored = F.transform(sent, lambda s, i: F.struct(
        (F.size(F.array_intersect(s["toks"], q)) / F.greatest(F.size(q), F.lit(1))).cast("float").alias("confidence"),
        (-i).alias("neg_pos"), s["text"].alias("text")))
    ranked = F.reverse(F.array_sort(F.filter(scored, lambda a: a["confidence"] > 0)))
    return F.transform(ranked, lambda a: F.struct(a["text"].alias("text"), a["confidence"].alias("confidence")))


def _matches(text: Column, pattern: Column, rules: DataFrame, literal: int = 256) -> Column:
    """Whether ``text`` matches its rule's ``pattern`` (F-15).

    The patterns are written into the plan, so each is compiled once for a task and not with
    every row.  Beyond ``literal`` different patterns the plan keeps the column, with the same rows.
    """
    known = [p for (p,) in rules.where("pattern IS NOT NULL").select("pattern").distinct().limit(literal + 1).collect()]
    if len(known) > literal:
        return F.rlike(text, pattern)
    out = F.lit(False)
    for p in sorted(known):
        out = F.when(pattern == p, F.lit(True) if p == "" else text.rlike(p)).otherwise(out)
    return out


def extract_info(articles: DataFrame, rules: DataFrame, results: DataFrame | None = None,
                 model: PandasModel | None = None) -> DataFrame:
    """M-8: (web_article_id, info_extraction_rule_id, text, confidence).

    Per enabled rule: best (first) answer on the lower-cased title and
    question, dropped if its confidence is below the rule threshold (F-13,
    equality passes) or the answer does not match the rule's regexp (F-15,
    unanchored, empty pattern matches all).  Rules must have passed
    ``validate_rules`` (patterns are in Java syntax then).
    """
    arts = with_title(pending_for(articles, results)).select("id", F.lower("title_eff").alias("passage"))
    live = rules.where("enabled AND deleted_at IS NULL").select(
        F.col("id").alias("rule_id"), F.lower("question").alias("question"),
        F.col("answer_regexp").alias("pattern"), F.col("threshold").cast("float").alias("threshold"))
    if model is not None:
        pairs = explode_side(arts, live)
        answered = _run_model(pairs, model, "id long, rule_id long, pattern string, threshold float, "
                                            "answers array<struct<text:string,confidence:float>>")
    else:
        # sentences and their token sets once per article, question tokens once per rule
        arts = arts.select("id", F.transform(sentences("passage"), lambda s: F.struct(
            s.alias("text"), F.array_distinct(tokens(s)).alias("toks"))).alias("_sent"))
        live = live.withColumn("_q", F.array_distinct(tokens("question"))).drop("question")
        pairs = explode_side(arts, live)
        answered = pairs.select("id", "rule_id", "pattern", "threshold",
                                _best_answers(F.col("_sent"), F.col("_q")).alias("answers"))
    best = answered.select("id", "rule_id", "pattern", "threshold", F.get(F.col("answers"), 0).alias("a"))
    kept = best.where(F.col("a").isNotNull() & (F.col("a.confidence") >= F.col("threshold"))
                      & _matches(F.col("a.text"), F.col("pattern"), live))
    return kept.select(F.col("id").alias("web_article_id"), F.col("rule_id").alias("info_extraction_rule_id"),
                       F.col("a.text").alias("text"), F.col("a.confidence").alias("confidence"))
