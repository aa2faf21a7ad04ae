"""Quality rules and robust multivariate outliers (DataFrame functions only).

Base rules count words, symbols, repeated lines and repeated 8-word windows of
each text.  The counts, transformed, form a vector; per language and source the
minimum-covariance-determinant estimate of its mean and covariance is found by
C-steps: keep the ``HELD`` share of rows nearest by Mahalanobis distance, take
their mean and covariance, and again, until no group's determinant falls.  A
document is rejected when the base rules fail or its squared distance is above
``CUTOFF``, the chi-square quantile of ``INSIDE``.

Statistics of a short text scatter more and its vocabulary is richer, which is no
fault of it.  Means are therefore linear in the log of the length, and a row
weighs ``n / (n + NOISE_WORDS)``: the variance of a text of n words is that of a
long one times ``1 + NOISE_WORDS / n``.

Every group has an estimate of its own.  Its sums are blended with ``PRIOR`` rows
of its language's, and those with ``PRIOR`` rows of the whole table's, so an
estimate of few rows leans on the wider one without a switch at some size.  Two
starts (the group's and its language's quartiles) are followed; the smaller
determinant wins.

Distances are ranked in ``FINE`` steps per e-fold, so a C-step is one sum per
group and step with map-side combining.  Estimates reach the rows by broadcast up
to ``BROADCAST_GROUPS`` groups, beyond that by a join on the group and a salt;
no group is ever in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import SPACES, written

SYMBOLS = "#*$%&|<>"
FEATURES = ("x0", "x1", "x2", "x3")
#: Added scale of each feature, against zero variance.  Most documents have no symbols (x1) and no repeats (x2), so the
#: nearest ``HELD`` share has no spread there and the scale is this one; word length and vocabulary have their own.
FLOORS = (0.005, 0.05, 0.1, 0.005)
HELD, FINE = 0.75, 16
#: Length in words at which sampling noise of a text's statistics is as large as the spread between long texts.
NOISE_WORDS = 200
#: Rows of the wider estimate that each estimate is blended with.
PRIOR = 50
#: A C-step counts for a group where it lowers the log determinant by more than ``STILL``; steps end when it does for none.
STILL = 0.01
#: Groups whose estimates (two starts, under 300 bytes each) are broadcast; beyond, the join is salted.
BROADCAST_GROUPS, SALTS = 10_000, 64
#: Share of a normal group that lies within the cutoff.
INSIDE = 0.999
WINDOW = 8


def text_counts(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """row (struct of ``columns``), lang, source and the base counts of each text."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    d = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
                    docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source"),
                    text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    d = d.withColumns({
        "words": F.array_remove(F.split(F.translate("text", "\t\n\x0b\x0c\r", "     "), " "), ""),
        "lines": lines,
        "word_chars": F.length(F.translate("text", SPACES, "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
        "n_chars_all": F.length("text")}).drop("text")
    n = F.size("words")
    d = d.withColumns({
        "n_words": n.cast("long"), "n_lines": F.size("lines"), "n_distinct": F.size(F.array_distinct("words")),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "seen": F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                              lambda i: F.xxhash64(F.slice("words", i, WINDOW))))}).drop("words", "lines")
    # the windows of a text by hash, only where one comes twice
    d = d.withColumn("again", F.when(F.size(F.array_distinct("seen")) < F.size("seen"), F.sort_array(
        F.transform("seen", lambda x, i: F.struct(x.alias("h"), i.alias("p")))))).drop("seen")
    last = F.size("again") - 1
    same = lambda i, j: F.get("again", i)["h"] == F.get("again", j)["h"]
    twice = F.filter(F.sequence(F.lit(0), last), lambda i: ((i > 0) & same(i, i - 1)) | ((i < last) & same(i, i + 1)))
    d = d.withColumn("starts", F.when(F.col("again").isNotNull(), F.sort_array(
        F.transform(twice, lambda i: F.get("again", i)["p"])))).drop("again")
    covered = F.aggregate("starts", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                          lambda a, p: F.struct((p + WINDOW).alias("end"),
                                                (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")),
                          lambda a: a["n"])
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("starts")


def features(d: DataFrame) -> DataFrame:
    """Transformed statistic vector: word length, symbol share, repeated share, vocabulary curve."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return d.withColumns({
        "x0": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x1": F.asinh(20 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "x2": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)) + F.col("n_repeat_words") / n,
        "x3": F.log(F.greatest(F.col("n_distinct"), F.lit(1)) + 1) / F.log(n + 1),
        "u": F.log(n + 1), "weight": n / (n + NOISE_WORDS), "base_failed": failed})


PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]
SUMS = ["n", "w", "wu", "wuu", *[f"w{i}" for i in range(len(FEATURES))], *[f"wu{i}" for i in range(len(FEATURES))],
        *[f"w{i}_{j}" for i, j in PAIRS]]
FIT = ["mu", *[f"{c}{i}" for c in "mb" for i in range(len(FEATURES))], *[f"l{i}{j}" for i, j in PAIRS], "log_det"]


def sums_of_rows() -> list[Column]:
    """Aggregates of rows: count, weight, and weighted first and second moments of u and the features."""
    w, u, x = F.col("weight"), F.col("u"), [F.col(f) for f in FEATURES]
    terms = [F.lit(1.0), w, w * u, w * u * u, *[w * y for y in x], *[w * u * y for y in x],
             *[w * x[i] * x[j] for i, j in PAIRS]]
    return [F.sum(t).alias(name) for t, name in zip(terms, SUMS)]


def estimate(sums: DataFrame, scale: float) -> DataFrame:
    """Per row of ``sums``: mean u, means m0.., slopes b0.. on u, the Cholesky factor l00, l10, .. of the floored
    residual covariance and its log determinant."""
    p = range(len(FEATURES))
    cols = ["try_divide(wu, w) AS mu", *[f"try_divide(w{i}, w) AS m{i}" for i in p], "greatest((wuu - w * mu * mu) / n, 1e-6D) AS vu",
            *[f"(wu{i} - w * mu * m{i}) / n AS v{i}" for i in p], *[f"v{i} / vu AS b{i}" for i in p]]
    for i, j in PAIRS:
        floor = FLOORS[i] ** 2
        rest = f"{scale}D * ((w{i}_{j} - w * m{i} * m{j}) / n - b{i} * v{j})" + (f" + {floor}D" if i == j else "")
        rest += "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        cols.append(f"sqrt(greatest({rest}, {floor * 1e-3}D)) AS l{i}{i}" if i == j else f"({rest}) / l{j}{j} AS l{i}{j}")
    cols.append(" + ".join(f"ln(l{i}{i})" for i in p) + " AS log_det")
    keys = [c for c in sums.columns if c not in SUMS]
    return sums.selectExpr(*keys, *cols).select(*keys, *FIT)


def squared_distance() -> Column:
    """Weighted Mahalanobis distance by forward substitution, from the columns of ``estimate``."""
    solved: list[Column] = []
    for i, x in enumerate(FEATURES):
        y = F.col(x) - F.col(f"m{i}") - F.col(f"b{i}") * (F.col("u") - F.col("mu"))
        for k, before in enumerate(solved):
            y = y - F.col(f"l{i}{k}") * before
        solved.append(y / F.col(f"l{i}{i}"))
    return F.col("weight") * sum((y * y for y in solved[1:]), solved[0] * solved[0])


def chi_square_quantile(share: float) -> float:
    """Squared distance below which ``share`` of a 4-variate normal lies."""
    tail = lambda q: math.exp(-q / 2) * (1 + q / 2)
    low, high = 0.0, 100.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - tail(mid) < share else (low, mid)
    return low


CUTOFF = chi_square_quantile(INSIDE)


def consistency(held: float) -> float:
    """Factor that makes the covariance of the nearest ``held`` share of a 4-variate normal the whole one."""
    q = chi_square_quantile(held)
    return held / (1 - math.exp(-q / 2) * (1 + q / 2 + q * q / 8))


def with_estimate(d: DataFrame, fit: DataFrame, few: bool) -> DataFrame:
    """Rows with the estimates of their ``pair``: a broadcast for few groups, else a join on group and salt."""
    if few:
        return d.join(F.broadcast(fit), "pair")
    salted = fit.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("pair", "weight", *FEATURES), F.lit(SALTS)).cast("int")
    return d.withColumn("salt", salt).join(salted, ["pair", "salt"]).drop("salt")


def nearest_sums(d: DataFrame, fit: DataFrame, few: bool) -> DataFrame:
    """Sums over the nearest ``HELD`` share of each group and start, whole distance steps at a time."""
    step = F.floor(F.lit(FINE) * F.log(squared_distance() + 1e-9))
    steps = with_estimate(d, fit, few).groupBy("pair", "tongue", "start", step.alias("step")).agg(*sums_of_rows())
    group = Window.partitionBy("pair", "start")  # a group has some hundred steps, however many rows
    before = F.sum("n").over(group.orderBy("step")) - F.col("n")
    held = steps.withColumns({"before": before, "whole": F.sum("n").over(group)}).where(
        F.col("before") < HELD * F.col("whole"))
    return held.groupBy("pair", "tongue", "start").agg(*[F.sum(c).alias(c) for c in SUMS])


def blended(sums: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of every group and start, with ``PRIOR`` rows of its language's, which have ``PRIOR`` rows of all."""
    wide = lambda keys: sums.groupBy(*keys).agg(*[F.sum(c).alias(f"_{c}") for c in SUMS])
    share = lambda c: F.lit(PRIOR) * F.col(f"_{c}") / F.nullif("_n", F.lit(0.0))

    def join(narrow: DataFrame, wider: DataFrame, keys: list[str]) -> DataFrame:
        j = narrow.join(wider, keys, "left")
        rest = [c for c in narrow.columns if c not in SUMS]
        return j.select(*rest, *[(F.coalesce(c, F.lit(0.0)) + F.coalesce(share(c), F.lit(0.0))).alias(c) for c in SUMS])
    tongues = groups.select("tongue", "start").distinct().join(
        sums.groupBy("tongue", "start").agg(*[F.sum(c).alias(c) for c in SUMS]), ["tongue", "start"], "left")
    tongues = join(tongues, wide(["start"]), ["start"])
    tongues = tongues.select("tongue", "start", *[F.col(c).alias(f"_{c}") for c in SUMS])
    own = groups.join(sums.drop("tongue"), ["pair", "start"], "left")
    return join(own, tongues, ["tongue", "start"]).where("n > 0").drop("tongue")


def quartile_start(d: DataFrame, key: str) -> DataFrame:
    """Per ``key``: medians, no slopes, and quartile distances as an uncorrelated scatter."""
    p = range(len(FEATURES))
    q = d.groupBy(key).agg(*[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q{i}")
                             for i, x in enumerate(FEATURES)])
    wide = {i: F.sqrt(((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) ** 2 + FLOORS[i] ** 2) for i in p}
    return q.select(key, F.lit(0.0).alias("mu"), *[F.col(f"q{i}")[1].alias(f"m{i}") for i in p],
                    *[F.lit(0.0).alias(f"b{i}") for i in p],
                    *[(wide[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in PAIRS],
                    F.lit(float("inf")).alias("log_det"))


def fitted(d: DataFrame, all_groups: DataFrame, few: bool) -> DataFrame:
    """One estimate for each ``pair`` of ``all_groups`` from the rows ``d``; none where ``d`` is empty."""
    d = d.select("pair", "tongue", "u", "weight", *FEATURES)
    own = quartile_start(d, "pair").withColumn("start", F.lit(0))
    wide = all_groups.join(quartile_start(d, "tongue"), "tongue").drop("tongue").withColumn("start", F.lit(1))
    fit = written(own.unionByName(wide), "quality-fit")
    groups = all_groups.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    falls = True
    while falls:
        sums = written(nearest_sums(d, fit, few), "quality-sums")
        new = estimate(blended(sums, groups), consistency(HELD)).select("pair", "start", F.struct(*FIT).alias("new"))
        old = fit.select("pair", "start", F.struct(*FIT).alias("old"))
        lower = ~(F.col("new.log_det") >= F.coalesce("old.log_det", F.lit(float("inf"))) - STILL)
        both = new.join(old, ["pair", "start"], "left").withColumn("lower", lower)
        fit = written(both.select("pair", "start", "lower", F.when(F.col("lower"), F.col("new")).otherwise(F.col("old"))
                                  .alias("fit")).select("pair", "start", "lower", "fit.*"), "quality-fit")
        falls = not fit.where("lower").isEmpty()
        fit = fit.drop("lower")
    best = fit.groupBy("pair").agg(F.min(F.struct("log_det", "start")).alias("best"))
    return fit.join(best, "pair").where("start = best.start").drop("start", "best")


def judged(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row (struct of ``columns``) with its counts, base_failed, distance and kept."""
    tongue = F.coalesce("lang", F.lit("\x02"))
    d = features(text_counts(docs, columns)).withColumns({
        "tongue": tongue, "pair": F.concat_ws("\x01", tongue, F.coalesce("source", F.lit("\x02")))})
    d = written(d, "quality")
    groups = written(d.groupBy("pair", "tongue").count().drop("count"), "quality-groups")
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    # a row for every group, so the join below keeps all rows; where no row passes the base rules there are none
    fit = groups.join(fitted(d.where(~F.col("base_failed")), groups, few), "pair", "left").drop("tongue")
    out = with_estimate(d, written(fit, "quality-fit"), few)
    kept = ~F.col("base_failed") & (F.coalesce(squared_distance(), F.lit(0.0)) <= CUTOFF)
    return out.withColumn("distance", F.sqrt(squared_distance())).withColumn("kept", kept)


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, kept, distance) per document.

    A null, empty or wordless text has no words and fails the base rules; null
    languages and sources form groups of their own; a group of equal rows has the
    floors as its spread; where no row passes the base rules distances are null; repeated rows get equal verdicts; an empty table gives
    no rows.  Other columns are not read.
    """
    return judged(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    return judged(docs, docs.columns).where("kept").select("row.*")
