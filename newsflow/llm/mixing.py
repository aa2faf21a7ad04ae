"""Mixing of sources to target weights along a time-varying curriculum (DataFrame functions only).

Targets: the words of all documents are shared among the sources by weight; no
source is given more than ``cap`` times its words, and what is cut off is shared
again by weight among the others until none is above.  That is the level
``lam`` at which ``sum(min(cap * size, lam * weight))`` equals all words, found by
running sums over the sources in order of ``cap * size / weight``.

Curriculum: over the training time 0..1 a source of target T is drawn at the rate
``T * (1 - bend + 2 * bend * t)``, whose integral ``T * ((1 - bend) * t + bend * t**2)``
is its demand up to t.  A source's documents stand in a fixed pseudo-random
order; the running sum of their words, put through the inverse of the demand,
is the training position of each, and the mix is range-sorted by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
BENDS = (0.5, 0.0, -0.5)
PARTS = 4096  # running sums are taken in so many parts of a source, so a hot source is never one task


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, bends: Sequence[float] = BENDS,
                   cap: int = 3) -> DataFrame:
    """(skey, source_size, target, bend) from one row (skey, source, source_size) per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]),
                                       (F.col("place") % len(values) + 1).cast("int"))
    s = sizes.withColumn("place", place).withColumn("weight", pick(weights)).withColumn("bend", pick(bends))
    s = s.withColumn("top", F.lit(cap) * F.col("source_size").cast("double"))
    by_level = Window.orderBy(F.col("top") / F.col("weight"), "place")
    before = F.sum("top").over(by_level.rowsBetween(Window.unboundedPreceding, 0)) - F.col("top")
    rest = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy(F.lit(1))
    s = s.withColumn("lam", (F.sum("source_size").over(everything) - before) / rest)
    fits = F.when(F.col("lam") * F.col("weight") <= F.col("top"), F.struct(F.col("top") / F.col("weight"), "place", "lam"))
    s = s.withColumn("level", F.min(fits).over(everything)["lam"])
    target = F.least("top", F.coalesce(F.col("level") * F.col("weight"), F.col("top")))
    return s.select("skey", "source_size", target.alias("target"), "bend")


def training_position(share: Column, bend: Column) -> Column:
    """Inverse of the demand ``(1 - bend) * t + bend * t**2`` at ``share``."""
    root = F.sqrt((1 - bend) * (1 - bend) + 4 * bend * share)
    return F.when(bend == 0, share).otherwise((root - (1 - bend)) / (2 * bend))


def placed(docs: DataFrame, columns: Sequence[str], cap: int = 3, weights: Sequence[float] = WEIGHTS,
           bends: Sequence[float] = BENDS) -> DataFrame:
    """Every row with its words, its source's words and target, and the words of the source before it.

    Columns: row (struct of ``columns``), doc_id, size, source_size, target, bend, start.
    """
    known = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"),
                        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
                        word_count(docs["text"]).alias("size"), F.xxhash64(docs["doc_id"], docs["text"]).alias("h"))
    known = known.withColumn("skey", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    known = written(known.withColumn("part", F.pmod("h", F.lit(PARTS))), "mix")
    parts = known.groupBy("skey", "source", "part").agg(F.sum("size").alias("part_size"))
    parts = written(parts, "mix-parts")  # at most PARTS rows a source
    targets = source_targets(parts.groupBy("skey", "source").agg(F.sum("part_size").alias("source_size")),
                             weights, bends, cap)
    ahead = F.sum("part_size").over(Window.partitionBy("skey").orderBy("part")) - F.col("part_size")
    parts = parts.select("skey", "part", ahead.alias("ahead")).join(targets, "skey")
    inside = F.sum("size").over(Window.partitionBy("skey", "part").orderBy("h", "doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    out = known.join(parts, ["skey", "part"]).withColumn("start", F.col("ahead") + inside)
    return out.select("row", "doc_id", "size", "source_size", "target", "bend", "start")


def mix_sources(docs: DataFrame, cap: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken, position) of every document, in training order.

    ``taken`` counts the words the mix takes of a document over at most ``cap``
    passes of its source; the last document of the last pass is taken in part,
    so a source's taken words are its target to a word.  A null or wordless text
    has size 0 and takes nothing; documents not taken have a null position and
    come last; repeated rows each count; null sources form one source, the last;
    an empty table gives no rows.  Other columns are not read.
    """
    p = placed(docs, ["doc_id"], cap)
    goal = F.round("target").cast("long")
    zero = F.lit(0).cast("long")
    takes = [F.least("size", F.greatest(zero, goal - F.col("start") - F.lit(i) * F.col("source_size")))
             for i in range(cap)]
    taken = sum(takes[1:], takes[0])
    share = (F.col("start") + F.least("size", F.greatest(zero, goal - F.col("start"))) / 2) / F.col("target")
    out = p.withColumn("taken", taken).withColumn(
        "position", F.when(F.col("taken") > 0, training_position(F.least(share, F.lit(1.0)), F.col("bend"))))
    return out.select("doc_id", "size", "source_size", "target", "taken", "position").orderBy(
        F.col("position").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame, cap: int = 3) -> DataFrame:
    """The documents of the mix with the columns of ``docs``, whole, in training order.

    A document's pass is in the mix when its middle word comes before its
    source's target, so a source's words are its target to half a document; a
    document is repeated once for every pass, at most ``cap`` times.
    """
    p = placed(docs, docs.columns, cap)
    every = p.withColumn("turn", F.explode(F.array(*[F.lit(i) for i in range(cap)])))
    middle = F.col("start") + F.col("turn") * F.col("source_size") + F.col("size") / 2
    share = middle / F.col("target")
    taken = every.where((F.col("size") > 0) & (middle <= F.col("target")))
    return taken.withColumn("position", training_position(share, F.col("bend"))).orderBy(
        "position", "doc_id", "turn").select("row.*")
