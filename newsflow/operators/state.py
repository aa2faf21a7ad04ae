"""Source health, work order and pending-work recovery (A-3, A-4, O-1, O-2, O-5, F-17, ST-4, ST-5).

Source health over a per-source attempt log is a distributed scan: the
log is cut into (source, seq block) pieces, each piece is numbered
locally, and what carries across pieces comes from a table with one row
per piece.  A source holding a third of all attempts is thus spread
over many tasks instead of one window partition.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsflow.functions.text import utc_literal
from newsflow.operators.sinks import assign_ids

BLOCK_WIDTH = 1 << 20


def source_health(attempts: DataFrame, max_failures: int | None = None,
                  block_width: int = BLOCK_WIDTH, initial: DataFrame | None = None) -> DataFrame:
    """A-3 / A-4: final (source_id, failures_count, last_error, last_retrieved_at, enabled)
    after replaying an attempt log (source_id, seq, attempted_at, failed, error).

    Failure: count + 1, last_error = message, enabled = count <= max.
    Success: count 0, last_error NULL, last_retrieved_at = attempted_at (a failure
    leaves it unchanged).  The first attempt that pushes the count past
    ``max_failures`` disables the source; later attempts are ignored (a
    disabled source is not fetched).  ``max_failures=None`` never disables.

    ``initial`` (source_id, failures_count, last_error, last_retrieved_at,
    enabled) is the state before this log (a streaming fold): its failure
    count carries into the leading failures, disabled sources ignore their
    attempts, and sources without attempts keep their state.

    Plan: one windowed pass over (source, seq block) pieces numbers each
    attempt in its block and counts the failures since the last success in
    the block.  A table with one row per piece carries "failures since the
    last success" across blocks (a scan over the block table of each source)
    and marks the block and position of the first disabling attempt; joined
    back, it completes every row.  The log is read twice (the pass and its
    block summary) and a source holding a third of all attempts still spreads
    over many blocks; no join of the log with an aggregate of itself.
    """
    key, seq = "source_id", "seq"
    init = None
    if initial is not None:
        init = initial.select(key, F.col("failures_count").alias("_f0"),
                              F.col("last_retrieved_at").alias("_lr0"), F.col("enabled").alias("_en0"))
        attempts = attempts.join(init.where(~F.col("_en0")).select(key), key, "left_anti")
    b = (attempts.withColumn("_blk", F.floor(F.col(seq) / block_width))
         .withColumn("_ok", (~F.col("failed")).cast("int")))
    w = Window.partitionBy(key, "_blk").orderBy(seq)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    loc = b.withColumn("_lr", F.row_number().over(w)).withColumn("_lg", F.sum("_ok").over(run))
    # failures since the last success of the block (since the block start when none yet)
    loc = loc.withColumn("_tail", F.col("_lr") - F.coalesce(
        F.max(F.when(F.col("_ok") == 1, F.col("_lr"))).over(run), F.lit(0)))
    m = max_failures
    inner = (F.col("_lg") >= 1) & (F.col("_tail") > F.lit(m)) if m is not None else F.lit(False)
    blocks = loc.groupBy(key, "_blk").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.when(F.col("_ok") == 1, F.col("_lr"))).alias("_first_ok"),
        F.max(F.when(F.col("_ok") == 1, F.col("_lr"))).alias("_last_ok"),
        F.min(F.when(inner, F.col("_lr"))).alias("_inner_stop"))
    before = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_C", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # global position of the last success before the block (positions only grow)
    blocks = blocks.withColumn("_P", F.max(F.col("_C") + F.col("_last_ok")).over(before))
    if init is not None:
        blocks = blocks.join(init.select(key, "_f0"), key, "left")
    else:
        blocks = blocks.withColumn("_f0", F.lit(0))
    blocks = blocks.withColumn("_carry", F.when(F.col("_P").isNull(), F.col("_C") + F.coalesce("_f0", F.lit(0)))
                               .otherwise(F.col("_C") - F.col("_P")))
    if m is not None:
        # leading failures of the block count on from the carry: the first with lr + carry > m
        lead = F.coalesce(F.col("_first_ok") - 1, F.col("_n"))
        cand = F.greatest(F.lit(1).cast("long"), F.lit(m + 1) - F.col("_carry"))
        blocks = blocks.withColumn("_bstop", F.coalesce(F.when(cand <= lead, cand), F.col("_inner_stop")))
        blocks = blocks.withColumn("_stopped_before", F.coalesce(
            F.max(F.col("_bstop").isNotNull().cast("int")).over(before), F.lit(0)) > 0)
    else:
        blocks = (blocks.withColumn("_bstop", F.lit(None).cast("long"))
                  .withColumn("_stopped_before", F.lit(False)))
    r = loc.join(blocks.select(key, "_blk", "_C", "_carry", "_bstop", "_stopped_before"), [key, "_blk"])
    r = r.where(~F.col("_stopped_before") & (F.col("_bstop").isNull() | (F.col("_lr") <= F.col("_bstop"))))
    r = r.select(key, "failed", "error", "attempted_at",
                 (F.col("_C") + F.col("_lr")).alias("_r"),
                 (F.col("_tail") + F.when(F.col("_lg") == 0, F.col("_carry")).otherwise(F.lit(0))).alias("_fails"),
                 F.coalesce(F.col("_lr") == F.col("_bstop"), F.lit(False)).alias("_is_stop"))
    last = r.groupBy(key).agg(
        F.max_by(F.struct("_fails", "failed", "error"), "_r").alias("s"),
        F.max(F.when(~F.col("failed"), F.col("attempted_at"))).alias("last_retrieved_at"),
        F.max("_is_stop").alias("_stopped"),
        F.count(F.lit(1)).alias("attempts"))
    out = last.select(
        key, F.col("s._fails").cast("int").alias("failures_count"),
        F.when(F.col("s.failed"), F.col("s.error")).alias("last_error"),
        "last_retrieved_at", (~F.col("_stopped")).alias("enabled"), "attempts")
    if init is not None:
        prev = initial.select(key, "failures_count", "last_error", "last_retrieved_at", "enabled",
                              F.lit(0).cast("long").alias("attempts"))
        out = (out.join(init.select(key, "_lr0"), key, "left")
               .withColumn("last_retrieved_at", F.coalesce("last_retrieved_at", "_lr0")).drop("_lr0"))
        out = out.unionByName(prev.join(out.select(key), key, "left_anti"))
    return out


def apply_health(sources: DataFrame, health: DataFrame) -> DataFrame:
    """Fold a health result into the source table (sources without attempts unchanged)."""
    h = health.select(F.col("source_id").alias("id"), F.col("failures_count").alias("_fc"),
                      F.col("last_error").alias("_le"), F.col("last_retrieved_at").alias("_lr"),
                      F.col("enabled").alias("_en"))
    j = sources.join(h, "id", "left")
    has = F.col("_fc").isNotNull()
    return j.select(*[
        F.when(has, F.col("_fc")).otherwise(F.col(c)).alias(c) if c == "failures_count" else
        F.when(has, F.col("_le")).otherwise(F.col(c)).alias(c) if c == "last_error" else
        F.when(has, F.coalesce(F.col("_lr"), F.col(c))).otherwise(F.col(c)).alias(c) if c == "last_retrieved_at" else
        F.when(has, F.col(c) & F.col("_en")).otherwise(F.col(c)).alias(c) if c == "enabled" else
        F.col(c) for c in sources.columns])


def work_order(sources: DataFrame, batch: int = 100) -> DataFrame:
    """O-1 + O-2 + F-1: enabled live sources, never-retrieved first, then by
    last retrieval and id; ``position`` (1-based) and ``batch_no`` of ``batch`` rows."""
    live = sources.where("enabled AND deleted_at IS NULL")
    order = [F.col("last_retrieved_at").asc_nulls_first(), F.col("id")]
    ranked = assign_ids(live, 0, order, id_col="position")
    return ranked.withColumn("batch_no", F.floor((F.col("position") - 1) / batch).cast("long"))


def pending_work(inputs: DataFrame, outcomes: DataFrame, key: str = "id",
                 stage: str | None = None) -> DataFrame:
    """ST-4: records handed to a stage whose outcome is not recorded."""
    done = outcomes
    if stage is not None and "stage" in outcomes.columns:
        done = outcomes.where(F.col("stage") == stage)
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def stale_pending(pending: DataFrame, now: _dt.datetime, leeway: _dt.timedelta) -> DataFrame:
    """ST-5 + F-17 + O-5: pending records created strictly before ``now - leeway``,
    numbered oldest first (id breaks ties)."""
    cut = utc_literal(now - leeway)
    old = pending.where(F.col("created_at") < cut)
    return assign_ids(old, 0, [F.col("created_at"), F.col("id")], id_col="position")
