"""Source and rule management as change-set operators on tables (C-1..C-5, O-3, O-6, J-5, J-14, A-1, A-2, F-18, SC-5).

The reference serves these through RPCs; here each operation takes the
current table snapshot and a change-set DataFrame and returns the new
snapshot (plus the rows the caller reports back).
"""

from __future__ import annotations

import datetime as _dt
import re
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.text import utc_literal
from newsflow.operators.sinks import assign_ids, insert_if_absent


def keyset_page(df: DataFrame, after: int | None = None, first: int | None = None,
                key: str = "id") -> DataFrame:
    """O-3: rows with ``key > after`` in key order, at most ``first`` (absent or 0 = all)."""
    out = df
    if after:
        out = out.where(F.col(key) > after)
    out = out.orderBy(key)
    if first:
        out = out.limit(first)
    return out


def nest_children(parent: DataFrame, child: DataFrame, fk: str, fields: list[str],
                  order: str = "id", name: str = "children") -> DataFrame:
    """J-5 / C-1: parent rows with ``name`` = their children as an array of
    structs ordered by ``order``.  For bounded children (labels of a
    template); big child tables should be joined, not nested."""
    agg = child.groupBy(F.col(fk).alias("_pk")).agg(
        F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias(name))
    return parent.join(agg, parent["id"] == agg["_pk"], "left").drop("_pk") \
                 .withColumn(name, F.coalesce(F.col(name), F.array()))


def apply_creates(target: DataFrame, creates: DataFrame, keys: list[list[str]], now: _dt.datetime,
                  defaults: dict | None = None, order: list[str] | None = None,
                  parent: tuple[DataFrame, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """C-2: insert new rows (K-1 on the unique keys, K-5 ids after the table's max id).

    ``defaults`` fixes columns regardless of the input (feeds and Twitter
    sources start disabled).  ``parent=(table, fk)`` requires the parent row
    to exist and not to be soft-deleted (labels need their template); requests
    without one are those of ``missing_parents``.  Returns (snapshot, created).
    """
    c = creates
    if parent is not None:
        c = c.join(_live_parents(parent), parent[1], "left_semi")
    for col, value in (defaults or {}).items():
        c = c.withColumn(col, F.lit(value))
    c = insert_if_absent(c, target, keys, order or [k for key in keys for k in key])
    c = assign_ids(c, target, order or [k for key in keys for k in key])
    ts = utc_literal(now)
    c = c.withColumn("created_at", ts).withColumn("updated_at", ts).withColumn("version", F.lit(0).cast("long"))
    cols = []
    for f in target.schema.fields:
        cols.append((F.col(f.name) if f.name in c.columns else F.lit(None)).cast(f.dataType).alias(f.name))
    created = c.select(*cols)
    return target.unionByName(created), created


def missing_parents(creates: DataFrame, parent: tuple[DataFrame, str]) -> DataFrame:
    """C-2: the requests of ``creates`` that fail because their parent is absent, soft-deleted or not named."""
    return creates.join(_live_parents(parent), parent[1], "left_anti")


def _live_parents(parent: tuple[DataFrame, str]) -> DataFrame:
    table, fk = parent
    return table.where(_live(table)).select(F.col("id").alias(fk))


def _live(target: DataFrame) -> Column:
    """Rows that management can see: not soft-deleted (tables without ``deleted_at`` have no others)."""
    return F.col("deleted_at").isNull() if "deleted_at" in target.columns else F.lit(True)


def apply_updates(target: DataFrame, updates: DataFrame, now: _dt.datetime,
                  order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """C-3: full-row overwrite of the given fields by id (empty ``last_error`` -> NULL).

    Rows of ``updates`` without a live target row are returned as not found.
    Several updates of one id are applied in turn by the columns ``order`` of
    ``updates`` (ties by value): the last one's values stand, and the version counts
    each.  Without ``order`` they are one request, of which the smallest values apply.
    Returns (snapshot, not_found).
    """
    fields = [c for c in updates.columns if c != "id" and c in target.columns and c not in (order or [])]
    live = target.where(_live(target)).select("id")
    not_found = updates.join(live, "id", "left_anti")
    values = F.struct(*[F.col(c) for c in fields], F.lit(0).alias("_"))
    chosen = F.max_by(values, F.struct(*order, values)) if order else F.min(values)
    times = F.count(F.lit(1)) if order else F.lit(1)
    updates = updates.groupBy("id").agg(chosen.alias("_f"), times.alias("_times")).select("id", "_f.*", "_times")
    u = updates.select("id", *[F.col(c).alias(f"_u_{c}") for c in fields], "_times", F.lit(True).alias("_hit"))
    j = target.join(u, "id", "left").withColumn("_hit", F.col("_hit") & _live(target))
    cols = []
    for f in target.schema.fields:
        c = f.name
        if c in fields:
            v = F.col(f"_u_{c}")
            if c == "last_error":
                v = F.nullif(v, F.lit(""))
            cols.append(F.when(F.col("_hit"), v.cast(f.dataType)).otherwise(F.col(c)).alias(c))
        elif c == "updated_at":
            cols.append(F.when(F.col("_hit"), utc_literal(now)).otherwise(F.col(c)).alias(c))
        elif c == "version":
            cols.append(F.when(F.col("_hit"), F.col(c) + F.col("_times")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols), not_found


def apply_deletes(target: DataFrame, deletes: DataFrame, children: list[tuple[DataFrame, str]],
                  now: _dt.datetime) -> tuple[DataFrame, DataFrame]:
    """C-4 + J-14 + A-2: delete by id; physical when no child row refers to it,
    else soft (``deleted_at = now``).  Rows already soft-deleted are not found.  Returns (snapshot, report(id, kind))."""
    ids = deletes.select("id").distinct().join(target.where(_live(target)).select("id"), "id", "left_semi")
    referenced = None
    for child, fk in children:
        r = child.select(F.col(fk).alias("id")).distinct()
        referenced = r if referenced is None else referenced.unionByName(r)
    if referenced is None:
        soft = ids.limit(0)
    else:
        soft = ids.join(referenced, "id", "left_semi")
    hard = ids.join(soft, "id", "left_anti")
    report = hard.withColumn("kind", F.lit("hard")).unionByName(soft.withColumn("kind", F.lit("soft")))
    kept = target.join(hard, "id", "left_anti")
    flag = soft.withColumn("_soft", F.lit(True))
    kept = kept.join(flag, "id", "left")
    cols = [F.when(F.col("_soft"), utc_literal(now)).otherwise(F.col(c)).alias(c)
            if c == "deleted_at" else F.col(c) for c in target.columns]
    return kept.select(*cols), report


# ------------------------------------------------------------- SC-5 / C-5

_POSIX = {"alpha": r"\p{Alpha}", "digit": r"\p{Digit}", "alnum": r"\p{Alnum}", "upper": r"\p{Upper}",
          "lower": r"\p{Lower}", "space": r"\s", "punct": r"\p{Punct}", "xdigit": r"\p{XDigit}",
          "word": r"\w", "blank": r"\p{Blank}", "cntrl": r"\p{Cntrl}", "print": r"\p{Print}",
          "graph": r"\p{Graph}"}


def re2_to_java(pattern: str) -> str:
    """Rewrite RE2 syntax to the Java dialect Spark's ``rlike`` uses (outside escapes):
    named groups ``(?P<n>`` -> ``(?:``, ``$`` -> ``\\z``, ``(?i)`` -> ``(?iu)``, POSIX classes."""
    out, i, in_class = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            out.append(pattern[i:i + 2]); i += 2; continue
        if in_class:
            m = re.match(r"\[:(\w+):\]", pattern[i:])
            if m and m.group(1) in _POSIX:
                out.append(_POSIX[m.group(1)]); i += m.end(); continue
            if ch == "]":
                in_class = False
            out.append(ch); i += 1; continue
        if ch == "[":
            in_class = True
            out.append(ch); i += 1
            if i < len(pattern) and pattern[i] == "^":
                out.append("^"); i += 1
            if i < len(pattern) and pattern[i] == "]":
                out.append("]"); i += 1
            continue
        m = re.match(r"\(\?P<\w+>", pattern[i:])
        if m:
            out.append("(?:"); i += m.end(); continue
        m = re.match(r"\(\?([imsU]+)(\)|:)", pattern[i:])
        if m and "i" in m.group(1) and "u" not in m.group(1):
            out.append("(?" + m.group(1) + "u" + m.group(2)); i += m.end(); continue
        if ch == "$":
            out.append(r"\z"); i += 1; continue
        out.append(ch); i += 1
    return "".join(out)


def pattern_error(pattern: str) -> str | None:
    """Why ``pattern`` is not a valid RE2 expression, or None."""
    if pattern is None:
        return "missing pattern"
    if re.search(r"\(\?<?[=!]", pattern):
        return "look-around is not supported"
    if re.search(r"(?<!\\)\\[1-9]", pattern):
        return "back-references are not supported"
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            re.compile(pattern)
    except re.error as exc:
        return str(exc)
    return None


@F.pandas_udf(T.StructType([T.StructField("error", T.StringType()), T.StructField("java", T.StringType())]))
def _check_patterns(patterns: pd.Series) -> pd.DataFrame:
    errs = [pattern_error(p) for p in patterns]
    java = [None if e else re2_to_java(p) for p, e in zip(patterns, errs)]
    return pd.DataFrame({"error": errs, "java": java})


def validate_rules(rules: DataFrame, col: str = "answer_regexp") -> tuple[DataFrame, DataFrame]:
    """SC-5 / C-5: split rules into (valid with the pattern rewritten for Spark,
    invalid with an ``error``).  Runs in the executors on Arrow batches."""
    checked = rules.withColumn("_chk", _check_patterns(F.col(col)))
    valid = checked.where(F.col("_chk.error").isNull()).withColumn(col, F.col("_chk.java")).drop("_chk")
    invalid = checked.where(F.col("_chk.error").isNotNull()).withColumn("error", F.col("_chk.error")).drop("_chk")
    return valid, invalid
