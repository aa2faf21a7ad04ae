"""Small side inputs (rules, hypotheses, lexicons) attached to every row.

A side table of configuration (rules, templates x labels) is turned into
one array value by a scalar subquery; each row then explodes it.  This is
the set-at-a-time form of "for each rule: ..." without a join: the array is
computed once, shipped with the task, and its size is checked first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.common import BROADCAST_MAX_ROWS


class SideInputTooLarge(ValueError):
    pass


def check_side_size(side: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> None:
    n = side.limit(max_rows + 1).count()
    if n > max_rows:
        raise SideInputTooLarge(f"side input has more than {max_rows} rows")


def side_rows(side: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> list:
    """The rows of a side table on the driver, to go to the tasks with a function; its size is checked."""
    rows = side.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise SideInputTooLarge(f"side input has more than {max_rows} rows")
    return rows


def side_array(side: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> Column:
    """Scalar-subquery column holding ``array<struct<side columns>>``."""
    check_side_size(side, max_rows)
    return side.select(F.collect_list(F.struct(*side.columns))).scalar()


def explode_side(df: DataFrame, side: DataFrame, prefix: str = "") -> DataFrame:
    """Every row of ``df`` once per row of the (small) ``side`` table."""
    arr = side_array(side)
    out = df.select("*", F.explode(arr).alias("_side"))
    return out.select(*df.columns, *[F.col(f"_side.{c}").alias(prefix + c) for c in side.columns])
