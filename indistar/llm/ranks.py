"""Positions and running sums over a table in a total order, without one task seeing it all.

Rows are range-partitioned and written with their place in their partition; what precedes a
partition follows from one small row per partition. A group that holds most rows simply
spans many partitions, and rows that are equal in every ordering column are told apart by
their place of origin, so even they spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indistar.llm.common import materialize

#: Columns that the helpers add and drop again; inputs must not have them.
_TIE, _AT, _PART = "_tie", "_at", "_part"


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows``, written sorted, with partition number and place within it."""
    keys = [*order, _TIE]
    tied = rows.withColumn(_TIE, F.monotonically_increasing_id())
    out = (tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_TIE)
           .withColumn(_AT, F.monotonically_increasing_id())
           .withColumn(_PART, F.shiftright(_AT, 33).cast("int")))
    return materialize(out, "placed")


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order`` within the group) and ``n`` (the group's rows).

    ``rows`` should be a written table (it is read twice) and ``group`` must not be null.
    """
    placed = _placed(rows, [group, *order])
    own = placed.groupBy(group, _PART).agg(F.count(F.lit(1)).alias("_c"), F.min(_AT).alias("_first"))
    w = Window.partitionBy(group)
    own = own.select(group, _PART, "_first", F.sum("_c").over(w).alias("n"),
                     (F.sum("_c").over(w.orderBy(_PART)) - F.col("_c")).alias("_before"))
    return (placed.join(own, [group, _PART])
            .withColumn("pos", F.col("_before") + F.col(_AT) - F.col("_first"))
            .drop(_AT, _PART, "_first", "_before"))


def running_sum(rows: DataFrame, order: Sequence[str], value: str, into: str) -> DataFrame:
    """``rows`` with ``into``: the sum of the long ``value`` over all rows before, by ``order``.

    A partition is summed by one task; the sums of partitions, one row each, are broadcast.
    """
    placed = _placed(rows, order)
    parts = placed.groupBy(_PART).agg(F.sum(value).alias("_c"))
    parts = parts.select(_PART, (F.sum("_c").over(Window.orderBy(_PART)) - F.col("_c")).alias("_before"))
    own = F.sum(value).over(Window.partitionBy(_PART).orderBy(_AT)) - F.col(value)
    return (placed.withColumn("_own", own).join(F.broadcast(parts), _PART)
            .withColumn(into, F.col("_before") + F.col("_own")).drop(_AT, _PART, "_own", "_before"))
