"""Columns -> rows for the three repeated stratification slots.

J03  lateral unnest of the slots (one output row per usable slot)
O02  distinct union of the slots, done as one scan

Both use a generator (``inline`` of an array of same-named structs) over a
single pass of the input instead of three scans glued by ``union``: Spark does
not share a scan between union branches, so the generator reads the staged
data once. A generator is a narrow operator: no shuffle, partitions unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# slot n -> (category id, category, value id, value) column names
SLOT_FIELDS = ("strat_cat_id", "strat_cat", "strat_id", "strat")


def slot_columns(n: int) -> dict[str, str]:
    return {"strat_cat_id": f"strat_cat_id{n}", "strat_cat": f"strat_cat{n}",
            "strat_id": f"strat_id{n}", "strat": f"strat{n}"}


def slots_array(fields: Sequence[str] = SLOT_FIELDS, n_slots: int = 3) -> Column:
    """array(struct(slot1), struct(slot2), struct(slot3)) with equal field names."""
    return F.array(*[
        F.struct(*[F.col(slot_columns(i)[f]).alias(f) for f in fields])
        for i in range(1, n_slots + 1)
    ])


def unpivot_slots(df: DataFrame, keep: Sequence[str | Column],
                  fields: Sequence[str] = SLOT_FIELDS) -> DataFrame:
    """One row per (input row, slot), keeping ``keep`` columns; no filter."""
    return df.select(*keep, F.inline(slots_array(fields)))


def strata_slots(df: DataFrame, fields: Sequence[str], not_null: Sequence[str]) -> DataFrame:
    """Distinct slot tuples whose ``not_null`` fields are all set."""
    long = unpivot_slots(df, [], fields)
    cond = None
    for f in not_null:
        cond = F.col(f).isNotNull() if cond is None else cond & F.col(f).isNotNull()
    return long.where(cond).distinct()
