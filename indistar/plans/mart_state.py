"""M15-M17 kept up to date: mart cells as mergeable states, bucket by bucket.

The clean observations are a keyed table (:mod:`indistar.operators.upsert`). For each of its
buckets a state holds, per mart cell, the count, mean and second central moment of the values, and sums and counts of the
limits. States of one cell merge without the observations, so a mart is the merge of
all buckets' states. A batch rewrites some buckets; only their states are computed anew, from those
buckets' rows alone, and all others are carried by reference. Nothing is ever subtracted, so a
restated batch leaves the same numbers as a full rebuild, deviations included.

A state table's manifest records which folders of the observations it was made from: a refresh that
dies before its commit is simply done again, and one with nothing to do reads nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.functions.scalars import default_label, indicator, surrogate_key
from indistar.operators import upsert
from indistar.plans.facts import OBS_KEY
from indistar.sources import manifest

KEY, CLUSTER = "obs_sk", ("year",)
OBSERVATIONS, STATE = "observations", "mart_state"
#: Finest cell of all three marts.
CELL = ("indicator_name", "category", "subcategory", "year", "state", "state_name")
BUCKET = upsert.BUCKET


def apply_batch(clean_batch: DataFrame, root: str) -> int:
    """Upsert a batch of clean observations and refresh the states; the number of buckets refreshed."""
    batch = clean_batch.where(F.col("value").isNotNull()).withColumn(KEY, surrogate_key(*OBS_KEY))
    upsert.upsert(batch, f"{root}/{OBSERVATIONS}", KEY, CLUSTER)
    return refresh(clean_batch.sparkSession, root)


def refresh(spark: SparkSession, root: str) -> int:
    """Bring the states up to the observations' current version."""
    source, target = f"{root}/{OBSERVATIONS}", f"{root}/{STATE}"
    rows, m = manifest.current(spark, source), manifest.current(spark, target)
    entries, made_from = (dict(m.entries), dict(m.facts["made_from"])) if m else ({}, {})
    changed = [b for b, folders in rows.entries.items() if made_from.get(b) != folders]
    if not changed:
        return 0
    bucket = upsert.bucket_of(KEY, CLUSTER, rows.facts["clusters"], rows.facts["per"])
    states = _states(upsert._read(spark, source, rows, [p for b in changed for p in rows.entries[b]]), bucket)
    folder = f"{upsert.DATA}/s-{uuid.uuid4().hex[:12]}"
    written = upsert._write(states, target, folder, F.col("_b"))
    entries.update({b: written.get(b, []) for b in changed})
    made_from.update({b: rows.entries[b] for b in changed})
    manifest.commit(spark, target, entries, {"made_from": made_from})
    manifest.vacuum(spark, target, upsert.DATA, keep=2)
    return len(changed)


def _states(clean_df: DataFrame, bucket: Column) -> DataFrame:
    cells = clean_df.select(bucket.alias("_b"), indicator("topic", "question").alias("indicator_name"),
                            default_label("strat_cat1").alias("category"), default_label("strat1").alias("subcategory"),
                            "year", "state", "state_name", "value", "low_ci", "high_ci")
    return cells.groupBy("_b", *CELL).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
        (F.coalesce(F.var_pop("value"), F.lit(0.0)) * F.count("value")).alias("m2"),
        *(x for c in ("low_ci", "high_ci") for x in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    m = manifest.current(spark, f"{root}/{STATE}")
    if m is None:
        raise FileNotFoundError(f"no mart state under {root}")
    return spark.read.parquet(*(f"{root}/{STATE}/{p}" for folders in m.entries.values() for p in folders))


def merged(state: DataFrame, *keys: str) -> DataFrame:
    """keys, n, mean, m2 of the coarser cells: count and mean first, then the moments about that mean.

    Both passes aggregate before they shuffle, so a cell may have any number of states.
    """
    total = state.groupBy(*keys).agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"))
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    both = state.alias("s").join(total.alias("t"), same)
    apart = F.col("s.mean") - F.col("t.mean")
    return both.groupBy(*(F.col(f"t.{k}").alias(k) for k in keys), F.col("t.n").alias("n"), F.col("t.mean").alias("mean")).agg(
        F.sum(F.col("s.m2") + F.col("s.n") * apart * apart).alias("m2"))


def trend(state: DataFrame) -> DataFrame:
    """M15 from the states."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return merged(state, "indicator_name", "category", "subcategory", "year").select(
        "indicator_name", "category", "subcategory", "year", F.col("mean").alias("avg_value"),
        deviation.alias("stddev_value"), F.col("n").alias("n_obs"))


def year_overall(state: DataFrame) -> DataFrame:
    """M16 from the states."""
    return state.groupBy("indicator_name", "year").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("avg_value"), F.sum("n").alias("n_obs"))


def year_state(state: DataFrame) -> DataFrame:
    """M17 from the states."""
    def mean(c: str) -> Column:
        return F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0))
    return (state.groupBy("year", "state", "indicator_name")
            .agg(F.max("state_name").alias("state_name"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("avg_value"),
                 F.sum("n").alias("record_count"), mean("low_ci").alias("avg_low_ci"), mean("high_ci").alias("avg_high_ci"))
            .select("year", "state", "state_name", "indicator_name", "avg_value", "record_count", "avg_low_ci", "avg_high_ci"))
