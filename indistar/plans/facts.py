"""Long strata and fact models M11-M13.

``fact_sk`` hashes the observation attributes but not the strata, so it is not
unique within a batch; ``fact_strat_sk`` adds the slot ids and is narrower but
still not guaranteed unique. Duplicates are kept on purpose (a keyed upsert
replaces every row of a key and keeps in-batch duplicates); nothing here calls
``dropDuplicates``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.functions.scalars import surrogate_key
from indistar.operators.reshape import unpivot_slots

# The observation key parts, in hashing order.
OBS_KEY = ("year", "year_end", "location_id", "topic_id", "question_id", "response_id",
           "value_type_id", "state")

# Keys of the incremental tables, and the column that both keys determine (a part of each).
KEYS = {"fact_base": "fact_sk", "fact_strat": "fact_strat_sk"}
CLUSTER = ("year_start",)

STRATA_LONG_KEEP = ("year", "year_end", "location_id", "state", "state_name", "lon", "lat",
                    "topic_id", "topic", "question_id", "question", "response_id", "response",
                    "value_type_id", "value_type", "unit", "data_source", "value", "low_ci",
                    "high_ci")


def strata_long(clean_df: DataFrame) -> DataFrame:
    """Observation x usable stratification slot (0-3 rows per observation).

    J03 unnest + P21: a slot is usable when both its category id and value id
    are set. ``obs_sk`` (P19) identifies the observation.
    """
    keep = [surrogate_key(*OBS_KEY).alias("obs_sk"), *STRATA_LONG_KEEP]
    long = unpivot_slots(clean_df, keep)
    return long.where(F.col("strat_cat_id").isNotNull() & F.col("strat_id").isNotNull())


def fact_base(clean_df: DataFrame) -> DataFrame:
    """One row per observation with a value; key ``fact_sk``."""
    return (clean_df.where(F.col("value").isNotNull())
            .select(surrogate_key(*OBS_KEY).alias("fact_sk"),
                    F.col("year").cast("int").alias("year_start"),
                    F.col("year_end").cast("int").alias("year_end"),
                    F.col("location_id").cast("int").alias("location_id"),
                    "topic_id", "question_id", "response_id", "value_type_id", "data_source",
                    F.col("value").cast("double").alias("data_value"),
                    F.col("low_ci").cast("double").alias("low_confidence_limit"),
                    F.col("high_ci").cast("double").alias("high_confidence_limit")))


def fact_strat(long_df: DataFrame) -> DataFrame:
    """One row per observation x slot; key ``fact_strat_sk``."""
    return (long_df.where(F.col("value").isNotNull())
            .select(surrogate_key("obs_sk", "strat_cat_id", "strat_id").alias("fact_strat_sk"),
                    F.col("year").cast("int").alias("year_start"),
                    F.col("year_end").cast("int").alias("year_end"),
                    F.col("location_id").cast("int").alias("location_id"),
                    "topic_id", "question_id", "response_id", "value_type_id",
                    "strat_cat_id", "strat_id",
                    F.col("value").cast("double").alias("data_value"),
                    F.col("low_ci").cast("double").alias("low_confidence_limit"),
                    F.col("high_ci").cast("double").alias("high_confidence_limit"),
                    "data_source"))
