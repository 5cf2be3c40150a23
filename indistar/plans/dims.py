"""Dimension models M04-M10 (A01 distinct projections).

Each dimension is a distinct projection of the clean observations. The
aggregation is partial per input partition before the shuffle, so even a
100 TB fact scan shuffles only (#distinct tuples x #map tasks) rows; a hot
value occurring in a third of all rows costs one row per map task.

Dims are distinct *tuples*, not one row per id: a second spelling of a
question gives two rows for one id. The data-quality suite reports that
(D02) instead of silently choosing one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.operators.reshape import strata_slots


def location(clean_df: DataFrame) -> DataFrame:
    """Distinct (location_id int, abbr, name, lon, lat)."""
    return (clean_df.where(F.col("location_id").isNotNull())
            .select(F.col("location_id").cast("int").alias("location_id"),
                    F.col("state").alias("location_abbr"),
                    F.col("state_name").alias("location_desc"),
                    F.col("lon").cast("double").alias("lon"),
                    F.col("lat").cast("double").alias("lat"))
            .distinct())


def topic(clean_df: DataFrame) -> DataFrame:
    """Distinct (topic_id, topic)."""
    return clean_df.where(F.col("topic_id").isNotNull()).select("topic_id", "topic").distinct()


def question(clean_df: DataFrame) -> DataFrame:
    """Distinct (question_id, question, topic_id)."""
    return (clean_df.where(F.col("question_id").isNotNull())
            .select("question_id", "question", "topic_id").distinct())


def response(clean_df: DataFrame) -> DataFrame:
    """Distinct (response_id, response)."""
    return (clean_df.where(F.col("response_id").isNotNull())
            .select("response_id", "response").distinct())


def value_type(clean_df: DataFrame) -> DataFrame:
    """Distinct (value_type_id, value_type, unit); an id may repeat per unit."""
    return (clean_df.where(F.col("value_type_id").isNotNull())
            .select("value_type_id", "value_type", "unit").distinct())


def strat_category(clean_df: DataFrame) -> DataFrame:
    """Distinct (strat_cat_id, strat_cat) over the 3 slots, category id set."""
    return strata_slots(clean_df, ("strat_cat_id", "strat_cat"), ("strat_cat_id",))


def strat_value(clean_df: DataFrame) -> DataFrame:
    """Distinct (strat_cat_id, strat_id, strat); filtered on the value id only.

    The category id may be NULL here (a slot with a value but no category),
    unlike the long strata model, which needs both ids.
    """
    return strata_slots(clean_df, ("strat_cat_id", "strat_id", "strat"), ("strat_id",))


ALL = {
    "dim_location": location,
    "dim_topic": topic,
    "dim_question": question,
    "dim_response": response,
    "dim_value_type": value_type,
    "dim_strat_category": strat_category,
    "dim_strat_value": strat_value,
}
