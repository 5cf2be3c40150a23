"""Staging models M01-M03: raw -> clean -> normalized.

M02 ``clean`` is one narrow projection + filter over the raw rows: no shuffle,
fully inside whole-stage codegen, and its ``value is not null`` filter sits
right above the scan. When the raw rows come from Parquet (the landed raw, see
:mod:`indistar.sources.landing`) only the referenced columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.functions.scalars import (blank_to_null, normalize_number_columns, point_lat,
                                        point_lon)

# Output column order of the clean model (34 columns).
CLEAN_COLUMNS = (
    "year", "year_end", "state", "state_name", "data_source", "topic", "question", "response",
    "unit", "value_type", "value", "value_footnote_symbol", "value_footnote", "low_ci", "high_ci",
    "location_id", "topic_id", "question_id", "response_id", "value_type_id",
    "strat_cat1", "strat1", "strat_cat2", "strat2", "strat_cat3", "strat3",
    "strat_cat_id1", "strat_id1", "strat_cat_id2", "strat_id2", "strat_cat_id3", "strat_id3",
    "lon", "lat",
)

# Output column order of the normalized model (25 columns).
NORMALIZED_COLUMNS = (
    "year", "year_end", "unit", "value_type", "value", "value_footnote_symbol", "value_footnote",
    "low_ci", "high_ci", "location_id", "question_id", "response_id", "value_type_id",
    "strat_cat_id1", "strat_id1", "strat_cat_id2", "strat_id2", "strat_cat_id3", "strat_id3",
    "strat_cat1", "strat1", "strat_cat2", "strat2", "strat_cat3", "strat3",
)


def clean(raw: DataFrame, strip: str = "first") -> DataFrame:
    """Typed, snake_case observations that carry a usable value.

    P01 rename, P02 computed measures, P04 strict int casts (ANSI: bad text
    raises), P11 blanks to NULL (stratification slot 1 keeps its blanks, as
    the model does), P15/P16 numbers, P17 coordinates, P20 filter.
    """
    b = blank_to_null
    out = raw.select(
        F.col("YearStart").cast("int").alias("year"),
        F.col("YearEnd").cast("int").alias("year_end"),
        F.col("LocationAbbr").alias("state"),
        F.col("LocationDesc").alias("state_name"),
        F.col("DataSource").alias("data_source"),
        F.col("Topic").alias("topic"),
        F.col("Question").alias("question"),
        b("Response").alias("response"),
        b("DataValueUnit").alias("unit"),
        F.col("DataValueType").alias("value_type"),
        normalize_number_columns(raw, "DataValue", "DataValueAlt", strip=strip).alias("value"),
        b("DataValueFootnoteSymbol").alias("value_footnote_symbol"),
        b("DataValueFootnote").alias("value_footnote"),
        normalize_number_columns(raw, "LowConfidenceLimit", strip=strip).alias("low_ci"),
        normalize_number_columns(raw, "HighConfidenceLimit", strip=strip).alias("high_ci"),
        b("LocationID").alias("location_id"),
        b("TopicID").alias("topic_id"),
        b("QuestionID").alias("question_id"),
        b("ResponseID").alias("response_id"),
        b("DataValueTypeID").alias("value_type_id"),
        F.col("StratificationCategory1").alias("strat_cat1"),
        F.col("Stratification1").alias("strat1"),
        b("StratificationCategory2").alias("strat_cat2"),
        b("Stratification2").alias("strat2"),
        b("StratificationCategory3").alias("strat_cat3"),
        b("Stratification3").alias("strat3"),
        b("StratificationCategoryID1").alias("strat_cat_id1"),
        b("StratificationID1").alias("strat_id1"),
        b("StratificationCategoryID2").alias("strat_cat_id2"),
        b("StratificationID2").alias("strat_id2"),
        b("StratificationCategoryID3").alias("strat_cat_id3"),
        b("StratificationID3").alias("strat_id3"),
        point_lon("Geolocation").alias("lon"),
        point_lat("Geolocation").alias("lat"),
    )
    return out.where(F.col("value").isNotNull())


def normalized(clean_df: DataFrame) -> DataFrame:
    """The narrow column subset of the clean model."""
    return clean_df.select(*NORMALIZED_COLUMNS)
