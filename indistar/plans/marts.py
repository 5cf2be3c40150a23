"""Mart models M14-M17.

M14 ``norm_question`` joins the observations to two small dimensions. The
dimensions are left to the planner: when they are read back from their
written tables (the job does that) their file size is known and the planner
broadcasts them under ``spark.sql.autoBroadcastJoinThreshold``, so the fact
side is never shuffled; computed inline, AQE converts the join to a broadcast
once the dimension's shuffle shows it is small, and otherwise keeps the
sort-merge join with skewed keys split. No broadcast is forced on a side whose
size has not been checked.

M15-M17 are grouped aggregates with partial (map-side) aggregation, so a key
holding a third of all rows costs one partial row per map task. The final
``orderBy`` is the model's declared order (O01) with NULLs last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.functions.scalars import default_label, indicator


def norm_question(normalized_df: DataFrame, dim_question: DataFrame,
                  dim_topic: DataFrame) -> DataFrame:
    """Observations with question and topic text.

    Fixed values: the mart's column names, ``footnote_symbole`` as it is spelt there.
    """
    b = normalized_df.alias("b")
    q = dim_question.alias("q")
    t = dim_topic.alias("t")
    return (b.join(q, F.col("q.question_id") == F.col("b.question_id"), "left")
            .join(t, F.col("t.topic_id") == F.col("q.topic_id"), "left")
            .select(F.col("b.year").alias("start_year"),
                    F.col("b.year_end").alias("end_year"),
                    F.col("b.unit").alias("value_unit"),
                    F.col("b.value_type").alias("value_type"),
                    F.col("b.value").alias("value"),
                    F.col("b.value_footnote_symbol").alias("footnote_symbole"),
                    F.col("b.value_footnote").alias("footnote"),
                    F.col("b.low_ci").alias("confidence_value_low"),
                    F.col("b.high_ci").alias("confidence_value_high"),
                    F.col("b.question_id").alias("question_id"),
                    F.col("q.question").alias("question_text"),
                    F.col("q.topic_id").alias("topic_id"),
                    F.col("t.topic").alias("topic_text")))


def _asc(*cols: str):
    return [F.asc_nulls_last(c) for c in cols]


def trend(clean_df: DataFrame, ordered: bool = True) -> DataFrame:
    """Indicator x category x subcategory x year: mean, sample stddev, count."""
    base = (clean_df.where(F.col("value").isNotNull())
            .select("year",
                    indicator("topic", "question").alias("indicator_name"),
                    default_label("strat_cat1").alias("category"),
                    default_label("strat1").alias("subcategory"),
                    "value"))
    out = (base.groupBy("indicator_name", "category", "subcategory", "year")
           .agg(F.avg("value").alias("avg_value"),
                F.stddev_samp("value").alias("stddev_value"),
                F.count(F.lit(1)).alias("n_obs")))
    return out.orderBy(*_asc("indicator_name", "category", "subcategory", "year")) if ordered else out


def year_overall(clean_df: DataFrame, ordered: bool = True) -> DataFrame:
    """Indicator x year: mean and count."""
    base = (clean_df.where(F.col("value").isNotNull())
            .select("year", indicator("topic", "question").alias("indicator_name"), "value"))
    out = (base.groupBy("indicator_name", "year")
           .agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n_obs")))
    return out.orderBy(*_asc("indicator_name", "year")) if ordered else out


def year_state(clean_df: DataFrame, ordered: bool = True) -> DataFrame:
    """Year x state x indicator: means of value and limits, count, name."""
    base = (clean_df.where(F.col("value").isNotNull())
            .select("year", "state", "state_name",
                    indicator("topic", "question").alias("indicator_name"),
                    "value", "low_ci", "high_ci"))
    # observations are summed by hash, with the name among the keys; the largest name is then
    # taken over those few sums (max of a string would sort all observations)
    def mean(c: str):
        return F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0))

    sums = base.groupBy("year", "state", "indicator_name", "state_name").agg(
        F.count(F.lit(1)).alias("n"),
        *(x for c in ("value", "low_ci", "high_ci")
          for x in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))))
    out = (sums.groupBy("year", "state", "indicator_name")
           .agg(F.max("state_name").alias("state_name"), mean("value").alias("avg_value"),
                F.sum("n").alias("record_count"), mean("low_ci").alias("avg_low_ci"),
                mean("high_ci").alias("avg_high_ci"))
           .select("year", "state", "state_name", "indicator_name", "avg_value", "record_count",
                   "avg_low_ci", "avg_high_ci"))
    return out.orderBy(*_asc("year", "state", "indicator_name")) if ordered else out
