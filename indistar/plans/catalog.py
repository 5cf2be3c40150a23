"""Named, self-contained queries: (spark, sf_dir) -> DataFrame.

Each builds from the provided star tables through the adapter, so its work
grows with the tables; each is one operator or model of the inventory (IDs in
the docstrings). Aggregate outputs are rounded with
:func:`~indistar.functions.scalars.stable_round` here, at the edge, so they
compare exactly across engines; the models themselves are unrounded.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.functions.scalars import (blank_to_null, default_label, indicator,
                                        normalize_number_columns, point_lat, point_lon,
                                        stable_round, surrogate_key)
from indistar.operators import quality, upsert
from indistar.plans import dims, facts, job, mart_state, marts, staging
from indistar.session import frees_shuffles, work_dir
from indistar.sources import fs, ordered, publish
from indistar.sources.contract import CSV_URI_ENV, RAW_COLUMNS, JobParams
from indistar.sources.csv import read_raw_csv, write_raw_csv
from indistar.sources.csv_split import read_raw_csv_split
from indistar.sources.landing import land_raw
from indistar.sources.star import raw_from_star

Query = Callable[[SparkSession, str], DataFrame]


def _clean(spark: SparkSession, sf_dir: str, strip: str = "first") -> DataFrame:
    return staging.clean(raw_from_star(spark, sf_dir), strip=strip)


def _staged(spark: SparkSession, sf_dir: str, strip: str = "first", of: Column | None = None) -> DataFrame:
    """The clean model, or its rows ``of`` a batch, written once to the work folder and read back.

    Queries that derive several models (publishing, the check suite, the
    upsert batches) read this table, as the job does, instead of
    re-deriving the staging for every model.
    """
    path = work_dir(spark, f"stg_clean_{strip}")
    rows = _clean(spark, sf_dir, strip)
    (rows if of is None else rows.where(of)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stg_raw(spark, sf_dir):
    """Raw rows under the contract (adapter output)."""
    return raw_from_star(spark, sf_dir)


def stg_clean(spark, sf_dir):
    """M02 (P01-P17, P20, P22)."""
    return _clean(spark, sf_dir)


def stg_normalized(spark, sf_dir):
    """M03 (P03)."""
    return staging.normalized(_clean(spark, sf_dir))


def _dim(name: str) -> Query:
    def q(spark, sf_dir):
        return dims.ALL[name](_clean(spark, sf_dir))
    q.__name__ = name
    q.__doc__ = f"{name}: {dims.ALL[name].__doc__}"
    return q


def strata_long(spark, sf_dir):
    """M11 (J03, P19, P21)."""
    return facts.strata_long(_clean(spark, sf_dir))


def fact_base(spark, sf_dir):
    """Duplicates of fact_sk kept."""
    return facts.fact_base(_clean(spark, sf_dir))


def fact_strat(spark, sf_dir):
    """M13."""
    return facts.fact_strat(facts.strata_long(_clean(spark, sf_dir)))


def mart_norm_question(spark, sf_dir):
    """M14 (J01, J02): the flagship mart."""
    c = _clean(spark, sf_dir)
    return marts.norm_question(staging.normalized(c), dims.question(c), dims.topic(c))


def mart_trend(spark, sf_dir):
    """M15 (A02-A05, P12, P18, O01)."""
    m = marts.trend(_clean(spark, sf_dir))
    return m.select("indicator_name", "category", "subcategory", "year",
                    stable_round("avg_value").alias("avg_value"),
                    stable_round("stddev_value").alias("stddev_value"), "n_obs")


def mart_year_overall(spark, sf_dir):
    """M16 (A02, A03, A05, P18, O01)."""
    m = marts.year_overall(_clean(spark, sf_dir))
    return m.select("indicator_name", "year", stable_round("avg_value").alias("avg_value"), "n_obs")


def mart_year_state(spark, sf_dir):
    """M17 (A02, A03, A05, A06, P18, O01)."""
    m = marts.year_state(_clean(spark, sf_dir))
    return m.select("year", "state", "state_name", "indicator_name",
                    stable_round("avg_value").alias("avg_value"), "record_count",
                    stable_round("avg_low_ci").alias("avg_low_ci"),
                    stable_round("avg_high_ci").alias("avg_high_ci"))


# ---------------------------------------------------------------- scalar rules

def number_normalise(spark, sf_dir, strip: str = "first"):
    """Raw value texts and their parsed numbers."""
    raw = raw_from_star(spark, sf_dir)
    return raw.select(
        F.col("DataValue").alias("data_value_text"),
        F.col("DataValueAlt").alias("data_value_alt_text"),
        F.col("LowConfidenceLimit").alias("low_ci_text"),
        F.col("HighConfidenceLimit").alias("high_ci_text"),
        normalize_number_columns(raw, "DataValue", "DataValueAlt", strip=strip).alias("value"),
        normalize_number_columns(raw, "LowConfidenceLimit", strip=strip).alias("low_ci"),
        normalize_number_columns(raw, "HighConfidenceLimit", strip=strip).alias("high_ci"))


def number_normalise_typed(spark, sf_dir):
    """The raw limits and amounts as the numbers they are: doubles and integers are taken, not parsed."""
    line = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    rows = line.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("double").alias("price"),
                       F.when(F.col("l_linenumber") % 3 > 0, F.col("l_linenumber").cast("int")).alias("line"),
                       F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
                       F.concat(F.col("l_linenumber").cast("string"), F.lit("%")).alias("share"))
    return rows.select("l_orderkey", "l_linenumber", normalize_number_columns(rows, "price").alias("price"),
                       normalize_number_columns(rows, "line", "share").alias("line_or_share"),
                       normalize_number_columns(rows, "quantity").alias("quantity"))


def number_normalise_all(spark, sf_dir):
    """P13 variant: every '%' / ',' removed (the evident intent)."""
    return number_normalise(spark, sf_dir, strip="all")


# The raw columns that the clean model blanks to NULL.
BLANKED = ("Response", "DataValueUnit", "DataValueFootnoteSymbol", "DataValueFootnote",
           "LocationID", "TopicID", "QuestionID", "ResponseID", "DataValueTypeID",
           "StratificationCategory2", "Stratification2", "StratificationCategory3",
           "Stratification3", "StratificationCategoryID1", "StratificationID1",
           "StratificationCategoryID2", "StratificationID2", "StratificationCategoryID3",
           "StratificationID3")


def blank_to_null_counts(spark, sf_dir):
    """NULLs per blanked column and 'Overall' labels, over all raw rows."""
    raw = raw_from_star(spark, sf_dir)
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(blank_to_null(c).isNull(), 1)).alias(f"n_null_{c.lower()}")
          for c in BLANKED],
        F.count(F.when(default_label("StratificationCategory1") == "Overall", 1)
                ).alias("n_overall_category"),
        F.count(F.when(default_label("Stratification1") == "Overall", 1)
                ).alias("n_overall_subcategory"))


def point_lon_lat(spark, sf_dir):
    """Coordinates from every raw point text."""
    raw = raw_from_star(spark, sf_dir)
    return raw.select(F.col("Geolocation").alias("geolocation"),
                      point_lon("Geolocation").alias("lon"), point_lat("Geolocation").alias("lat"))


def indicator_name(spark, sf_dir):
    """Distinct (topic, question, indicator_name)."""
    c = _clean(spark, sf_dir)
    return c.select("topic", "question", indicator("topic", "question").alias("indicator_name")
                    ).distinct()


def surrogate_keys(spark, sf_dir):
    """Key parts and the observation key of every clean row."""
    c = _clean(spark, sf_dir)
    return c.select(*facts.OBS_KEY, surrogate_key(*facts.OBS_KEY).alias("obs_sk"))


# ---------------------------------------------------------------- sources / sinks

def scan_csv_roundtrip(spark, sf_dir):
    """Raw rows written as CSV, read back under the contract."""
    path = work_dir(spark, "csv")
    write_raw_csv(raw_from_star(spark, sf_dir), path)
    back = read_raw_csv(spark, path, require_rows=True)
    return back.select([blank_to_null(c).alias(c) for c in RAW_COLUMNS])


def scan_csv_split(spark, sf_dir):
    """N01 in byte ranges: footnotes and questions that hold newlines and quotes, read by many tasks."""
    path = work_dir(spark, "csv_split")
    raw = raw_from_star(spark, sf_dir)
    note = F.col("DataValueFootnote")
    write_raw_csv(raw.withColumns({
        "DataValueFootnote": F.when(note != "", F.concat(note, F.lit('\nsee "notes",\n\n'), "Topic")).otherwise(note),
        "Question": F.concat(F.lit('"'), "Question", F.lit('"\n'))}), path)
    back = read_raw_csv_split(spark, path)
    return back.select([blank_to_null(c).alias(c) for c in RAW_COLUMNS])


def _landing_summary(df: DataFrame, step: str, landed_now: bool) -> DataFrame:
    return df.agg(F.lit(step).alias("step"), F.lit(landed_now).alias("landed_now"),
                  F.count(F.lit(1)).alias("n_rows"),
                  F.min("YearStart").alias("min_year"), F.max("YearStart").alias("max_year"),
                  F.countDistinct("QuestionID").alias("n_questions"))


def land_raw_idempotent(spark, sf_dir):
    """Land extract A; landing B without force is skipped; with force B replaces A.

    A and B are the two halves of the raw rows split by year (together the
    whole table). Each step's summary is written before the next step runs.
    """
    raw = raw_from_star(spark, sf_dir)
    a = raw.where(F.col("YearStart") <= "1997")
    b = raw.where(F.col("YearStart") > "1997")
    root = work_dir(spark, "landing")
    target = f"{root}/raw"
    summaries = []
    for step, rows, force in (("first", a, False), ("skip", b, False), ("force", b, True)):
        landed, now = land_raw(rows, target, force=force)
        out = f"{root}/summary_{step}"
        _landing_summary(landed, step, now).write.mode("overwrite").parquet(out)
        summaries.append(out)
    result = spark.read.parquet(summaries[0])
    for p in summaries[1:]:
        result = result.unionByName(spark.read.parquet(p))
    return result


def _folder(rows: DataFrame) -> str:
    """The folder of the written table that ``rows`` are made from."""
    return rows.inputFiles()[0].rpartition("/")[0]


def _fact_batches(spark, sf_dir, strata: bool) -> Iterator[DataFrame]:
    """Previous extract (years <= 2000) and a restated batch (years >= 2000), each staged when it is asked for.

    The batch re-normalises numbers with every separator stripped, so its
    values differ from the stored ones where the first-only rule fell back.
    Together the two cover every observation.
    """
    year = F.col("year")
    for strip, of in (("first", year <= 2000), ("all", year >= 2000)):
        staged = _staged(spark, sf_dir, strip=strip, of=of)
        yield facts.fact_strat(facts.strata_long(staged)) if strata else facts.fact_base(staged)


@frees_shuffles
def _upserted(spark, sf_dir, strata: bool):
    name = "fact_strat" if strata else "fact_base"
    key = facts.KEYS[name]
    root = work_dir(spark, key)
    batch_path = f"{root}_batch"   # the batch lands once, as a run would receive it
    batches = _fact_batches(spark, sf_dir, strata)

    def apply(rows: DataFrame) -> None:
        upsert.upsert(rows, root, key, facts.CLUSTER, slices=upsert.slices_of(spark, _folder(rows)))

    old = next(batches)
    apply(old)
    fs.delete(spark, _folder(old))   # what has been used up makes room
    batch = next(batches)
    batch.write.mode("overwrite").parquet(batch_path)
    fs.delete(spark, _folder(batch))
    batch = spark.read.parquet(batch_path)
    apply(batch)
    apply(batch)                     # the same batch again changes nothing
    fs.delete(spark, batch_path)
    return upsert.read_current(spark, root)


def upsert_fact_base(spark, sf_dir):
    """N07/N08/J05 on fact_base: keyed replace, in-batch duplicates kept."""
    return _upserted(spark, sf_dir, strata=False)


def upsert_fact_strat(spark, sf_dir):
    """N07/N08/J05 on fact_strat."""
    return _upserted(spark, sf_dir, strata=True)


def upsert_touched_buckets(spark, sf_dir):
    """All facts, then a batch restating one year; per bucket, whether it was written again, and its rows."""
    root = work_dir(spark, "touched")
    key = facts.KEYS["fact_base"]
    upsert.upsert(facts.fact_base(_clean(spark, sf_dir)), root, key, facts.CLUSTER)
    restated = facts.fact_base(_clean(spark, sf_dir, strip="all"))
    upsert.upsert(restated.where(F.col("year_start") == 1996), root, key, facts.CLUSTER)
    bucket = upsert.bucket_of(key, facts.CLUSTER, upsert.CLUSTERS, upsert.PER_CLUSTER)
    rows = (upsert.read_current(spark, root).groupBy(bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.round(F.col("data_value") * 100).cast("long")).alias("cents")))
    return upsert.rewritten(spark, root).join(rows, "bucket")


PUBLISH_PREFIX = "published/marts/"


def _published(spark, sf_dir) -> tuple[str, dict[str, str]]:
    root = work_dir(spark, "lake")
    _, paths = job.materialize(spark, _staged(spark, sf_dir), f"{root}/work", facts_too=False,
                               target=(root, PUBLISH_PREFIX))
    return root, publish.commit(spark, root, PUBLISH_PREFIX, {n: paths[n] for n in job.MART_NAMES})


def publish_roundtrip(spark, sf_dir):
    """Publish the marts under a prefix with a trailing '/', read one back."""
    root, _ = _published(spark, sf_dir)
    back = publish.read_mart(spark, publish.output_uri(root, PUBLISH_PREFIX, "agg_indicator_year_overall"))
    return back.select("indicator_name", "year", stable_round("avg_value").alias("avg_value"),
                       "n_obs")


ADHOC_QUERY = """
select state,
       max(state_name)                as state_name,
       count(*)                       as n_cells,
       sum(record_count)              as n_records,
       count(distinct indicator_name) as n_indicators,
       min(year)                      as first_year,
       max(year)                      as last_year
from agg_indicator_year_state
group by state
"""


def adhoc_sql(spark, sf_dir):
    """Ad-hoc SQL over the published marts, registered as views."""
    _, uris = _published(spark, sf_dir)
    return publish.adhoc_sql(spark, uris, ADHOC_QUERY)


TABLES_QUERY = """
select s.indicator_name, s.year, o.n_obs, count(*) as n_states, sum(s.record_count) as n_records
from {state} s join {overall} o on s.indicator_name = o.indicator_name and s.year = o.year
where s.year >= 1995 and o.n_obs > 1
group by s.indicator_name, s.year, o.n_obs
"""


def adhoc_tables(spark, sf_dir):
    """Two published marts joined as catalogued external tables, with statistics for the planner."""
    _, uris = _published(spark, sf_dir)
    tag = uuid.uuid4().hex[:8]  # the catalog belongs to the session, and other queries may run in it
    names = {n: f"{n}_{tag}" for n in ("agg_indicator_year_state", "agg_indicator_year_overall")}
    publish.register_tables(spark, {t: uris[n] for n, t in names.items()})
    return spark.sql(TABLES_QUERY.format(state=names["agg_indicator_year_state"],
                                         overall=names["agg_indicator_year_overall"]))


def _mart_state(spark, sf_dir) -> DataFrame:
    """States after two batches: the years to 2000, then the years from 2000 on, restated."""
    root = work_dir(spark, "mart_state")
    year = F.col("year")
    mart_state.apply_batch(_staged(spark, sf_dir, of=year <= 2000), root)
    mart_state.apply_batch(_staged(spark, sf_dir, strip="all", of=year >= 2000), root)
    return mart_state.read_state(spark, root)


def mart_trend_from_state(spark, sf_dir):
    """M15 kept up to date by mergeable states: as a full rebuild after both batches."""
    m = mart_state.trend(_mart_state(spark, sf_dir))
    return m.select(*TREND_KEYS, stable_round("avg_value").alias("avg_value"),
                    stable_round("stddev_value").alias("stddev_value"), "n_obs")


def mart_year_state_from_state(spark, sf_dir):
    """M17 kept up to date by mergeable states."""
    m = mart_state.year_state(_mart_state(spark, sf_dir))
    return m.select("year", "state", "state_name", "indicator_name",
                    stable_round("avg_value").alias("avg_value"), "record_count",
                    stable_round("avg_low_ci").alias("avg_low_ci"), stable_round("avg_high_ci").alias("avg_high_ci"))


def published_inventory(spark, sf_dir):
    """What was published, per mart; sizes vary by writer, so it says whether files and
    bytes were listed, and the rows that reading the mart back gives."""
    root, uris = _published(spark, sf_dir)
    listed = publish.inventory(spark, root, PUBLISH_PREFIX).select(
        "mart", (F.col("n_files") > 0).alias("has_files"), (F.col("total_bytes") > 0).alias("has_bytes"))
    counts = None
    for name, uri in uris.items():
        one = publish.read_mart(spark, uri).agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n_rows"))
        counts = one if counts is None else counts.unionByName(one)
    return listed.join(counts, "mart")


# ---------------------------------------------------------------- data quality

def dq_not_null(spark, sf_dir):
    """not_null(response_id) on the normalized model - the check left out of
    the declared suite because the column is legitimately empty: its failures."""
    return quality.not_null(staging.normalized(_clean(spark, sf_dir)), "response_id")


def dq_unique(spark, sf_dir):
    """unique(fact_base.fact_sk) - the incremental key is not unique."""
    return quality.unique(facts.fact_base(_clean(spark, sf_dir)), "fact_sk")


def dq_relationships(spark, sf_dir):
    """dim_question.topic_id against a parent missing its first topic."""
    c = _clean(spark, sf_dir)
    topics = dims.topic(c)
    first = topics.agg(F.min("topic_id").alias("first_topic"))
    parent = topics.join(first, F.col("topic_id") == F.col("first_topic"), "left_anti")
    return quality.relationships(dims.question(c), "topic_id", parent, "topic_id")


DQ_COMBINATION = ("year_start", "year_end", "location_id", "topic_id", "question_id",
                  "response_id", "value_type_id")


def dq_unique_combination(spark, sf_dir):
    """The fact key's parts (without state) as a combination key; NULLs group."""
    return quality.unique_combination(facts.fact_base(_clean(spark, sf_dir)), DQ_COMBINATION)


def dq_report(spark, sf_dir):
    """The declared suite over every model, one row per check."""
    models, _ = job.materialize(spark, _staged(spark, sf_dir), work_dir(spark, "models"),
                                facts_too=False)
    return quality.run_checks(models, job.DECLARED_CHECKS)


def broken(models: dict) -> dict:
    """The models with planted faults: nulls, repeated rows, missing parents."""
    def null_where(df, column, condition):
        return df.withColumn(column, F.when(condition, F.lit(None)).otherwise(F.col(column)))

    year, state = F.col("year"), "agg_indicator_year_state"
    topic = models["dim_topic"]
    least = topic.agg(F.min("topic_id").alias("topic_id"))
    return models | {
        "stg_normalized": null_where(models["stg_normalized"], "question_id", F.col("value_type_id") == "A"),
        "dim_topic": topic.join(least, "topic_id", "left_anti").unionByName(topic.where("topic_id like 'T4%'")),
        "dim_question": models["dim_question"].unionByName(models["dim_question"].where("topic_id like 'T1%'")),
        "dim_strat_category": models["dim_strat_category"].where("strat_cat_id <> 'SEG'"),
        state: null_where(models[state], "avg_value", year == 1995).unionByName(models[state].where(year == 1996)),
        "agg_indicator_trend": null_where(models["agg_indicator_trend"], "category", year == 1997),
    }


def dq_report_broken(spark, sf_dir):
    """The declared suite over models with planted faults; checks fail, with counts."""
    models, _ = job.materialize(spark, _staged(spark, sf_dir), work_dir(spark, "models"),
                                facts_too=False)
    return quality.run_checks(broken(models), job.DECLARED_CHECKS)


TREND_KEYS = ("indicator_name", "category", "subcategory", "year")


def mart_trend_ordered(spark, sf_dir):
    """The trend mart written in its order over several files; every row's position on reading."""
    path = ordered.write_ordered(marts.trend(_clean(spark, sf_dir), ordered=False),
                                 work_dir(spark, "trend_ordered"), TREND_KEYS)
    return ordered.read_ordered(spark, path).select("position", *TREND_KEYS, "n_obs")


def input_precedence(spark, sf_dir):
    """The path given to a run, then the environment's, and the rows that each leads to."""
    root = work_dir(spark, "precedence")
    raw = raw_from_star(spark, sf_dir)
    year = F.col("YearStart")
    for name, rows in (("run", raw.where(year <= "1997")), ("environment", raw.where(year > "1997"))):
        write_raw_csv(rows, f"{root}/{name}")
    out, before = None, os.environ.get(CSV_URI_ENV)
    os.environ[CSV_URI_ENV] = f"{root}/environment"
    try:
        for wins, given in (("run", f"{root}/run"), ("environment", None)):
            one = read_raw_csv_split(spark, JobParams(csv_uri=given).resolved_csv_uri()).agg(
                F.lit(wins).alias("wins"), F.count(F.lit(1)).alias("n_rows"), F.min(year).alias("first_year"),
                F.max(year).alias("last_year"))
            out = one if out is None else out.unionByName(one)
    finally:
        os.environ.pop(CSV_URI_ENV) if before is None else os.environ.update({CSV_URI_ENV: before})
    return out


@frees_shuffles
def incremental_from_csv(spark, sf_dir):
    """Runs over a folder that gains CSV files; per run, whether files were read, and the facts after it."""
    root = work_dir(spark, "incremental")
    raw = raw_from_star(spark, sf_dir)
    params = JobParams(csv_uri=f"{root}/csv")
    summaries = []
    for number, years in enumerate((F.col("YearStart") <= "1996", F.col("YearStart") > "1996", None)):
        if years is not None:
            write_raw_csv(raw.where(years), f"{root}/csv/{number}", compression="gzip")
        roots, n_files = job.run_incremental(spark, params, f"{root}/work")
        for name, at in roots.items():
            out = f"{root}/summary/{number}-{name}"
            upsert.read_current(spark, at).agg(
                F.lit(number).alias("run"), F.lit(name).alias("table_name"), F.lit(n_files > 0).alias("read_files"),
                F.count(F.lit(1)).alias("n_rows"),
                F.sum(F.round(F.col("data_value") * 100).cast("long")).alias("cents")).write.parquet(out)
            summaries.append(out)
    return spark.read.parquet(*summaries)


# Per table of the job: the year column and what is summed (hundredths of values, or counts).
JOB_SUMS = {
    "agg_norm_question": ("start_year", "cast(round(value * 100) as bigint)"),
    "agg_indicator_trend": ("year", "n_obs"),
    "agg_indicator_year_overall": ("year", "n_obs"),
    "agg_indicator_year_state": ("year", "record_count"),
    "fact_base": ("year_start", "cast(round(data_value * 100) as bigint)"),
    "fact_strat": ("year_start", "cast(round(data_value * 100) as bigint)"),
}


@frees_shuffles
def whole_job_from_csv(spark, sf_dir):
    """The job run from a CSV path; per table it wrote, its rows and sums."""
    root = work_dir(spark, "whole_job")
    write_raw_csv(raw_from_star(spark, sf_dir), f"{root}/csv", compression="gzip")
    res = job.run(spark, JobParams(csv_uri=f"{root}/csv", output_prefix=PUBLISH_PREFIX), f"{root}/work")
    tables = {n: spark.read.parquet(p) for n, p in res.dims.items()}
    tables |= {n: upsert.read_current(spark, p) for n, p in res.facts.items()}
    tables |= {n: publish.read_mart(spark, p) for n, p in res.published.items()}
    out = None
    for name, df in tables.items():
        year, amount = JOB_SUMS.get(name, ("0", "0"))
        one = df.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.expr(year)).alias("year_sum"), F.sum(F.expr(amount)).alias("amount_sum"))
        out = one if out is None else out.unionByName(one)
    return out


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "stg_raw": stg_raw,
        "stg_clean": stg_clean,
        "stg_normalized": stg_normalized,
    }
    for name in dims.ALL:
        out[name] = _dim(name)
    out.update({
        "strata_long": strata_long,
        "fact_base": fact_base,
        "fact_strat": fact_strat,
        "mart_norm_question": mart_norm_question,
        "mart_trend": mart_trend,
        "mart_year_overall": mart_year_overall,
        "mart_year_state": mart_year_state,
        "number_normalise": number_normalise,
        "number_normalise_all": number_normalise_all,
        "number_normalise_typed": number_normalise_typed,
        "blank_to_null": blank_to_null_counts,
        "point_lon_lat": point_lon_lat,
        "indicator_name": indicator_name,
        "surrogate_keys": surrogate_keys,
        "scan_csv_roundtrip": scan_csv_roundtrip,
        "scan_csv_split": scan_csv_split,
        "land_raw_idempotent": land_raw_idempotent,
        "upsert_fact_base": upsert_fact_base,
        "upsert_fact_strat": upsert_fact_strat,
        "upsert_touched_buckets": upsert_touched_buckets,
        "publish_roundtrip": publish_roundtrip,
        "adhoc_sql": adhoc_sql,
        "adhoc_tables": adhoc_tables,
        "mart_trend_from_state": mart_trend_from_state,
        "mart_year_state_from_state": mart_year_state_from_state,
        "published_inventory": published_inventory,
        "dq_not_null": dq_not_null,
        "dq_unique": dq_unique,
        "dq_relationships": dq_relationships,
        "dq_unique_combination": dq_unique_combination,
        "dq_report": dq_report,
        "dq_report_broken": dq_report_broken,
        "mart_trend_ordered": mart_trend_ordered,
        "incremental_from_csv": incremental_from_csv,
        "input_precedence": input_precedence,
        "whole_job_from_csv": whole_job_from_csv,
    })
    return out
