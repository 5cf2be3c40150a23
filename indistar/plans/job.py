"""The whole batch job: land -> gate -> stage -> build -> test -> publish -> list.

Materialisation plan (what is written, and why):

* raw rows are landed once as Parquet (N03); the CSV is never re-parsed;
* the clean observations are written once; every model reads that table
  with pruned columns instead of re-running the staging expressions;
* dimensions are written as small tables, so joins against them see a
  real file size and are broadcast by the planner's size check; beyond
  the threshold they stay sort-merge joins;
* facts are maintained by keyed upsert into bucketed tables (N07);
* marts are built from the staged table and written once, where they will be published; checks
  read them there, and only then one commit shows them (N06/N09/N10), so a failing run leaves the
  previously published marts as they were.

Every intermediate is a written table in the work folder (never a local
checkpoint), so a lost executor costs a task retry, not a recomputation
from the source, and lineage stays short. Every write is a recorded step: a job that was killed
goes on, when it is run again, with the first step that had not finished.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.operators import quality, upsert
from indistar.operators.quality import Check
from indistar.plans import dims, facts, marts, staging
from indistar.plans.steps import Steps
from indistar.session import frees_shuffles
from indistar.sources import fs, ledger, publish, versions
from indistar.sources.contract import JobParams
from indistar.sources.csv import read_raw_csv
from indistar.sources.csv_split import read_raw_csv_split
from indistar.sources.landing import land_raw

# The declared data tests. Model, column and kind are as
# declared for the active models and for the aggregate marts; the block for
# the staged normalized model is attached to that model (its declared name
# had a typo, so it attached to nothing) and keeps only columns the model has.
DECLARED_CHECKS = (
    Check("not_null", "stg_normalized", ("location_id",)),
    Check("not_null", "stg_normalized", ("question_id",)),
    Check("not_null", "stg_normalized", ("value_type_id",)),
    Check("not_null", "dim_location", ("location_id",)),
    Check("unique", "dim_location", ("location_id",)),
    Check("not_null", "dim_topic", ("topic_id",)),
    Check("unique", "dim_topic", ("topic_id",)),
    Check("not_null", "dim_question", ("question_id",)),
    Check("unique", "dim_question", ("question_id",)),
    Check("relationships", "dim_question", ("topic_id",), "dim_topic", "topic_id"),
    Check("unique", "dim_response", ("response_id",)),
    Check("not_null", "dim_value_type", ("value_type_id",)),
    Check("not_null", "dim_strat_category", ("strat_cat_id",)),
    Check("unique", "dim_strat_category", ("strat_cat_id",)),
    Check("not_null", "dim_strat_value", ("strat_id",)),
    Check("relationships", "dim_strat_value", ("strat_cat_id",), "dim_strat_category",
          "strat_cat_id"),
    Check("not_null", "agg_indicator_year_state", ("year",)),
    Check("not_null", "agg_indicator_year_state", ("state",)),
    Check("not_null", "agg_indicator_year_state", ("indicator_name",)),
    Check("not_null", "agg_indicator_year_state", ("avg_value",)),
    Check("unique_combination_of_columns", "agg_indicator_year_state",
          ("year", "state", "indicator_name")),
    Check("not_null", "agg_indicator_trend", ("indicator_name",)),
    Check("not_null", "agg_indicator_trend", ("category",)),
    Check("not_null", "agg_indicator_trend", ("subcategory",)),
    Check("not_null", "agg_indicator_trend", ("year",)),
    Check("not_null", "agg_indicator_trend", ("avg_value",)),
    Check("unique_combination_of_columns", "agg_indicator_trend",
          ("indicator_name", "category", "subcategory", "year")),
    Check("not_null", "agg_indicator_year_overall", ("indicator_name",)),
    Check("not_null", "agg_indicator_year_overall", ("year",)),
    Check("not_null", "agg_indicator_year_overall", ("avg_value",)),
    Check("unique_combination_of_columns", "agg_indicator_year_overall",
          ("indicator_name", "year")),
)

# Published mart names.
MART_NAMES = ("agg_norm_question", "agg_indicator_trend", "agg_indicator_year_overall",
              "agg_indicator_year_state")


def build_models(clean_df: DataFrame, dim_tables: dict[str, DataFrame] | None = None
                 ) -> dict[str, DataFrame]:
    """All models over one clean source, lazily (N05: each is a view)."""
    d = dim_tables or {name: fn(clean_df) for name, fn in dims.ALL.items()}
    long = facts.strata_long(clean_df)
    normalized = staging.normalized(clean_df)
    models = {
        "stg_clean": clean_df,
        "stg_normalized": normalized,
        **d,
        "int_strata_long": long,
        "fact_base": facts.fact_base(clean_df),
        "fact_strat": facts.fact_strat(long),
        "agg_norm_question": marts.norm_question(normalized, d["dim_question"], d["dim_topic"]),
        "agg_indicator_trend": marts.trend(clean_df),
        "agg_indicator_year_overall": marts.year_overall(clean_df),
        "agg_indicator_year_state": marts.year_state(clean_df),
    }
    return models


def _in_parallel(tasks: dict[str, Callable], workers: int = 4) -> dict:
    """Run independent Spark actions concurrently (one job per thread).

    The scheduler interleaves their tasks on the executors: many small
    writes (dimensions, marts) no longer wait for each other, and a large
    write still gets the whole cluster when it is alone.
    """
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: fut.result() for name, fut in futures.items()}


@dataclass
class JobResult:
    landed: str
    staged: str
    dims: dict[str, str]
    facts: dict[str, str]
    published: dict[str, str]
    report: DataFrame
    inventory: DataFrame
    landed_now: bool = True
    steps: list[str] = field(default_factory=list)   # what this run has done itself


def materialize(spark: SparkSession, clean_df: DataFrame, work_root: str,
                facts_too: bool = True, target: tuple[str, str | None] | None = None,
                steps: Steps | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Write dimensions, then marts (and fact upserts), each once; read them back.

    Returns the models (written ones replaced by their read-back tables) and
    the written paths. Dimensions are written first so the mart join sees
    their real size; the independent writes of one level run concurrently.
    Marts are staged under ``target`` (root, prefix), where a commit publishes them without
    another write, or else under the work root. Every write is a step (:mod:`indistar.plans.steps`).
    """
    work_root = work_root.rstrip("/")
    steps = steps or Steps(spark, work_root)
    root, prefix = target or (work_root, "marts")
    staged = ("stg_clean",) if "stg_clean" in steps.prints else ()

    def dimension(name: str) -> Callable[[], DataFrame]:
        return lambda: steps.write(name, lambda: dims.ALL[name](clean_df), after=staged)

    written = _in_parallel({name: dimension(name) for name in dims.ALL})
    models = build_models(clean_df, written)

    def mart(name: str) -> Callable[[], str]:
        return lambda: steps.call(name, lambda: publish.stage(models[name], root, prefix, name), [root, prefix],
                                  (*staged, *dims.ALL))

    slices = upsert.slices_of(spark, steps.path("stg_clean")) if staged else 1

    def fact(name: str, key: str) -> str:
        return steps.call(name, lambda: upsert.upsert(models[name], f"{work_root}/{name}", key, facts.CLUSTER,
                                                      slices=slices), after=staged)

    def all_facts() -> dict[str, str]:
        return {name: fact(name, key) for name, key in facts.KEYS.items()}  # one by one: each shuffles whole rows

    writes = {name: mart(name) for name in MART_NAMES}
    done = _in_parallel(writes | ({"facts": all_facts} if facts_too else {}))
    paths = {name: steps.path(name) for name in dims.ALL} | done.pop("facts", {}) | done
    models.update({name: spark.read.parquet(paths[name]) for name in MART_NAMES})
    if facts_too:
        models.update({name: upsert.read_current(spark, paths[name]) for name in facts.KEYS})
    return models, paths


@frees_shuffles
def run_incremental(spark: SparkSession, params: JobParams, work_root: str) -> tuple[dict[str, str], int]:
    """Stage the CSV files that no run has processed yet, and upsert the facts with them.

    Returns the fact tables' roots and the number of files that were read. Files count as processed once
    both upserts are committed; a run that dies before that is repeated by the next one.
    """
    work_root = work_root.rstrip("/")
    seen = f"{work_root}/ledger"
    roots = {name: f"{work_root}/{name}" for name in facts.KEYS}
    todo = ledger.pending(spark, seen, params.resolved_csv_uri())
    try:
        if todo.files:
            read = read_raw_csv_split if params.multi_line else partial(read_raw_csv, multi_line=False)
            staged = f"{work_root}/new-{uuid.uuid4().hex[:12]}"
            try:
                staging.clean(read(spark, todo.files), strip=params.strip).write.parquet(staged)
                clean_df = spark.read.parquet(staged)
                rows = {"fact_base": facts.fact_base(clean_df), "fact_strat": facts.fact_strat(facts.strata_long(clean_df))}
                slices = upsert.slices_of(spark, staged)
                for name, key in facts.KEYS.items():  # one by one: each shuffles whole rows
                    upsert.upsert(rows[name], roots[name], key, facts.CLUSTER, upsert.CLUSTERS, upsert.PER_CLUSTER, slices)
            finally:
                fs.delete(spark, staged)
    except BaseException:
        ledger.discard(spark, seen, todo)
        raise
    ledger.commit(spark, seen, todo)
    return roots, len(todo.files)


@frees_shuffles
def run(spark: SparkSession, params: JobParams, work_root: str,
        raw: DataFrame | None = None, fail_on_dq: bool = True) -> JobResult:
    """Run the whole job. ``raw`` overrides the CSV input (N02 resolution)."""
    work_root = work_root.rstrip("/")
    read = read_raw_csv_split if params.multi_line else partial(read_raw_csv, multi_line=False)
    source = raw if raw is not None else (                            # N01/N02, opened if needed
        lambda: read(spark, params.resolved_csv_uri()))
    landed_df, landed_now = land_raw(source, f"{work_root}/raw", force=params.force_landing,
                                     spark=spark)                     # N03/N04

    steps = Steps(spark, work_root)
    landing = versions.current_path(spark, f"{work_root}/raw")
    clean_df = steps.write("stg_clean", lambda: staging.clean(landed_df, strip=params.strip), [landing, params.strip])

    root = params.resolved_output_root() or f"{work_root}/published"
    prefix = params.resolved_output_prefix()
    models, paths = materialize(spark, clean_df, work_root, target=(root, prefix), steps=steps)
    staged = {n: paths[n] for n in MART_NAMES}
    made = (*dims.ALL, *facts.KEYS, *MART_NAMES)
    report = steps.write("dq_report", lambda: quality.run_checks(models, DECLARED_CHECKS), after=made)  # D01-D05
    if fail_on_dq and not report.where(~F.col("passed")).isEmpty():
        publish.discard(spark, staged.values())                       # the marts before stay
        steps.close()
        quality.assert_passed(report)
    published = steps.call("publish", lambda: publish.commit(spark, root, prefix, staged),  # N06/N09/N10
                           after=("dq_report",))
    steps.close()
    inv = publish.inventory(spark, root, prefix)                      # N11
    return JobResult(landed=f"{work_root}/raw", staged=steps.path("stg_clean"),
                     dims={n: paths[n] for n in dims.ALL},
                     facts={n: paths[n] for n in facts.KEYS},
                     published=published, report=report, inventory=inv,
                     landed_now=landed_now, steps=list(steps.done))
