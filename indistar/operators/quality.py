"""Declarative data-quality checks D01-D05.

Each check returns its *failing rows* as a DataFrame (a check passes when
there are none), like a generated test query:

D01 ``not_null``                      rows where the column is NULL
D02 ``unique``                        values (NULL ignored) that occur more than once
D03 ``relationships``                 child rows whose non-NULL key has no parent (J04)
D04 ``unique_combination_of_columns`` column combinations (NULLs group) seen more than once
D05 :func:`run_checks`                one report row per check; :func:`assert_passed` raises

All are aggregations or anti joins with partial aggregation before any
shuffle; the report runs the whole suite as one aggregation over every model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DataQualityError(AssertionError):
    """At least one declared check failed."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    """D01."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """(unique_field, n_records) for each duplicated non-NULL value."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key is set but absent from the parent."""
    # no distinct: an anti join ignores repeats, and plain exchanges let AQE split a hot key
    parent_keys = parent.select(F.col(field).alias("__parent_key"))
    return (child.where(F.col(column).isNotNull())
            .join(parent_keys, F.col(column) == F.col("__parent_key"), "left_anti"))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations (NULL forms its own group) with more than one row."""
    return (df.groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | relationships | unique_combination_of_columns
    model: str
    columns: tuple[str, ...]
    parent: str | None = None      # relationships: parent model
    field: str | None = None       # relationships: parent column

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


REPORT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("failures", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])


# What a row says of a check: a null, a key (unique), a child's or a parent's key (relationships).
_NULL, _KEY, _CHILD, _PARENT = 0, 1, 2, 3


def _key_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """Text that is equal for equal values and no others; NULLs are equal."""
    def one(c: str) -> Column:
        v = F.col(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            v = v + F.lit(0.0)  # -0.0 is 0.0
        v = v.cast("string")
        return F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.concat(*map(one, columns))


def _mark(df: DataFrame, number: int, check: Check, parent: bool) -> Column:
    """What each row of ``df`` says of the check: (check, what, key), null if nothing."""
    columns = [check.field] if parent else list(check.columns)
    set_ = F.lit(True)
    if check.kind == "not_null":
        what, key, set_ = _NULL, F.lit(""), F.col(columns[0]).isNull()
    elif check.kind == "unique_combination_of_columns":
        what, key = _KEY, _key_text(df, columns)
    else:
        what = _KEY if check.kind == "unique" else _PARENT if parent else _CHILD
        key, set_ = _key_text(df, columns), F.col(columns[0]).isNotNull()
    return F.when(set_, F.struct(F.lit(number).alias("number"), F.lit(what).alias("what"), key.alias("key")))


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: (check, model, column_name, failures, passed).

    The whole suite is one pass: every model is read once, each row gives the nulls and keys that
    its checks ask for, and all of them meet in one aggregation by check and key, where a
    relationship's children find their parents too. Keys are counted before the shuffle, so a hot
    key or a column full of nulls costs a row per task. The result has one row per
    check, however large the models are.
    """
    for c in checks:
        if c.kind not in ("not_null", "unique", "relationships", "unique_combination_of_columns"):
            raise ValueError(f"unknown check kind {c.kind!r}")
        if c.kind == "relationships":
            types = models[c.model].schema[c.columns[0]].dataType, models[c.parent].schema[c.field].dataType
            if types[0] != types[1]:
                raise ValueError(f"{c.model}.{c.columns[0]} and {c.parent}.{c.field} differ in type")
    if not checks:
        return SparkSession.getActiveSession().createDataFrame([], REPORT_SCHEMA)
    asked: dict[str, list[Column]] = {}
    for i, c in enumerate(checks):
        asked.setdefault(c.model, []).append(_mark(models[c.model], i, c, parent=False))
        if c.kind == "relationships":
            asked.setdefault(c.parent, []).append(_mark(models[c.parent], i, c, parent=True))
    said = [models[m].select(F.inline(F.array_compact(F.array(*marks)))) for m, marks in asked.items()]
    every = said[0]
    for x in said[1:]:
        every = every.unionByName(x)
    is_ = lambda w: F.col("what") == w
    met = every.groupBy("number", "key").agg(
        F.count(F.when(is_(_NULL), 1)).alias("nulls"), F.count(F.when(is_(_KEY), 1)).alias("keys"),
        F.count(F.when(is_(_CHILD), 1)).alias("children"), F.count(F.when(is_(_PARENT), 1)).alias("parents"))
    failing = (F.col("nulls") + (F.col("keys") > 1).cast("long")
               + F.when(F.col("parents") == 0, F.col("children")).otherwise(0))
    counts = met.groupBy("number").agg(F.sum(failing).alias("failures"))
    spark = every.sparkSession
    declared = spark.createDataFrame([(i, c.kind, c.model, c.column_name) for i, c in enumerate(checks)],
                                     "number int, check string, model string, column_name string")
    failures = F.coalesce("failures", F.lit(0)).cast("bigint")
    return declared.join(counts, "number", "left").select(
        "check", "model", "column_name", failures.alias("failures"), (failures == 0).alias("passed"))


def assert_passed(report: DataFrame) -> None:
    """Raise :class:`DataQualityError` listing the failed checks.

    The report has one row per declared check, so collecting the failed ones
    moves a bounded, tiny result to the driver.
    """
    failed = report.where(~F.col("passed")).collect()
    if failed:
        lines = [f"{r['check']}({r['model']}.{r['column_name']}): {r['failures']} failing"
                 for r in failed]
        raise DataQualityError("data-quality checks failed:\n  " + "\n  ".join(lines))
