"""N03 idempotent landing of the raw extract as Parquet.

* skip when a committed landing exists, unless ``force``; the input is then not even opened;
* rows are written once, to a new version folder, and only a committed folder becomes
  current: an interrupted landing leaves the previous one readable;
* an empty input is rejected (N04): emptiness is read off the written files, so the input
  is computed once, by the write itself.

The landed Parquet is the one source every later model reads, so the CSV is
parsed once per run, not once per model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from indistar.sources import fs, versions
from indistar.sources.contract import ContractError, check_contract

KEPT_LANDINGS = 2


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The current landing under ``path``."""
    at = versions.current_path(spark, path)
    if at is None:
        raise FileNotFoundError(f"no committed landing under {path}")
    return spark.read.parquet(at)


def land_raw(raw: DataFrame | Callable[[], DataFrame], path: str, force: bool = False,
             spark: SparkSession | None = None) -> tuple[DataFrame, bool]:
    """Land ``raw`` (rows, or a function that opens them) at ``path``.

    Returns (landed rows, whether they were written now).
    """
    spark = spark or (raw.sparkSession if isinstance(raw, DataFrame) else SparkSession.getActiveSession())
    path = path.rstrip("/")
    if not force and versions.current_path(spark, path):
        return read_landed(spark, path), False
    rows = check_contract(raw if isinstance(raw, DataFrame) else raw(), require_rows=False)
    target = versions.next_path(spark, path)
    rows.write.parquet(target)
    if spark.read.schema(rows.schema).parquet(target).isEmpty():
        fs.delete(spark, target)
        if not fs.list_dirs(spark, path):
            fs.delete(spark, path)
        raise ContractError("raw input has no rows")
    versions.vacuum(spark, path, KEPT_LANDINGS)
    return read_landed(spark, path), True
