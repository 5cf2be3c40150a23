"""indistar: indicator analytics on Spark.

A batch ELT library for wide, messy indicator extracts: land the raw extract,
normalise text into typed columns, unpivot stratification slots, derive a star
schema (dimensions + facts keyed by hashed surrogate keys), maintain facts by
keyed upsert, build marts, check them with declarative data-quality tests and
publish them as Parquet for ad-hoc SQL.

Everything is a plain function over DataFrames or Columns, so Catalyst sees one
declarative plan per action and does the pruning, pushdown and join choice.

Sub-packages:
    sources    - raw contract, CSV scan, landing, star-table adapter, publish
    functions  - Column -> Column scalar rules (numbers, blanks, points, keys)
    operators  - unpivot of strata, keyed upsert, data-quality checks
    plans      - the models: staging, dimensions, facts, marts, the whole job
    streaming  - incremental fact maintenance driven by newly landed files
"""

from indistar.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
