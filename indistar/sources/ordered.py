"""A mart written in its order, and its rows' positions when it is read.

A folder of Parquet files has no order of its own. Here rows are range-partitioned by the order and
sorted within each partition, so the files, in the order of their part numbers, hold the whole
order; a record beside the data says how many rows precede each file. On reading, a row's position is
that number plus its place in its file, which Parquet's reader supplies: no sort and no shuffle, and a
reader that wants the first rows opens the first files only.

Nulls stand last. Rows equal in all ordering columns follow one another in any order, and spread
over partitions where there are very many. An empty table has no positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DATA, FILES = "rows", "files"


def write_ordered(df: DataFrame, path: str, order: Sequence[str], partitions: int | None = None) -> str:
    """Write ``df`` sorted by ``order``, and the record of its files; returns ``path``."""
    spark, path = df.sparkSession, path.rstrip("/")
    tie = "_tie"
    keys = [*(F.asc_nulls_last(c) for c in order), F.col(tie)]
    tied = df.withColumn(tie, F.monotonically_increasing_id())
    spread = tied.repartitionByRange(partitions, *keys) if partitions else tied.repartitionByRange(*keys)
    spread.sortWithinPartitions(*keys).drop(tie).write.parquet(f"{path}/{DATA}")
    name = F.col("_metadata.file_name")
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    piece = F.regexp_extract("file", r"-c(\d+)", 1).cast("long")
    counts = spark.read.parquet(f"{path}/{DATA}").groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("n"))
    along = Window.orderBy(part, piece)  # one row per file
    counts.select("file", "n", (F.sum("n").over(along) - F.col("n")).alias("before")).write.parquet(f"{path}/{FILES}")
    return path


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows with their position, counted from 1."""
    path = path.rstrip("/")
    rows = spark.read.parquet(f"{path}/{DATA}")
    names = rows.columns
    if position in names:
        raise ValueError(f"the table has a column {position}")
    placed = rows.select(F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"), *names)
    files = spark.read.parquet(f"{path}/{FILES}").select(F.col("file").alias("_file"), F.col("before").alias("_before"))
    return placed.join(files, "_file").select((F.col("_before") + F.col("_at") + 1).alias(position), *names)
