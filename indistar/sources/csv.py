"""N01 CSV scan of the raw extract.

Header names are read from the file and matched by name to the contract
(:func:`~indistar.sources.contract.check_contract`), with no type inference:
every column stays a string, and no scan is spent inferring. ``escape='"'``
reads doubled quotes inside quoted fields and ``multiLine`` keeps newlines
inside quoted fields in the value, as the reference's CSV reader does.

All files of a folder must have the same header, in the same order, and every row as many
fields; anything else raises, so no value lands in a wrong column.

This reader takes a multi-line CSV file in one task; ``multi_line=False`` splits
files where no field holds a newline, and :mod:`indistar.sources.csv_split` splits all others.
Everything downstream of the landing reads Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from indistar.sources.contract import check_contract


def csv_reader(spark: SparkSession, multi_line: bool = True):
    return (spark.read
            .option("header", True)
            .option("escape", '"')
            .option("quote", '"')
            .option("multiLine", multi_line)
            .option("inferSchema", False))


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True,
                 require_rows: bool = False) -> DataFrame:
    """Raw rows under the contract: the 34 columns, all strings."""
    reader = csv_reader(spark, multi_line)
    names = reader.csv(path).columns  # the header of one file
    rows = (reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
            .option("enforceSchema", False)  # every other file's header must equal it
            .option("mode", "FAILFAST")      # too long and too short rows raise
            .csv(path))
    return check_contract(rows, require_rows=require_rows)


#: Records of a compressed file, which one task reads as a whole: some 170 MB of text.
COMPRESSED_RECORDS = 500_000


def write_raw_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write raw rows as a headed CSV folder that :func:`read_raw_csv` reads.

    With a ``compression`` (``gzip``) the texts take about a sixth of the disk; files are then cut by records.
    """
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", COMPRESSED_RECORDS)
    (writer
     .option("header", True).option("escape", '"').option("quote", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
