"""Raw input contract, input-path resolution and the input gate.

N02  input path: explicit run value -> environment variable -> default.
N04  gate: fail fast when the input is absent, misses contract columns or
     has no row.

The raw contract is all strings: the staging rules cast explicitly, so the
types never depend on what an inference pass happened to see, and no extra
scan is spent on inference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.session import env_or

# The 34 column names of the raw indicator extract, in the
# order the extract lists them. They must equal the source file's header.
RAW_COLUMNS = (
    "YearStart", "YearEnd", "LocationAbbr", "LocationDesc", "DataSource",
    "Topic", "Question", "Response", "DataValueUnit", "DataValueType",
    "DataValue", "DataValueAlt", "DataValueFootnoteSymbol",
    "DataValueFootnote", "LowConfidenceLimit", "HighConfidenceLimit",
    "StratificationCategory1", "Stratification1",
    "StratificationCategory2", "Stratification2",
    "StratificationCategory3", "Stratification3",
    "Geolocation", "ResponseID", "LocationID", "TopicID", "QuestionID",
    "DataValueTypeID", "StratificationCategoryID1", "StratificationID1",
    "StratificationCategoryID2", "StratificationID2",
    "StratificationCategoryID3", "StratificationID3",
)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Default input location, and the environment variable that overrides it.
DEFAULT_CSV_URI = "raw/indicators.csv"
CSV_URI_ENV = "CSV_S3_URI"
# The environment's names for the output bucket and prefix, and the default prefix.
BUCKET_ENV = "S3_BUCKET"
PREFIX_ENV = "S3_PARQUET_PREFIX"
DEFAULT_PREFIX = "assignment/parquet"


class ContractError(ValueError):
    """The input does not satisfy the raw contract."""


@dataclass(frozen=True)
class JobParams:
    """Run parameters with the documented precedence.

    ``csv_uri`` given here wins; otherwise the ``CSV_S3_URI`` environment
    variable; otherwise :data:`DEFAULT_CSV_URI`. The output is resolved in the same way (N10): the
    root given here, else the bucket that the environment names, else a folder of the job's own; the prefix
    given here (empty: the root itself), else the environment's, else :data:`DEFAULT_PREFIX`.
    """

    csv_uri: str | None = None
    output_root: str | None = None
    output_prefix: str | None = None
    force_landing: bool = False
    strip: str = "first"
    multi_line: bool = True            # False: no newlines inside quoted fields
    allowed_schemes: tuple[str, ...] | None = None  # N04: e.g. ("s3a", "s3"); None allows any

    def resolved_output_root(self) -> str | None:
        if self.output_root:
            return self.output_root
        bucket = env_or(BUCKET_ENV, "")
        return f"s3a://{bucket}" if bucket else None

    def resolved_output_prefix(self) -> str:
        return env_or(PREFIX_ENV, DEFAULT_PREFIX) if self.output_prefix is None else self.output_prefix

    def resolved_csv_uri(self) -> str:
        uri = resolve_input_path(self.csv_uri)
        scheme = uri.split("://", 1)[0] if "://" in uri else "file"
        if self.allowed_schemes is not None and scheme not in self.allowed_schemes:
            raise ContractError(f"input {uri!r} is not under an allowed scheme: {self.allowed_schemes}")
        return uri


def resolve_input_path(explicit: str | None = None) -> str:
    """Run value, then environment, then the built-in default."""
    if explicit:
        return explicit
    return env_or(CSV_URI_ENV, DEFAULT_CSV_URI)


def check_contract(df: DataFrame, require_rows: bool = True) -> DataFrame:
    """Verify the raw contract and return the 34 columns as strings.

    Columns are matched by name (the header), so a reordered or widened
    extract still lands correctly; a missing column raises
    :class:`ContractError`. ``require_rows`` probes for one row, which computes a
    joined or shuffled input as far as its first row; landing checks the written files instead.
    """
    present = set(df.columns)
    missing = [c for c in RAW_COLUMNS if c not in present]
    if missing:
        raise ContractError(f"raw input misses contract columns: {missing}")
    out = df.select([F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    if require_rows and out.isEmpty():
        raise ContractError("raw input has no rows")
    return out
