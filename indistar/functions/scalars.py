"""Column -> Column rules used by the staging, fact and mart models.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
no Python runs per row.

P06/P07/P13/P15/P16  number normaliser      :func:`normalize_number`
P08                  build-time type branch :func:`number_column`
P11/P12              blanks                 :func:`blank_to_null`, :func:`default_label`
P14/P17              point coordinates      :func:`point_lon`, :func:`point_lat`
P18                  indicator label        :func:`indicator`
P19                  surrogate key          :func:`surrogate_key`
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's text rules.
#   STRIP_FIRST / STRIP_ALL: the characters removed before parsing a number are
#   '%' and ','; the reference removes only the first occurrence (its regex
#   replace has no global flag), "all" is the evident intent.
#   POINT_PATTERN: coordinates are read from text shaped 'POINT (<lon> <lat>)'.
#   KEY_SEPARATOR / KEY_NULL: surrogate keys join the parts with '-' and treat
#   NULL as the empty string before md5.
#   OVERALL: the label for a blank stratification.
STRIP_FIRST = r"^([^%,]*)[%,]"
STRIP_ALL = r"[%,]"
POINT_PATTERN = r"POINT \(([^ ]+) ([^\)]+)\)"
KEY_SEPARATOR = "-"
KEY_NULL = ""
OVERALL = "Overall"

# The text accepted as a number. Decimal or scientific
# notation with optional sign and surrounding blanks, or the special words
# nan / inf / infinity in any case. Java float suffixes ('1d', '2.5f') and
# hex ('0x1A') are rejected, as the reference's engine rejects them.
NUMBER_PATTERN = (r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
                  r"|(?i:nan|inf|infinity))\s*$")


def parse_double(text: Column) -> Column:
    """Tolerant text -> double, NULL when the text is not a number.

    The shape test runs first so the cast only ever sees valid numbers: a
    failing cast costs a thrown exception per row, which the regex avoids.
    """
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def strip_symbols(text: Column, strip: str = "first") -> Column:
    """Remove '%' / ',' - the first occurrence only, or all of them.

    Most texts hold neither: a search for the two characters spares them the pattern.
    """
    if strip == "first":
        stripped = F.regexp_replace(text, STRIP_FIRST, "$1")
    elif strip == "all":
        stripped = F.regexp_replace(text, STRIP_ALL, "")
    else:
        raise ValueError(f"strip must be 'first' or 'all', not {strip!r}")
    return F.when(text.contains("%") | text.contains(","), stripped).otherwise(text)


def _parse_number(c: Column, strip: str) -> Column:
    return parse_double(strip_symbols(c.cast("string"), strip))


def normalize_number(primary: Column, *fallbacks: Column, strip: str = "first") -> Column:
    """The first column whose text parses as a number, as double.

    Each candidate is cast to text (P07), stripped of '%' / ',' (P13) and
    parsed tolerantly (P06); ``coalesce`` (P10) takes the first success, so a
    fallback column is only used where the primary text does not parse.
    """
    return F.coalesce(*[_parse_number(c, strip) for c in (primary, *fallbacks)])


def number_column(df: DataFrame, name: str, strip: str = "first") -> Column:
    """Branch on the column's type once, at plan-build time.

    Numeric input (an upstream typed source) is cast directly; text goes
    through the normaliser. No per-row type test is needed.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType, T.IntegerType,
                          T.LongType, T.ShortType, T.ByteType)):
        return F.col(name).cast("double")
    return _parse_number(F.col(name), strip)


def normalize_number_columns(df: DataFrame, primary: str, *fallbacks: str,
                             strip: str = "first") -> Column:
    """:func:`normalize_number` over named columns with the P08 type branch."""
    return F.coalesce(*[number_column(df, c, strip) for c in (primary, *fallbacks)])


def blank_to_null(c: Column | str) -> Column:
    """The empty string becomes NULL; everything else is kept."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def default_label(c: Column | str, label: str = OVERALL) -> Column:
    """Blank or NULL becomes ``label``."""
    return F.coalesce(blank_to_null(c), F.lit(label))


def _point_part(c: Column, idx: int) -> Column:
    return parse_double(F.regexp_extract(c, POINT_PATTERN, idx))


def point_lon(c: Column | str) -> Column:
    """Longitude from 'POINT (lon lat)'; NULL when absent or malformed."""
    return _point_part(F.col(c) if isinstance(c, str) else c, 1)


def point_lat(c: Column | str) -> Column:
    """Latitude from 'POINT (lon lat)'; NULL when absent or malformed."""
    return _point_part(F.col(c) if isinstance(c, str) else c, 2)


def indicator(topic: Column | str, question: Column | str) -> Column:
    """P18: 'topic - question', NULL when either part is NULL (no skipping)."""
    topic = F.col(topic) if isinstance(topic, str) else topic
    question = F.col(question) if isinstance(question, str) else question
    return F.concat(topic, F.lit(" - "), question)


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the parts as text joined by '-', NULL treated as ''.

    Do not key on doubles: their text form differs between engines.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(KEY_NULL))
             for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def stable_round(c: Column | str, digits: int = 2) -> Column:
    """Round half-up with a 1e-6 bias, for comparing aggregates across engines.

    Averages of cent amounts often land exactly on a rounding tie, and the
    last-bit noise of floating sums then decides the side differently per
    engine and per summation order. Moving the tie by 1e-6 of a unit keeps
    the result identical everywhere. Used only by the self-checking query
    wrappers; the models themselves return unrounded values.
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(float(10 ** digits))
    rounded = (F.floor(c * scale + F.lit(0.5 + 1e-6)) / scale).cast("double")
    # floor gives a bigint: values beyond its range, infinities and NaN stay as they are
    return F.when(F.isnan(c) | (F.abs(c) >= 1e15), c).otherwise(rounded)
