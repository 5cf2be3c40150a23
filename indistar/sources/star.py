"""Adapter: provided star-schema tables -> the raw indicator contract.

The raw extract is a downloaded CSV that is not available offline, so the
driver-provided tables stand in for it: one observation is one ``lineitem``
row, inner-joined to its order, customer, nation and part. Every output column
is a string, exactly as a CSV scan under the raw contract would give, and the
value columns deliberately carry the text shapes the staging rules exist for
(thousands separators, percent signs, suppressed values, fallbacks, blank
confidence limits, missing coordinates, half-filled strata slots).

Plan shape: ``orders`` is joined to ``customer`` and ``nation`` first (the
narrow side), then ``lineitem`` joins that on the order key (a shuffle join,
see :func:`observations`) and ``part`` on the part key. All scans read only the
listed columns (Parquet column pruning). For the dimension-like joins the
planner broadcasts a side when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` (``nation`` always is) and otherwise
sort-merge joins, with AQE splitting skewed keys; no broadcast is forced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.session import fill_runtime_defaults
from indistar.sources.contract import RAW_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined observation grain, typed (before the text rendering)."""
    # read as it is: filters and column selection of whatever model follows reach the scan
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                    "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                        "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")

    order_side = (orders
                  .join(cust, orders.o_custkey == cust.c_custkey)
                  .join(nation, F.col("c_nationkey") == nation.n_nationkey)
                  .select("o_orderkey", "o_orderstatus", "o_orderpriority", "c_mktsegment",
                          "n_nationkey", "n_name"))
    # Both sides of the order-key join grow with the data, so it is a
    # shuffle join: the MERGE hint stops the planner from picking the fact
    # side as a broadcast build side off a per-scan size estimate (the
    # joined order side's estimate is a product of sizes, so it always looks
    # bigger). AQE still splits skewed order keys.
    return (li.hint("merge")
            .join(order_side, li.l_orderkey == order_side.o_orderkey)
            .join(part, li.l_partkey == part.p_partkey))


# Text rendering of amounts in cents, as SQL expressions over ``{c}``:
# plain '1234.56' and with one thousands separator '1,234.56' (amounts are
# below 10^8 cents). Integer arithmetic and lpad keep them in generated code.
_PLAIN = "concat(cast({c} div 100 as string), '.', lpad(cast({c} % 100 as string), 2, '0'))"
_COMMA = ("concat(cast({c} div 100000 as string), ',', lpad(cast(({c} div 100) % 1000 as string), 3, '0'), "
          "'.', lpad(cast({c} % 100 as string), 2, '0'))")


def _raw_expressions() -> dict[str, str]:
    cents = "cents"
    plain, comma = _PLAIN.format(c=cents), _COMMA.format(c=cents)
    line, key = "l_linenumber", "n_nationkey"
    even, third = f"{line} % 2 = 0", f"{line} % 3 = 0"
    topic_id = "replace(p_brand, 'Brand#', 'T')"
    return {
        "YearStart": "cast(ship_year as string)",
        "YearEnd": f"cast(ship_year + {line} % 2 as string)",
        "LocationAbbr": f"concat('N', lpad(cast({key} as string), 2, '0'))",
        "LocationDesc": "n_name",
        "DataSource": "c_mktsegment",
        "Topic": "p_brand",
        "Question": "concat(p_brand, ': ', p_type)",
        "Response": f"case when {line} = 6 then 'Yes' else '' end",
        "DataValueUnit": "case when l_linestatus = 'O' then '%' else '' end",
        "DataValueType": "concat('Type ', l_returnflag)",
        "DataValue": (f"case when {line} in (1, 4, 6) then {plain} "
                      f"when {line} in (2, 3) then concat({comma}, case when {line} = 3 then '%' else '' end) "
                      f"when {line} = 5 then '~' else '' end"),
        "DataValueAlt": (f"case {line} when 3 then concat(cast({cents} div 100 as string), '.00') "
                         f"when 5 then {comma} else '' end"),
        "DataValueFootnoteSymbol": f"case when {line} = 5 then '~' else '' end",
        "DataValueFootnote": f"case when {line} = 5 then 'Suppressed' else '' end",
        "LowConfidenceLimit": f"case when {line} = 4 then '' else {_PLAIN.format(c=f'({cents} - 100)')} end",
        "HighConfidenceLimit": f"case when {line} = 4 then '' else {_PLAIN.format(c=f'({cents} + 100)')} end",
        "StratificationCategory1": "'Priority'",
        "Stratification1": "o_orderpriority",
        "StratificationCategory2": f"case when {even} or {line} = 5 then 'Segment' else '' end",
        "Stratification2": f"case when {even} or {line} = 5 then c_mktsegment else '' end",
        "StratificationCategory3": f"case when {third} then 'Status' else '' end",
        "Stratification3": f"case when {third} or {line} = 1 then o_orderstatus else '' end",
        "Geolocation": (f"case when {key} % 6 = 0 then '' else concat('POINT (-', "
                        f"cast({key} + 70 as string), '.5 ', cast({key} + 20 as string), '.25)') end"),
        "ResponseID": f"case when {line} = 6 then 'R1' else '' end",
        "LocationID": f"cast({key} as string)",
        "TopicID": topic_id,
        "QuestionID": f"concat({topic_id}, '-', p_type)",
        "DataValueTypeID": "l_returnflag",
        "StratificationCategoryID1": "'PRI'",
        "StratificationID1": "substr(o_orderpriority, 1, 1)",
        "StratificationCategoryID2": f"case when {even} or {line} = 5 then 'SEG' else '' end",
        "StratificationID2": f"case when {even} then substr(c_mktsegment, 1, 3) else '' end",
        "StratificationCategoryID3": f"case when {third} then 'STA' else '' end",
        "StratificationID3": f"case when {third} or {line} = 1 then o_orderstatus else '' end",
    }


def raw_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M01 stand-in: the 34 raw contract columns, all strings.

    One projection given as SQL expression text: it is parsed and analysed
    once in the JVM instead of being assembled call by call from Python.
    """
    fill_runtime_defaults(spark)  # 34 text columns make a method that the JVM would never compile
    exprs = _raw_expressions()
    # rounding and the calendar are dear and used by many columns: once per row, in a projection below
    typed = observations(spark, sf_dir).selectExpr(
        "*", "cast(round(l_extendedprice * 100) as bigint) AS cents", "year(l_shipdate) AS ship_year")
    return typed.selectExpr(*[f"{exprs[c]} AS {c}" for c in RAW_COLUMNS])
