"""Work per row: what many columns share is computed once."""

from pyspark.sql import functions as F

from indistar.functions import scalars
from indistar.plans import catalog
from indistar.session import fill_runtime_defaults
from indistar.sources.star import raw_from_star

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_raw_rows_round_and_date_once(spark):
    plan = optimized(raw_from_star(spark, SF))
    assert plan.count("round(") == 1
    assert plan.count("year(") == 1


def test_running_session_gets_the_method_limit_unless_it_has_one(spark):
    key, before = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit", None)
    try:
        spark.conf.unset(key)
        raw_from_star(spark, SF)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "9000")
        fill_runtime_defaults(spark)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_plain_numbers_skip_the_strip_pattern(spark):
    texts = ["", "1", "1,234,5", "5%", "%5", "a", None, "1\n,2", ",", "%,", "-1.5e3", "1,2%"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for strip, pattern, to in (("first", scalars.STRIP_FIRST, "$1"), ("all", scalars.STRIP_ALL, "")):
        got = df.select(scalars.strip_symbols(F.col("t"), strip).alias("x"), F.regexp_replace("t", pattern, to).alias("y"))
        assert all(r["x"] == r["y"] for r in got.collect())
        assert "contains(" in optimized(got).lower()


def test_batches_stage_their_own_rows_only(spark):
    old, new = catalog._fact_batches(spark, SF, strata=False)
    for df, allowed in ((old, range(1900, 2001)), (new, range(2000, 2100))):
        staged = spark.read.parquet(*df.inputFiles()).select("year").distinct().collect()
        assert staged and all(r["year"] in allowed for r in staged)
