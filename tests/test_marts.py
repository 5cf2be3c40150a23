"""Aggregate marts: stddev of one row, NULL ordering, NULL indicator groups."""

from indistar.plans import marts

COLS = "year int, topic string, question string, strat_cat1 string, strat1 string, value double"


def test_trend_single_row_stddev_and_overall(spark):
    df = spark.createDataFrame([(2019, "T", "Q", "", None, 1.0),
                                (2019, "T", "Q", "Sex", "F", 2.0),
                                (2019, "T", "Q", "Sex", "F", 4.0)], COLS)
    rows = {(r.category, r.subcategory): r for r in marts.trend(df).collect()}
    assert rows[("Overall", "Overall")].stddev_value is None
    assert rows[("Overall", "Overall")].n_obs == 1
    assert abs(rows[("Sex", "F")].stddev_value - 2 ** 0.5) < 1e-12


def test_year_overall_sorts_nulls_last(spark):
    df = spark.createDataFrame([(2019, None, "Q", "", "", 1.0), (2019, "T", "Q", "", "", 2.0),
                                (2018, "T", "Q", "", "", 3.0)], COLS)
    got = [(r.indicator_name, r.year) for r in marts.year_overall(df).collect()]
    assert got == [("T - Q", 2018), ("T - Q", 2019), (None, 2019)]
