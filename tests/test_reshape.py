"""Strata unpivot and the slot dimensions."""

from indistar.plans import dims, facts

COLS = ("year int, year_end int, location_id string, state string, state_name string, lon double, "
        "lat double, topic_id string, topic string, question_id string, question string, "
        "response_id string, response string, value_type_id string, value_type string, unit string, "
        "data_source string, value double, low_ci double, high_ci double, "
        "strat_cat_id1 string, strat_cat1 string, strat_id1 string, strat1 string, "
        "strat_cat_id2 string, strat_cat2 string, strat_id2 string, strat2 string, "
        "strat_cat_id3 string, strat_cat3 string, strat_id3 string, strat3 string")


def _row(slots):
    base = [2019, 2019, "1", "AL", "Alabama", 1.0, 2.0, "T", "Topic", "Q", "Question", None, None,
            "V", "Type", "%", "src", 1.0, 0.5, 1.5]
    for cat_id, val_id in slots:
        base += [cat_id, f"cat-{cat_id}" if cat_id else None, val_id, f"val-{val_id}" if val_id else None]
    return tuple(base)


def test_strata_long_slot_rules(spark):
    df = spark.createDataFrame([
        _row([("A", "1"), (None, "2"), ("C", None)]),
        _row([(None, None), (None, None), (None, None)]),
        _row([("A", "1"), ("B", "2"), ("C", "3")]),
    ], COLS)
    long = facts.strata_long(df)
    assert long.count() == 1 + 0 + 3
    pairs = sorted((r.strat_cat_id, r.strat_id) for r in long.collect())
    assert pairs == [("A", "1"), ("A", "1"), ("B", "2"), ("C", "3")]


def test_strat_value_filters_on_value_id_only(spark):
    df = spark.createDataFrame([_row([("A", "1"), (None, "2"), ("C", None)])], COLS)
    got = sorted((r.strat_cat_id or "", r.strat_id) for r in dims.strat_value(df).collect())
    assert got == [("", "2"), ("A", "1")]
    cats = sorted(r.strat_cat_id for r in dims.strat_category(df).collect())
    assert cats == ["A", "C"]


def test_fact_keys_keep_duplicates(spark):
    df = spark.createDataFrame([_row([("A", "1"), ("B", "2"), (None, None)])] * 2, COLS)
    fb = facts.fact_base(df)
    assert fb.count() == 2 and fb.select("fact_sk").distinct().count() == 1
    fs = facts.fact_strat(facts.strata_long(df))
    assert fs.count() == 4 and fs.select("fact_strat_sk").distinct().count() == 2
