"""Data-quality checks on clean and deliberately broken inputs."""

import pytest

from indistar.operators import quality
from indistar.operators.quality import Check


def test_checks_on_clean_and_broken(spark):
    topics = spark.createDataFrame([("T1", "a"), ("T2", "b")], "topic_id string, topic string")
    questions = spark.createDataFrame([("Q1", "T1"), ("Q2", "T3"), ("Q3", None), ("Q3", "T2")],
                                      "question_id string, topic_id string")
    assert quality.not_null(topics, "topic_id").count() == 0
    assert quality.not_null(questions, "topic_id").count() == 1
    assert [r.unique_field for r in quality.unique(questions, "question_id").collect()] == ["Q3"]
    assert quality.unique(topics, "topic_id").count() == 0
    orphans = quality.relationships(questions, "topic_id", topics, "topic_id").collect()
    assert [r.question_id for r in orphans] == ["Q2"]
    nulls = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "a string, b int")
    combos = quality.unique_combination(nulls, ["a", "b"]).collect()
    assert [(r.a, r.n_records) for r in combos] == [(None, 2)]


def test_report_and_assert(spark):
    models = {
        "dim_topic": spark.createDataFrame([("T1", "a"), ("T1", "b"), (None, "c")],
                                           "topic_id string, topic string"),
        "dim_question": spark.createDataFrame([("Q1", "T9")], "question_id string, topic_id string"),
    }
    checks = [Check("not_null", "dim_topic", ("topic_id",)),
              Check("not_null", "dim_topic", ("topic",)),
              Check("unique", "dim_topic", ("topic_id",)),
              Check("relationships", "dim_question", ("topic_id",), "dim_topic", "topic_id"),
              Check("unique_combination_of_columns", "dim_topic", ("topic_id", "topic"))]
    report = {(r.check, r.column_name): (r.failures, r.passed)
              for r in quality.run_checks(models, checks).collect()}
    assert report == {("not_null", "topic_id"): (1, False), ("not_null", "topic"): (0, True),
                      ("unique", "topic_id"): (1, False), ("relationships", "topic_id"): (1, False),
                      ("unique_combination_of_columns", "topic_id,topic"): (0, True)}
    with pytest.raises(quality.DataQualityError):
        quality.assert_passed(quality.run_checks(models, checks))
    quality.assert_passed(quality.run_checks(models, checks[1:2]))


def test_suite_is_one_aggregation_over_each_model(spark, tmp_path):
    """Every model is scanned once and there is one shuffle by key, whatever the number of checks."""
    rows = [(i, f"t{i % 5}", None if i % 10 == 0 else i % 3, float(i % 4)) for i in range(100)]
    spark.createDataFrame(rows, "id int, topic string, n int, x double").write.parquet(str(tmp_path / "child"))
    spark.createDataFrame([("t0",), ("t1",), ("t1",), (None,)], "topic string").write.parquet(str(tmp_path / "parent"))
    models = {n: spark.read.parquet(str(tmp_path / n)) for n in ("child", "parent")}
    checks = [Check("not_null", "child", ("n",)), Check("unique", "child", ("id",)), Check("unique", "child", ("topic",)),
              Check("unique_combination_of_columns", "child", ("topic", "n")),
              Check("unique_combination_of_columns", "child", ("id", "x")),
              Check("relationships", "child", ("topic",), "parent", "topic"), Check("unique", "parent", ("topic",)),
              Check("not_null", "parent", ("topic",))]
    report = quality.run_checks(models, checks)
    got = [r.failures for r in report.collect()]
    want = []
    for c in checks:
        df = models[c.model]
        want.append({"not_null": lambda: quality.not_null(df, c.columns[0]), "unique": lambda: quality.unique(df, c.columns[0]),
                     "unique_combination_of_columns": lambda: quality.unique_combination(df, c.columns),
                     "relationships": lambda: quality.relationships(df, c.columns[0], models["parent"], "topic")}[c.kind]().count())
    assert sorted(got) == sorted(want) and sum(want) > 50
    plan = report._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1] if "== Initial Plan ==" in plan else plan
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning(number") == 2  # by check and key, then by check
    with pytest.raises(ValueError, match="differ in type"):
        quality.run_checks(models, [Check("relationships", "child", ("n",), "parent", "topic")])
