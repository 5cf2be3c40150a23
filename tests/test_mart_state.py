"""Marts from mergeable states: as a full rebuild after every batch; only touched buckets are read again."""

import math

from pyspark.sql import functions as F

from indistar.operators import upsert
from indistar.plans import mart_state, marts, staging
from indistar.sources import publish
from indistar.sources.star import raw_from_star


def _rows(df, keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def _same(got, want, keys):
    a, b = _rows(got, keys), _rows(want, keys)
    assert a.keys() == b.keys() and a
    for k, r in b.items():
        for c in want.columns:
            x, y = a[k][c], r[c]
            assert x == y or (isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)), (k, c, x, y)


def test_states_after_batches_equal_a_rebuild(spark, tmp_path):
    root = str(tmp_path / "m")
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    first, again = staging.clean(raw), staging.clean(raw, strip="all")
    early, one_year = F.col("year") <= 1997, F.col("year") == 1995
    n = mart_state.apply_batch(first.where(early), root)
    restated = mart_state.apply_batch(again.where(one_year), root)
    assert 0 < restated <= upsert.PER_CLUSTER < n  # the other years' buckets keep their states
    mart_state.apply_batch(first.where(~early), root)
    assert mart_state.refresh(spark, root) == 0
    state = mart_state.read_state(spark, root)
    # the restated year's rows replace the others of their keys
    keyed = staging.clean(raw).where(~one_year).unionByName(
        first.where(one_year).join(again.where(one_year).select("year").distinct(), "year", "left_anti"))
    want = keyed.unionByName(again.where(one_year))
    _same(mart_state.trend(state), marts.trend(want, False), ["indicator_name", "category", "subcategory", "year"])
    _same(mart_state.year_overall(state), marts.year_overall(want, False), ["indicator_name", "year"])
    _same(mart_state.year_state(state), marts.year_state(want, False), ["indicator_name", "year", "state"])


def test_catalogued_tables_give_row_counts(spark, tmp_path):
    root = str(tmp_path / "lake")
    uris = publish.publish_all({"facts_t": spark.range(5000).select((F.col("id") % 50).alias("k"), "id"),
                                "names_t": spark.range(50).select(F.col("id").alias("k"), F.lit("n").alias("name"))}, root, "p")
    publish.register_tables(spark, uris)
    joined = spark.sql("select f.k, count(*) n from facts_t f join names_t d on f.k = d.k where f.id < 1000 group by f.k")
    assert sorted(tuple(r) for r in joined.collect()) == [(k, 20) for k in range(50)]
    plan = joined._jdf.queryExecution().optimizedPlan()
    scans = plan.collectLeaves()
    counts = sorted(str(scans.apply(i).stats().rowCount().get()) for i in range(scans.size()))
    assert counts == ["50", "5000"]
    filtered = spark.sql("select * from facts_t where id < 1000")._jdf.queryExecution().optimizedPlan().stats().rowCount().get()
    assert 900 <= int(str(filtered)) <= 1100  # from the column's statistics
    publish.publish(spark.range(7).select(F.col("id").alias("k"), "id"), root, "p", "facts_t")
    publish.register_tables(spark, {"facts_t": uris["facts_t"]})
    assert spark.sql("select count(*) from facts_t").first()[0] == 7
