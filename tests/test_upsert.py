"""Keyed upsert: replace by key, keep in-batch duplicates, idempotent, failure-safe."""

import pytest

from indistar.operators import upsert
from indistar.sources import manifest


def _rows(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_upsert_semantics_and_idempotence(spark, tmp_path):
    root = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    batch = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z")], "k int, v string")
    upsert.upsert(old, root, "k")
    upsert.upsert(batch, root, "k")
    once = _rows(upsert.read_current(spark, root))
    assert once == [(1, "a"), (2, "x"), (3, "y"), (3, "z")]
    upsert.upsert(batch, root, "k")
    assert _rows(upsert.read_current(spark, root)) == once


def test_failed_write_leaves_current_version(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), root, "k")
    bad = spark.createDataFrame([(1, "0")], "k int, v string").selectExpr(
        "k", "cast(assert_true(v = 'never') as string) as v")
    with pytest.raises(Exception):
        upsert.upsert(bad, root, "k")
    assert _rows(upsert.read_current(spark, root)) == [(1, "a")]
    upsert.upsert(spark.createDataFrame([(2, "b")], "k int, v string"), root, "k")
    assert _rows(upsert.read_current(spark, root)) == [(1, "a"), (2, "b")]
    assert upsert.vacuum(spark, root, keep=1)
    assert _rows(upsert.read_current(spark, root)) == [(1, "a"), (2, "b")]


def test_only_touched_buckets_are_written(spark, tmp_path):
    from pyspark.sql import functions as F

    root = str(tmp_path / "t")
    key = F.concat_ws("-", "y", (F.col("id") % 500).cast("string"))
    rows = spark.range(4000).withColumn("y", (F.col("id") % 8).cast("int")).select(key.alias("k"), "y", "id")
    upsert.upsert(rows, root, "k", ["y"], clusters=8, per=4)
    first = manifest.current(spark, root)
    batch = rows.where("y = 3").select("k", "y", (-F.col("id")).alias("id"))
    upsert.upsert(batch, root, "k")
    second = manifest.current(spark, root)
    changed = {b for b in second.entries if second.entries[b] != first.entries.get(b)}
    own = {str(r[0]) for r in batch.select(upsert.bucket_of("k", ["y"], 8, 4)).distinct().collect()}
    assert changed == own and len(own) <= 4 < len(second.entries)
    got = sorted((r.k, r.y, r.id) for r in upsert.read_current(spark, root).collect())
    want = sorted((r.k, r.y, -r.id if r.y == 3 else r.id) for r in rows.collect())
    assert got == want
    flags = {r.bucket for r in upsert.rewritten(spark, root).where("rewritten").collect()}
    assert flags == {int(b) for b in changed}
    # the bytes written follow the batch, not the table
    size = lambda p: sum(f.stat().st_size for f in (tmp_path / "t" / p).rglob("*.parquet"))
    assert sum(size(p) for b in changed for p in second.entries[b]) < sum(size(p) for ps in first.entries.values() for p in ps) / 4
    with pytest.raises(ValueError, match="key"):
        upsert.upsert(batch, root, "y")


def test_empty_and_null_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k string, v int")
    upsert.upsert(empty, root, "k")
    assert upsert.read_current(spark, root).collect() == []
    odd = spark.createDataFrame([(None, 1), ("", 2), (None, 3)], "k string, v int")
    upsert.upsert(odd, root, "k")
    upsert.upsert(empty, root, "k")
    assert sorted(r.v for r in upsert.read_current(spark, root).collect()) == [1, 2, 3]


def test_hot_key_third_of_rows_stays_exact(spark, tmp_path):
    """One key holds a third of all rows; the sort-merge anti join is split by AQE."""
    from pyspark.sql import functions as F

    from indistar.operators import quality

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old_conf = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        old = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
            F.lit("old").alias("v"))
        batch = spark.range(0, 3000, 7).select(F.col("id").alias("k"), F.lit("new").alias("v"))
        for name, df in (("old", old), ("batch", batch)):
            df.write.parquet(str(tmp_path / name))
        old, batch = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "batch"))
        merged = upsert.merge_batch(old, batch, "k")
        counted = merged.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        got = {r.v: r.n for r in counted.collect()}
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()  # the hot key was split
        batch_keys = {r.k for r in batch.collect()}
        kept = sum(1 for i in range(n) if (0 if i % 3 == 0 else i) not in batch_keys)
        assert got == {"old": kept, "new": batch.count()}
        dup = quality.unique(old, "k").collect()
        assert [(r.unique_field, r.n_records) for r in dup] == [(0, n // 3)]
    finally:
        for k, v in old_conf.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
