"""Streaming incremental facts: each landed file once; replay is harmless."""

from pyspark.sql import functions as F

from indistar.operators import upsert
from indistar.plans import facts, staging
from indistar.sources.star import raw_from_star
from indistar.streaming.incremental import apply_batch, start_incremental_facts


def test_stream_of_landed_files_matches_batch(spark, tmp_path):
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    landing = str(tmp_path / "landing")
    root = str(tmp_path / "facts")
    ckpt = str(tmp_path / "ckpt")
    raw.where(F.col("YearStart") <= "1997").write.parquet(f"{landing}/part1")
    q = start_incremental_facts(spark, f"{landing}/*", root, ckpt)
    q.awaitTermination()
    raw.where(F.col("YearStart") > "1997").write.parquet(f"{landing}/part2")
    q = start_incremental_facts(spark, f"{landing}/*", root, ckpt)
    q.awaitTermination()
    got = upsert.read_current(spark, f"{root}/fact_base")
    expected = facts.fact_base(staging.clean(raw))
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0
    # replaying a batch changes nothing
    before = upsert.read_current(spark, f"{root}/fact_strat").count()
    apply_batch(spark.read.parquet(f"{landing}/part2"), root)
    assert upsert.read_current(spark, f"{root}/fact_strat").count() == before
