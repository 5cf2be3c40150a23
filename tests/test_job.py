"""The whole job on the smallest scale: land, stage, build, check, publish, list."""

import pytest
from pyspark.sql import functions as F

from indistar.operators import quality, upsert
from indistar.plans import job, staging
from indistar.plans.job import MART_NAMES
from indistar.plans.steps import FOLDER, Steps
from indistar.sources import fs, manifest, publish
from indistar.sources.contract import JobParams
from indistar.sources.star import raw_from_star


def test_job_end_to_end_and_rerun(spark, tmp_path):
    work = str(tmp_path / "work")
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    res = job.run(spark, JobParams(output_prefix="assignment/parquet/"), work, raw=raw)
    assert res.landed_now
    assert res.report.where(~F.col("passed")).count() == 0
    assert res.report.count() == len(job.DECLARED_CHECKS)
    marts = {r.mart for r in res.inventory.collect()}
    assert marts == set(job.MART_NAMES)
    assert all(u.endswith(".parquet") and "/assignment/parquet/" in u for u in res.published.values())
    n_base = upsert.read_current(spark, res.facts["fact_base"]).count()
    version = manifest.current(spark, res.facts["fact_base"]).version
    again = job.run(spark, JobParams(output_prefix="assignment/parquet/"), work, raw=raw)
    assert not again.landed_now  # landing skipped: already complete
    assert manifest.current(spark, again.facts["fact_base"]).version > version  # a new version
    assert upsert.read_current(spark, again.facts["fact_base"]).count() == n_base  # upsert is idempotent


def test_failing_checks_leave_the_published_marts(spark, tmp_path):
    work = str(tmp_path / "work")
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    params = JobParams(output_prefix="marts", force_landing=True)
    uri = job.run(spark, params, work, raw=raw).published["agg_indicator_trend"]
    before, folder = publish.read_mart(spark, uri).count(), publish.current_path(spark, uri)
    broken = raw.withColumn("LocationID", F.when(F.col("YearStart") != "1995", F.col("LocationID")).otherwise(""))
    with pytest.raises(quality.DataQualityError, match="not_null"):
        job.run(spark, params, work, raw=broken)
    assert publish.current_path(spark, uri) == folder and publish.read_mart(spark, uri).count() == before
    # what the failed run had staged is gone, and every mart has one folder
    assert [f for f in fs.list_dirs(spark, uri)] == [folder.rsplit("/", 1)[1]]


@pytest.mark.parametrize("finished", [1, 8, 13])
def test_killed_job_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, finished):
    work, params = str(tmp_path / "work"), JobParams(output_prefix="marts")
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    real, names = Steps._finish, []

    def dies(self, name, *rest):
        if len(names) >= finished:
            raise KeyboardInterrupt("killed")  # its output is written, and recorded nowhere
        names.append(name)
        real(self, name, *rest)
    monkeypatch.setattr(Steps, "_finish", dies)
    with pytest.raises(KeyboardInterrupt):
        job.run(spark, params, work, raw=raw)
    monkeypatch.setattr(Steps, "_finish", real)
    res = job.run(spark, params, work, raw=raw)
    assert not set(res.steps) & set(names) and len(res.steps) + len(names) == 7 + 2 + 4 + 3
    assert res.report.where(~F.col("passed")).count() == 0
    want = job.build_models(staging.clean(raw))
    tables = {n: spark.read.parquet(p) for n, p in res.dims.items()}
    tables |= {n: publish.read_mart(spark, u) for n, u in res.published.items()}
    tables |= {n: upsert.read_current(spark, p) for n, p in res.facts.items()}
    for name, df in tables.items():
        assert df.count() == want[name].count(), name
    # nothing of the killed run is left over
    for n in MART_NAMES:
        assert len(fs.list_dirs(spark, res.published[n])) == 1
    for n in (*res.dims, "stg_clean", "dq_report"):
        assert len(fs.list_dirs(spark, f"{work}/{FOLDER}/{n}")) == 1
    assert len(job.run(spark, params, work, raw=raw).steps) == 16  # a new run does everything anew
