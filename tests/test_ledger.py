"""Processed-input record: only new files are read; touched, changed and failed ones."""

import os

import pytest

from indistar.operators import upsert
from indistar.plans import facts, job, staging
from indistar.sources import ledger, ordered
from indistar.sources.contract import JobParams
from indistar.sources.csv import write_raw_csv
from indistar.sources.star import raw_from_star


def _file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return folder / name


def _names(p):
    return [f.rsplit("/", 1)[1] for f in p.files]


def test_only_new_content_is_pending(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MERGED_FROM", 3)
    inputs, root = tmp_path / "in", str(tmp_path / "ledger")
    a = _file(inputs, "a.csv", "x\n1\n")
    _file(inputs, "empty.csv", "")
    first = ledger.pending(spark, root, str(inputs))
    assert _names(first) == ["a.csv"]
    assert _names(ledger.pending(spark, root, str(inputs))) == ["a.csv"]  # not committed: still pending
    ledger.commit(spark, root, first)
    assert ledger.pending(spark, root, str(inputs)).files == []
    b = _file(inputs, "b.csv", "x\n2\n")
    second = ledger.pending(spark, root, str(inputs))
    assert _names(second) == ["b.csv"]
    ledger.discard(spark, root, second)
    second = ledger.pending(spark, root, str(inputs))
    ledger.commit(spark, root, second)
    os.utime(a, (1_000_000_000, 1_000_000_000))  # touched, same content: recorded, not read again
    touched = ledger.pending(spark, root, str(inputs))
    assert touched.files == [] and touched.folder
    ledger.commit(spark, root, touched)  # the third folder: they are merged
    assert ledger.pending(spark, root, str(inputs)).folder is None
    assert ledger.records(spark, root).count() == 2
    assert len(list((tmp_path / "ledger" / ledger.DATA).iterdir())) == 1
    b.write_text("x\n3\n", encoding="utf-8")  # same length, other content
    os.utime(b, (1_100_000_000, 1_100_000_000))
    assert _names(ledger.pending(spark, root, str(inputs))) == ["b.csv"]


def test_incremental_runs_equal_a_full_one(spark, tmp_path, monkeypatch):
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    csv, work = str(tmp_path / "csv"), str(tmp_path / "work")
    params = JobParams(csv_uri=csv)
    write_raw_csv(raw.where("YearStart <= '1995'"), f"{csv}/a")
    _, n = job.run_incremental(spark, params, work)
    assert n >= 1
    write_raw_csv(raw.where("YearStart > '1995'"), f"{csv}/b")
    real = upsert.upsert

    def dies(batch, root, *rest):
        if root.endswith("fact_strat"):
            raise RuntimeError("lost")
        return real(batch, root, *rest)
    monkeypatch.setattr(job.upsert, "upsert", dies)
    with pytest.raises(RuntimeError, match="lost"):
        job.run_incremental(spark, params, work)
    monkeypatch.setattr(job.upsert, "upsert", real)
    roots, n = job.run_incremental(spark, params, work)  # the files of the run that died, once more
    assert n == len(list((tmp_path / "csv" / "b").glob("*.csv")))
    assert job.run_incremental(spark, params, work)[1] == 0
    clean = staging.clean(raw)
    for name, want in (("fact_base", facts.fact_base(clean)), ("fact_strat", facts.fact_strat(facts.strata_long(clean)))):
        got = upsert.read_current(spark, roots[name])
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_positions_of_an_ordered_table(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, f"k{i % 3}", i) for i in range(400)] + [(1, "same", 0)] * 100
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(5)
    ordered.write_ordered(df, str(tmp_path / "t"), ["a", "b", "c"], partitions=6)
    got = sorted(tuple(r) for r in ordered.read_ordered(spark, str(tmp_path / "t")).collect())
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert [r[0] for r in got] == list(range(1, 501)) and [r[1:] for r in got] == want
    assert len(list((tmp_path / "t" / ordered.DATA).glob("*.parquet"))) > 3
    ordered.write_ordered(df.limit(0), str(tmp_path / "e"), ["a"])
    assert ordered.read_ordered(spark, str(tmp_path / "e")).collect() == []
    with pytest.raises(ValueError, match="position"):
        ordered.write_ordered(df.withColumnRenamed("c", "position"), str(tmp_path / "p"), ["a"])
        ordered.read_ordered(spark, str(tmp_path / "p"))
