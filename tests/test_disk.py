"""Room on disk: shuffles that go when their action ends, one table's rows shuffled at a time, large batches in slices."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from indistar.operators import upsert
from indistar.plans import catalog, facts, job
from indistar.session import FREE_SHUFFLES, freed_shuffles
from indistar.sources import csv, csv_split, manifest
from indistar.sources.contract import RAW_COLUMNS, JobParams
from indistar.sources.star import raw_from_star

SF = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    """Files that hold shuffled rows."""
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def left(spark, before: set[str]) -> set[str]:
    """Shuffle files that an action has left; executors remove them a moment after it has ended."""
    until = time.time() + 20
    while (more := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return more


@pytest.fixture()
def alone(monkeypatch):
    """The most upserts that ran at one time."""
    real, lock, seen = upsert.upsert, threading.Lock(), {"now": 0, "most": 0, "calls": 0, "slices": []}

    def counted(*args, **kwargs):
        with lock:
            seen["now"] += 1
            seen["calls"] += 1
            seen["most"] = max(seen["most"], seen["now"])
            seen["slices"].append(kwargs.get("slices", args[6] if len(args) > 6 else 1))
        try:
            return real(*args, **kwargs)
        finally:
            with lock:
                seen["now"] -= 1
    monkeypatch.setattr(upsert, "upsert", counted)
    return seen


def test_job_leaves_no_shuffles_and_upserts_one_fact_table_at_a_time(spark, tmp_path, alone, monkeypatch):
    monkeypatch.setattr(upsert, "SLICE_BYTES", 1)
    monkeypatch.setattr(upsert, "SLICES", 3)
    before = shuffle_files(spark)
    raw = raw_from_star(spark, SF)
    res = job.run(spark, JobParams(output_prefix="marts"), str(tmp_path / "work"), raw=raw)
    assert not left(spark, before)
    assert (alone["most"], alone["calls"], alone["slices"]) == (1, 2, [upsert.SLICES] * 2)
    assert spark.conf.get(FREE_SHUFFLES, None) is None
    want = job.build_models(spark.read.parquet(res.staged))
    for name, path in res.facts.items():
        got = upsert.read_current(spark, path)
        assert got.count() == want[name].count() and got.exceptAll(want[name]).isEmpty()


def test_session_keeps_its_own_choice(spark):
    spark.conf.set(FREE_SHUFFLES, "false")
    try:
        with freed_shuffles(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "false"
        assert spark.conf.get(FREE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(FREE_SHUFFLES)
    with freed_shuffles(spark), freed_shuffles(spark):
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    assert spark.conf.get(FREE_SHUFFLES, None) is None


def test_sliced_upsert_gives_the_rows_of_a_whole_one(spark, tmp_path, monkeypatch):
    def table(name, low, high, sign):
        n = F.col("id")
        rows = spark.range(low, high).select(
            F.when(n % 50 > 0, F.concat_ws("-", (n % 3).cast("string"), (n % 400).cast("string"))).alias("k"),
            F.when(n % 50 > 0, (n % 3).cast("int")).alias("y"), (n * sign).alias("v"))  # keys repeat, some are null
        rows.union(rows.where("v % 7 = 0")).write.parquet(str(tmp_path / name))        # and so do rows
        return spark.read.parquet(str(tmp_path / name))

    old, new = table("old", 0, 3000, 1), table("new", 2900, 3100, -1)
    roots = {n: str(tmp_path / f"t{n}") for n in (1, 4)}
    for slices, root in roots.items():
        monkeypatch.setattr(upsert, "SLICE_BYTES", 1 << 30 if slices == 1 else 1)
        for batch in (old, new, new):
            upsert.upsert(batch, root, "k", ["y"], clusters=4, per=4, slices=slices)
    whole, cut = (sorted(map(str, upsert.read_current(spark, r).collect())) for r in roots.values())
    assert whole == cut and len(cut) > 3000
    entries = [manifest.current(spark, r).entries for r in roots.values()]
    assert entries[0].keys() == entries[1].keys()
    assert max(len(p) for p in entries[0].values()) <= 2 < max(len(p) for p in entries[1].values()) <= 4 + 1


def test_sliced_batch_shuffles_a_part_at_a_time(spark, tmp_path, monkeypatch):
    rows = spark.range(40000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    rows.write.parquet(str(tmp_path / "rows"))
    seen, real = [], upsert.fs.list_dirs

    def sizes(spark_, path):
        if "/new" in path:
            seen.append(sum(os.path.getsize(f) for f in map(str, tmp_path.rglob("*.parquet")) if "/new/" in f))
        return real(spark_, path)
    monkeypatch.setattr(upsert.fs, "list_dirs", sizes)
    root = upsert.upsert(spark.read.parquet(str(tmp_path / "rows")), str(tmp_path / "t"), "k", clusters=2, per=2, slices=4)
    parts = [b - a for a, b in zip([0, *seen], seen[:4], strict=False)]
    assert len(parts) == 4 and max(parts) < 2 * min(parts)
    assert upsert.read_current(spark, root).exceptAll(rows).isEmpty()


def test_compressed_csv_is_read_as_the_plain_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv, "COMPRESSED_RECORDS", 100)
    note = F.concat(F.lit('see "notes",\n\n'), F.col("Topic"))
    raw = raw_from_star(spark, SF).withColumn("DataValueFootnote", note).limit(450).localCheckpoint()
    for name, codec in (("plain", None), ("packed", "gzip")):
        csv.write_raw_csv(raw, str(tmp_path / name), compression=codec)
    files = {n: [f for f in (tmp_path / n).iterdir() if f.name.startswith("part-")] for n in ("plain", "packed")}
    assert all(f.name.endswith(".csv.gz") for f in files["packed"]) and len(files["packed"]) >= 5
    size = {n: sum(f.stat().st_size for f in fs) for n, fs in files.items()}
    assert size["packed"] < size["plain"] / 3
    plain, packed = (sorted(map(tuple, read(spark, str(tmp_path / n)).select(*RAW_COLUMNS).fillna("").collect()))
                     for n, read in (("plain", csv.read_raw_csv), ("packed", csv_split.read_raw_csv_split)))
    assert plain == packed and len(packed) == 450


def _written(spark, monkeypatch) -> list:
    """The compression of every CSV that queries write."""
    real, seen = catalog.write_raw_csv, []

    def seen_too(df, path, compression=None):
        seen.append(compression)
        real(df, path, compression)
    monkeypatch.setattr(catalog, "write_raw_csv", seen_too)
    return seen


def test_whole_job_query_packs_its_input_and_leaves_no_shuffles(spark, monkeypatch):
    seen, before = _written(spark, monkeypatch), shuffle_files(spark)
    out = catalog.whole_job_from_csv(spark, SF)
    assert seen == ["gzip"] and not left(spark, before)
    counts = {r["table_name"]: r["n_rows"] for r in out.collect()}
    clean = catalog.stg_clean(spark, SF)
    assert counts["fact_base"] == clean.count()
    assert counts["fact_strat"] == facts.fact_strat(facts.strata_long(clean)).count()


def test_incremental_runs_leave_no_shuffles_and_upsert_one_fact_table_at_a_time(spark, alone, monkeypatch):
    monkeypatch.setattr(upsert, "SLICE_BYTES", 1)
    monkeypatch.setattr(upsert, "SLICES", 2)
    seen, before = _written(spark, monkeypatch), shuffle_files(spark)
    out = catalog.incremental_from_csv(spark, SF)
    assert seen == ["gzip"] * 2 and not left(spark, before)
    assert (alone["most"], alone["calls"], alone["slices"]) == (1, 4, [2] * 4)  # two runs with files, the third had none
    got = {(r["run"], r["table_name"]): (r["read_files"], r["n_rows"]) for r in out.collect()}
    rows = catalog.fact_base(spark, SF)
    early = rows.where("year_start <= 1996").count()
    assert [got[n, "fact_base"] for n in range(3)] == [(True, early), (True, rows.count()), (False, rows.count())]


@pytest.mark.parametrize("strata", [False, True])
def test_upsert_query_frees_what_it_has_used(spark, tmp_path, alone, monkeypatch, strata):
    folders, put = [], monkeypatch.setattr
    put(catalog, "work_dir", lambda spark_, name: folders.append(str(tmp_path / f"{len(folders)}-{name}")) or folders[-1])
    put(upsert, "SLICE_BYTES", 1)
    put(upsert, "SLICES", 2)
    real, staged = catalog._staged, []

    def staged_alone(*args, **kwargs):
        staged.append([p.name for p in tmp_path.iterdir() if "stg_clean" in p.name])
        return real(*args, **kwargs)
    put(catalog, "_staged", staged_alone)
    before = shuffle_files(spark)
    got = (catalog.upsert_fact_strat if strata else catalog.upsert_fact_base)(spark, SF)
    assert staged == [[], []] and not left(spark, before)  # a batch is staged when the one before has gone
    key = facts.KEYS["fact_strat" if strata else "fact_base"]
    assert [p.name for p in tmp_path.iterdir()] == [f"0-{key}"] and alone["slices"] == [2] * 3
    first, every = catalog.stg_clean(spark, SF), catalog._clean(spark, SF, strip="all")
    make = (lambda c: facts.fact_strat(facts.strata_long(c))) if strata else facts.fact_base
    new = make(every.where("year >= 2000"))
    want = make(first.where("year <= 2000")).join(new.select(key), key, "left_anti").unionByName(new)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
