"""CSV scan, contract gate, landing, publishing and inventory."""

import pytest
from pyspark.sql import functions as F

from indistar.sources import fs, manifest, publish
from indistar.sources.contract import (RAW_COLUMNS, ContractError, JobParams, check_contract,
                                       resolve_input_path)
from indistar.sources.csv import read_raw_csv
from indistar.sources.landing import land_raw


def _csv_line(values):
    out = []
    for v in values:
        out.append('"' + v.replace('"', '""') + '"' if any(ch in v for ch in ',"\n') else v)
    return ",".join(out)


def _write_csv(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(RAW_COLUMNS) + "\n")
        for r in rows:
            f.write(_csv_line(r) + "\n")


def _raw_row(**over):
    row = {c: "" for c in RAW_COLUMNS}
    row.update({"YearStart": "2019", "YearEnd": "2019", "DataValue": "1.5"})
    row.update(over)
    return [row[c] for c in RAW_COLUMNS]


def test_csv_quotes_newlines_and_empty(spark, tmp_path):
    p = tmp_path / "raw.csv"
    _write_csv(p, [_raw_row(Question='say "hi", twice', DataValueFootnote="line1\nline2"),
                   _raw_row(Question="plain")])
    with open(p, "a", encoding="utf-8") as f:  # a quoted empty field
        f.write(_csv_line(_raw_row(Question="q3")).replace(",q3,", ',"",', 1) + "\n")
    df = read_raw_csv(spark, str(p))
    rows = df.orderBy("Question").collect()
    assert len(rows) == 3
    qs = {r.Question for r in rows}
    assert 'say "hi", twice' in qs and "plain" in qs
    assert any(r.DataValueFootnote == "line1\nline2" for r in rows)
    assert all(t == "string" for _, t in df.dtypes)


def test_contract_missing_column_and_empty(spark, tmp_path):
    bad = spark.createDataFrame([("1",)], "YearStart string")
    with pytest.raises(ContractError):
        check_contract(bad)
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    with pytest.raises(ContractError):
        check_contract(empty)


def test_input_path_precedence(monkeypatch):
    monkeypatch.delenv("CSV_S3_URI", raising=False)
    assert resolve_input_path(None) == "raw/indicators.csv"
    monkeypatch.setenv("CSV_S3_URI", "s3://b/k.csv")
    assert resolve_input_path(None) == "s3://b/k.csv"
    assert resolve_input_path("file:/x.csv") == "file:/x.csv"


def test_landing_skip_force_and_reject_empty(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    a = spark.createDataFrame([_raw_row(Topic="A")], schema)
    b = spark.createDataFrame([_raw_row(Topic="B"), _raw_row(Topic="B")], schema)
    target = str(tmp_path / "raw")
    landed, now = land_raw(a, target)
    assert now and landed.count() == 1
    landed, now = land_raw(b, target)
    assert not now and [r.Topic for r in landed.collect()] == ["A"]
    landed, now = land_raw(b, target, force=True)
    assert now and landed.count() == 2
    with pytest.raises(ContractError):
        land_raw(spark.createDataFrame([], schema), str(tmp_path / "other"))
    assert not fs.exists(spark, str(tmp_path / "other"))


def test_output_prefix_rules():
    assert publish.output_uri("s3://b", "a/p/", "m") == "s3://b/a/p/m.parquet"
    assert publish.output_uri("s3://b", "a/p", "m") == "s3://b/a/p/m.parquet"
    assert publish.output_uri("s3://b/", "", "m") == "s3://b/m.parquet"
    assert publish.output_uri("s3://b", None, "m") == "s3://b/m.parquet"


def test_publish_inventory_and_adhoc(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    root = str(tmp_path / "lake")
    uris = publish.publish_all({"m1": df, "m2": df.where("k = 0")}, root, "gold/")
    inv = {r.mart: r for r in publish.inventory(spark, root, "gold/").collect()}
    assert set(inv) == {"m1", "m2"} and all(r.total_bytes > 0 for r in inv.values())
    out = publish.adhoc_sql(spark, uris, "select k, count(*) as n from m1 group by k order by k")
    assert [(r.k, r.n) for r in out.collect()] == [(0, 34), (1, 33), (2, 33)]


def test_csv_header_matched_by_name(spark, tmp_path):
    cols = ["Extra"] + list(reversed(RAW_COLUMNS))
    p = tmp_path / "wide.csv"
    row = {c: "" for c in cols}
    row.update({"Extra": "x", "YearStart": "2019", "Topic": "T", "DataValue": "1.5"})
    with open(p, "w", encoding="utf-8") as f:
        f.write(",".join(cols) + "\n" + ",".join(row[c] for c in cols) + "\n")
    df = read_raw_csv(spark, str(p))
    assert tuple(df.columns) == RAW_COLUMNS
    r = df.first()
    assert (r.YearStart, r.Topic, r.DataValue) == ("2019", "T", "1.5")


def test_failed_publish_keeps_every_old_mart(spark, tmp_path):
    root = str(tmp_path / "lake")
    publish.publish_all({"a": spark.range(3), "b": spark.range(4)}, root, "p/")
    bad = spark.range(5).selectExpr("cast(assert_true(id < 0) as string) as id")
    with pytest.raises(Exception):
        publish.publish_all({"a": spark.range(30), "b": bad}, root, "p/")
    uri = {n: publish.output_uri(root, "p", n) for n in "ab"}
    assert [publish.read_mart(spark, uri[n]).count() for n in "ab"] == [3, 4]
    assert len(fs.list_dirs(spark, uri["a"])) == 1  # what was staged is gone
    publish.publish(spark.range(30), root, "p/", "a")  # the other mart stays published
    assert [publish.read_mart(spark, uri[n]).count() for n in "ab"] == [30, 4]
    for n in range(4):
        publish.publish(spark.range(n), root, "p/", "a")
    assert len(fs.list_dirs(spark, uri["a"])) == publish.KEPT_VERSIONS
    with pytest.raises(FileNotFoundError):
        publish.read_mart(spark, publish.output_uri(root, "p", "c"))


def test_manifests_cut_short_or_written_twice(spark, tmp_path):
    root = str(tmp_path / "m")
    assert manifest.current(spark, root) is None
    manifest.commit(spark, root, {"a": ["x"]})
    (tmp_path / "m" / manifest.FOLDER / "00000002.json").write_text('{"version": 2, "entr')
    assert manifest.current(spark, root).entries == {"a": ["x"]}
    assert manifest.commit(spark, root, {"a": ["y"]}).version == 3
    assert not fs.create_text(spark, f"{root}/{manifest.FOLDER}/00000003.json", "{}")
    assert manifest.current(spark, root).entries == {"a": ["y"]}


def test_output_precedence(monkeypatch):
    for name in ("S3_BUCKET", "S3_PARQUET_PREFIX"):
        monkeypatch.delenv(name, raising=False)
    assert JobParams().resolved_output_root() is None and JobParams().resolved_output_prefix() == "assignment/parquet"
    monkeypatch.setenv("S3_BUCKET", "lake")
    monkeypatch.setenv("S3_PARQUET_PREFIX", "gold/")
    assert (JobParams().resolved_output_root(), JobParams().resolved_output_prefix()) == ("s3a://lake", "gold/")
    own = JobParams(output_root="/data", output_prefix="")
    assert (own.resolved_output_root(), own.resolved_output_prefix()) == ("/data", "")


def test_scheme_gate():
    with pytest.raises(ContractError, match="scheme"):
        JobParams(csv_uri="/tmp/x.csv", allowed_schemes=("s3a",)).resolved_csv_uri()
    assert JobParams(csv_uri="s3a://b/x.csv", allowed_schemes=("s3a",)).resolved_csv_uri() == "s3a://b/x.csv"
