"""Multi-line CSV read in byte ranges: equal to the csv module's rows, wherever the ranges begin."""

import csv
import random

import pytest

from indistar.sources import csv_split
from indistar.sources.contract import RAW_COLUMNS, ContractError

FIELDS = ["", "a", "12,5", "x y", "line1\nline2", 'say "hi", twice', "\n\n\n", '"', '""', "end\n", "a\r\nb", 'é"\n"' * 40,
          "\n" * 900]


@pytest.fixture()
def ranges(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def set_(size):
        for k, v in zip(keys, (size, "1b"), strict=True):
            spark.conf.set(k, v)
    yield set_
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(path, rows, eol):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=eol)
        w.writerow(RAW_COLUMNS)
        for i, r in enumerate(rows):
            w.writerow(r)
            if i % 20 == 3:
                f.write(eol)  # an empty line is no row


def test_ranges_give_the_csv_modules_rows(spark, tmp_path, ranges):
    rng = random.Random(1)
    want = []
    for name, eol in (("a.csv", "\n"), ("b.csv", "\r\n")):
        rows = [[rng.choice(FIELDS[:4] if rng.random() < 0.8 else FIELDS) for _ in RAW_COLUMNS] for _ in range(120)]
        for r in rows:
            r[0] = "2019"
        _write(tmp_path / name, rows, eol)
        with open(tmp_path / name, newline="", encoding="utf-8") as f:
            want += [r for r in csv.reader(f) if r][1:]
    want = sorted(tuple(r) for r in want)
    seen = []
    for size in ("128m", "700b", "5000b"):
        ranges(size)
        rows = csv_split.read_raw_csv_split(spark, str(tmp_path)).collect()
        assert sorted(tuple(v or "" for v in r) for r in rows) == want
        seen.append(csv_split._lines(spark, str(tmp_path)).select("file", "block").distinct().count())
    assert seen[1] > 50 > seen[2] > seen[0]  # a file is many ranges


def test_strictness(spark, tmp_path):
    def read(text, name):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(text, encoding="utf-8")
        return csv_split.read_raw_csv_split(spark, str(tmp_path / name)).collect()

    head, row = ",".join(RAW_COLUMNS), ",".join(["1"] * len(RAW_COLUMNS))
    assert len(read(f"{head}\n{row}\n", "good")) == 1
    assert len(read(f"﻿{head}\r\n{row}", "bom")) == 1
    with pytest.raises(ContractError, match="not closed"):
        read(f'{head}\n{row}\n"open,{row}\n', "open")
    with pytest.raises(ContractError, match="misses"):
        read(head.replace("Topic,", "Other,") + f"\n{row}\n", "name")
    for bad in (row + ",1", row[:-2]):
        with pytest.raises(Exception, match="(?i)malformed|parse"):
            read(f"{head}\n{row}\n{bad}\n", f"wide{len(bad)}")
    (tmp_path / "good" / "y.csv").write_text("Extra," + head + "\n", encoding="utf-8")
    with pytest.raises(ContractError, match="different headers"):
        csv_split.read_raw_csv_split(spark, str(tmp_path / "good"))


def test_records_are_parsed_once_and_pieces_hold_no_whole_record(spark, tmp_path):
    _write(tmp_path / "a.csv", [["2019", "x\ny"] + ["1"] * (len(RAW_COLUMNS) - 2)] * 5, "\n")
    rows = csv_split.read_raw_csv_split(spark, str(tmp_path))
    filtered = rows.where("DataValue = '1' and Topic = '1'")._jdf.queryExecution().optimizedPlan().toString()
    assert filtered.count("from_csv(") == 1
    lines = csv_split._lines(spark, str(tmp_path))
    cut = lines.selectExpr("file", "block", "0 AS odd", "value")
    whole = cut.mapInArrow(csv_split._whole, csv_split._CUT_SCHEMA).collect()
    assert sorted((r["kind"], r["first"]) for r in whole if r["text"]) == [(csv_split.WHOLE, False)] * 5 + [(csv_split.WHOLE, True)]
    assert cut.mapInArrow(csv_split._pieces, csv_split._CUT_SCHEMA).count() == 0
    assert [r["line"] for r in csv_split.range_parity(lines).collect()] == [",".join(RAW_COLUMNS)]
