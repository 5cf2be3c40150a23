"""N01 for large files: a multi-line CSV file read by many tasks.

A quoted field may hold newlines, so a reader that starts in the middle of a file cannot tell
whether it stands inside a field. What it needs is one bit: whether the number of quotes before
its first line is odd. (A doubled quote inside a field counts two, so it does not matter.)

1. *Count.* Spark's text source cuts files into byte ranges and gives every range the lines
   that start in it. Per range, the quotes are counted: one small row per range is all that is
   shuffled. Summed along each file they give every range's parity. That table is written, with
   every file's first line.
2. *Cut.* The lines are read again, each range with its parity. A line starts a record if the quotes
   before it, in all, are even. A task joins the lines of a record as it goes along.
3. *Mend.* Of a range, the lines before its first record start belong to a record of an
   earlier range, and its last record may be open. Those pieces, two per range at most, are put
   together along the file.
4. *Parse.* Every record is parsed by Spark's own CSV parser, strictly.

So a file's lines are scanned three times (counted, cut to whole records, cut to pieces) by as many
tasks as it has ranges, and its rows are never shuffled. Files must be UTF-8 and lines end with ``\\n`` or
``\\r\\n``; inside quoted fields both stay as they are. The first record of every file is its header, and all
files must have the same one. An unclosed quote raises, and so does a row with too many or too few
fields. Empty lines outside of quotes are skipped, as Spark's reader does. Compressed
files are one range each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indistar.session import work_dir
from indistar.sources.contract import ContractError, check_contract

_RANGE = ("file", "block")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    "value"))


_COUNT_SCHEMA = "file string, block long, quotes long, line string"


def _ranges(b: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """(range, from, to) of the ranges that a batch of lines holds."""
    files, blocks = b.column("file"), b.column("block").to_numpy()
    codes = files.dictionary_encode().indices.to_numpy()
    edges = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), b.num_rows]
    for lo, hi in zip(edges, edges[1:], strict=False):
        yield (files[lo].as_py(), int(blocks[lo])), lo, hi


def _quotes(b: pa.RecordBatch) -> np.ndarray:
    return pc.count_substring(b.column("value"), '"').to_numpy(zero_copy_only=False)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to one row per range and batch: its quotes, and the file's first line where the batch holds it."""
    here = None
    for b in batches:
        if not b.num_rows:
            continue
        quotes, out = _quotes(b), []
        for key, lo, hi in _ranges(b):
            line = b.column("value")[lo].as_py() if key != here and key[1] == 0 else None
            out.append((*key, int(quotes[lo:hi].sum()), line))
            here = key
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                         names=["file", "block", "quotes", "line"])


def range_parity(lines: DataFrame) -> DataFrame:
    """(file, block, odd, open, line): whether the quotes before the range, and in the whole file, are odd in number;
    the file's first line at its first range."""
    counts = (lines.mapInArrow(_count, _COUNT_SCHEMA).groupBy(*_RANGE)
              .agg((F.sum("quotes") % 2).alias("q"), F.max("line").alias("line")))  # one line per file, else null
    along = Window.partitionBy("file").orderBy("block")  # one row per range
    return counts.select(*_RANGE, ((F.sum("q").over(along) - F.col("q")) % 2 == 1).alias("odd"),
                         (F.sum("q").over(Window.partitionBy("file")) % 2 == 1).alias("open"), "line")


#: Kinds of text: a whole record; lines before a range's first record start; a record open at its end.
WHOLE, HEAD, TAIL = 0, 1, 2


def _cut(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Lines in file order, with their range's parity, to (file, block, first, kind, text).

    Gives the whole records, or the pieces only. ``first`` marks a file's first record. Batches may hold
    several ranges; a range's lines follow one another within a task.
    """
    # the range, quotes so far, whether a record has begun in it, how many, and the open one's lines
    here, odd, started, begun, held = None, 0, False, 0, []
    out: list[tuple] = []

    def put(kind: int) -> None:
        if held and (kind == WHOLE) == whole:
            out.append((*here, here[1] == 0 and begun == 1, kind, "\n".join(held)))

    def close() -> None:
        # what the range leaves behind: a record that its end closes, one that goes on, or a head
        put(HEAD if not started else TAIL if odd else WHOLE)

    for b in batches:
        if not b.num_rows:
            continue
        text, quotes = b.column("value"), _quotes(b)
        start_odd = b.column("odd").to_numpy(zero_copy_only=False)
        for key, lo, hi in _ranges(b):
            if key != here:
                close()
                here, odd, started, begun, held = key, int(start_odd[lo]), False, 0, []
            before = (odd + np.concatenate([[0], np.cumsum(quotes[lo:hi])])) & 1
            odd = int(before[-1])
            starts = np.flatnonzero(before[:-1] == 0) + lo
            if not len(starts):
                held += text.slice(lo, hi - lo).to_pylist()
                continue
            held += text.slice(lo, int(starts[0]) - lo).to_pylist()
            put(WHOLE if started else HEAD)
            if whole and len(starts) > 1:  # the records between two starts, joined at once
                lines = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), text)
                yield _batch(key, pc.binary_join(lines, "\n"), key[1] == 0 and begun == 0)
            started, begun = True, begun + len(starts)
            held = text.slice(int(starts[-1]), hi - int(starts[-1])).to_pylist()
        if out:
            yield _rows(out)
            out.clear()
    close()
    if out:
        yield _rows(out)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _cut(batches, True)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _cut(batches, False)


_CUT_SCHEMA = "file string, block long, first boolean, kind int, text string"


_NAMES = ["file", "block", "first", "kind", "text"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=_NAMES)


def _batch(key: tuple[str, int], text: pa.Array, first: bool) -> pa.RecordBatch:
    """Whole records of one range; ``first`` tells of the first of them."""
    n = len(text)
    flags = np.zeros(n, bool)
    flags[0] = first
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(key[0], pa.string()), n), pa.repeat(pa.scalar(key[1], pa.int64()), n),
                                       pa.array(flags), pa.repeat(pa.scalar(WHOLE, pa.int32()), n), text], names=_NAMES)


def _parity_table(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """:func:`range_parity` written, so that the lines are counted once; an open quote raises."""
    path = work_dir(spark, "csv_ranges")
    range_parity(lines).write.parquet(path)
    parity = spark.read.parquet(path)
    bad = parity.where("open").select("file").first()
    if bad:
        raise ContractError(f"a quoted field is not closed at the end of {bad[0]}")
    return parity


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(text, first): the records of all files under ``path``; ``first`` marks a file's header."""
    lines = _lines(spark, path)
    return _records(lines, _parity_table(spark, lines))


def _records(lines: DataFrame, parity: DataFrame) -> DataFrame:
    # one row per byte range, of which the driver plans the scan anyway; a streamed side keeps its order
    known = F.broadcast(parity.select(*_RANGE, "odd"))
    lost = F.raise_error(F.lit("the scan was cut at other places the second time; run it again"))
    ordered = (lines.join(known, list(_RANGE), "left")
               .select(*_RANGE, F.coalesce("odd", lost.cast("boolean")).cast("int").alias("odd"), "value"))
    whole = ordered.mapInArrow(_whole, _CUT_SCHEMA).select("text", "first")
    # pieces in file order: every tail begins a record that the heads after it go on with
    along = Window.partitionBy("file").orderBy("block", "kind")
    pieces = (ordered.mapInArrow(_pieces, _CUT_SCHEMA)
              .withColumn("record", F.sum((F.col("kind") == TAIL).cast("long")).over(along)))
    mended = (pieces.groupBy("file", "record")
              .agg(F.sort_array(F.collect_list(F.struct("block", "kind", "text", "first"))).alias("p"))
              .select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"),
                      F.col("p")[0]["first"].alias("first")))
    both = whole.unionByName(mended)
    return both.select(F.regexp_replace("text", r"\r\z", "").alias("text"), "first").where("text != ''")


def read_raw_csv_split(spark: SparkSession, path: str | list[str], require_rows: bool = False) -> DataFrame:
    """Raw rows under the contract, as :func:`~indistar.sources.csv.read_raw_csv` gives them."""
    lines = _lines(spark, path)
    parity = _parity_table(spark, lines)
    rows = _records(lines, parity)
    # distinct header lines: one, or an error
    heads = [r[0] for r in parity.where("line is not null").select(
        F.regexp_replace("line", "^﻿|\r$", "").alias("line")).distinct().limit(2).collect()]
    if len(heads) != 1:
        raise ContractError("no header line" if not heads else "files have different headers")
    names = spark.createDataFrame([(heads[0],)], "line string").select(
        F.from_csv("line", F.schema_of_csv(F.lit(heads[0]), _OPTIONS), _OPTIONS).alias("r")).select("r.*").first()
    names = [str(x) for x in names]
    if len(set(names)) != len(names):
        raise ContractError(f"header names repeat: {names}")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    # a generated row is parsed once: filters on its fields stay above it and do not repeat the parsing
    parsed = rows.where(~F.col("first")).select(F.inline(F.array(F.from_csv("text", schema, _OPTIONS))))
    return check_contract(parsed.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names))),
                          require_rows=require_rows)


#: As the whole-file reader: strict, quotes doubled inside quotes, line ends kept inside quotes.
_OPTIONS = {"escape": '"', "quote": '"', "multiLine": "true", "mode": "FAILFAST", "inferSchema": "false"}
