"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of every text: h = (h << 1) + G[byte], kept to 32 bits, so it
depends on the last 32 bytes only. Where its top ``CUT_BITS`` bits are zero a chunk ends (not
below ``MIN_CHUNK`` bytes; at ``MAX_CHUNK`` it ends anyway), so an insertion moves the cuts
near it and no others. Chunks are compared by a 128-bit digest. Of the occurrences of one chunk
the first is kept (smallest document id, then row, then position), and later ones are removed
when the run of repeated chunks around them has ``MIN_RUN`` bytes or is the whole document, however
short: chance repeats of a few common words inside a text stay. The rest of the document is kept.

Null and empty texts have no chunks. Repeated rows and rows with equal or null ids are documents of
their own (null ids come last). An empty table gives an empty result; extra columns are
ignored by ``find`` and kept by ``remove``.

Scale: the largest data is one narrow row per chunk. Digests are counted with a partial sum
per task, so a chunk that a third of all documents share is one row per task; its occurrences
are joined back by a sort-merge join, which splits a hot digest. No text is shuffled while the
list of spans is short enough to broadcast (counted first).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.llm.common import (
    U64,
    append_columns,
    as_long,
    byte_sums,
    cut,
    id_text,
    join_keys,
    materialize,
    merge_spans,
    mix,
    neutral,
    range_hashes,
    with_row_key,
)

CUT_BITS = 5
MIN_CHUNK, MAX_CHUNK = 16, 256
MIN_RUN = 32

_GEAR = (mix(np.arange(1000, 1256, dtype=U64)) >> U64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling gear hash after every byte; window sums double from 1 to 32 bytes."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
    return h


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """End positions of the chunks of one text; the last is its length."""
    n = len(data)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    ends, start = [], 0
    for c in (np.flatnonzero(gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        while c - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start)
        if c - start >= MIN_CHUNK:
            ends.append(c)
            start = c
    while n - start > MAX_CHUNK:
        start += MAX_CHUNK
        ends.append(start)
    if start < n:
        ends.append(n)
    return np.array(ends, dtype=np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d1, d2, row, start, length, last) of every chunk; ``last`` ends its text."""
    names = ["d1", "d2", "row", "start", "length", "last"]
    out: list[tuple] = []
    held = 0

    def batch():
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    for b in batches:
        for row, text in zip(b.column("_row").to_pylist(), b.column("text").to_pylist(), strict=True):
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
            ends = chunk_ends(data)
            if not len(ends):
                continue
            starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
            d1 = range_hashes(byte_sums(data), starts, ends)
            d2 = range_hashes(byte_sums(data ^ np.uint8(0x5A)), starts, ends)
            out.append((as_long(d1), as_long(d2), np.full(len(ends), row, np.int64), starts.astype(np.int32),
                        (ends - starts).astype(np.int32), ends == len(data)))
            held += len(ends)
            if held > 100_000:
                yield batch()
                out, held = [], 0
    if held:
        yield batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d1, n) of the chunks of a batch, equal ones added up."""
    for b in batches:
        found = [np.empty(0, np.int64)]
        for text in b.column("text").to_pylist():
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
            ends = chunk_ends(data)
            if len(ends):
                starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
                found.append(as_long(range_hashes(byte_sums(data), starts, ends)))
        d, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(n.astype(np.int64))], names=["d1", "n"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A document's repeated chunks to its removed spans and its repeated bytes."""
    for b in batches:
        rows, spans, repeated = [], [], []
        for row, found in zip(b.column("row").to_pylist(), b.column("found").to_pylist(), strict=True):
            found = sorted((f["start"], f["length"], f["first"], f["last"]) for f in found)
            total, later, run, ended = 0, [], [], False
            for start, length, first, last in [*found, (-1, 0, True, False)]:
                if run and run[-1][1] != start:
                    size = run[-1][1] - run[0][0]
                    if size >= MIN_RUN or run[0][0] == 0 and ended:  # long enough, or the whole document
                        total += size
                        later += [(x, y) for x, y, f in run if not f]
                    run = []
                run.append((start, start + length, first))
                ended = last
            if total:
                rows.append(row)
                repeated.append(total)
                spans.append([{"start": x, "end": y} for x, y in merge_spans(later)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(spans, kind), pa.array(repeated, pa.int64())],
                                         names=["row", "spans", "repeated"])


def find_spans(rows: DataFrame) -> DataFrame:
    """Written rows (_row, doc_id, text) to (row, spans, repeated) of documents with repeats."""
    chunks = rows.select("_row", "text").mapInArrow(_chunks, "d1 long, d2 long, row long, start int, length int, last boolean")
    # written, so that the join below stands on plain exchanges and a hot digest is split
    again = materialize(rows.select("text").mapInArrow(_digests, "d1 long, n long").groupBy("d1")
                        .agg(F.sum("n").alias("n")).where("n > 1").select("d1"), "repeated-digests")
    shared = materialize(chunks.join(again, "d1", "left_semi"), "shared-chunks")
    ids = rows.select(F.col("_row").alias("row"), F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id").alias("id"))
    order = F.struct("id", "row", "start")
    first = (shared.join(ids, "row").groupBy("d1", "d2").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("d1", "d2", "first"))
    first = materialize(first, "first-chunks")
    found = (shared.join(first, ["d1", "d2"])
             .select("row", F.struct("start", "length", ((F.col("row") == F.col("first.row"))
                                     & (F.col("start") == F.col("first.start"))).alias("first"), "last").alias("f")))
    # one value per document, at most its own chunks
    return materialize(found.groupBy("row").agg(F.collect_list("f").alias("found"))
                       .mapInArrow(_runs, "row long, spans array<struct<start:long,end:long>>, repeated long"), "spans")


def _joined(rows: DataFrame) -> DataFrame:
    spans = find_spans(rows).withColumnRenamed("row", "_row").withColumnRenamed("spans", "_spans") \
        .withColumnRenamed("repeated", "_repeated")
    return join_keys(rows, spans, "_row", "left", F.size("_spans"))


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with later copies of repeated passages cut from ``text``; all columns stay.

    Cuts fall between bytes, so a code point that is cut through is replaced by U+FFFD.
    """
    docs, names = neutral(docs)
    rows = with_row_key(docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))))
    both = _joined(rows).withColumn("_in", F.struct("text", "_spans"))

    def compute(values: list) -> list:
        return [[cut(v["text"].encode(), [(s["start"], s["end"]) for s in v["_spans"] or []]).decode("utf-8", "replace")
                 for v in values]]

    out = append_columns(both, "_in", T.StructType([T.StructField("_kept", T.StringType())]), compute)
    return out.withColumn("text", F.col("_kept")).select(*docs.columns).toDF(*names)


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_repeated (bytes in repeated runs, first copies included),
    n_removed, n_spans, kept_sha256 of the remaining bytes."""
    both = _joined(with_row_key(id_text(docs)))
    return span_report(both, "_spans").select("doc_id", "n_bytes", F.coalesce("_repeated", F.lit(0)).alias("n_repeated"),
                                              "n_removed", "n_spans", "kept_sha256")


def span_report(rows: DataFrame, spans: str) -> DataFrame:
    """``rows`` with n_bytes, n_removed, n_spans and kept_sha256 of ``text`` without ``spans``.

    Each text goes to Python once and does not come back: ``text`` and ``spans`` are dropped.
    """
    fields = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def compute(values: list) -> list:
        out = []
        for v in values:
            data = v["text"].encode("utf-8", "surrogatepass")
            gone = [(s["start"], s["end"]) for s in v[spans] or []]
            out.append((len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(cut(data, gone)).hexdigest()))
        return [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in fields]

    inputs = rows.select(*(c for c in rows.columns if c not in ("text", spans)), F.struct("text", spans).alias("_in"))
    return append_columns(inputs, "_in", fields, compute, keep_source=False)
