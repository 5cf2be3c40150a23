"""Packing documents into training sequences by cutting-stock column generation.

A document is its token ids and an end id. Its whole ``LENGTH``-token blocks are sequences of
their own; what is left, shorter than that, is the stock to pack:

1. *Histogram.* Remainders are counted by length class (``GRID`` tokens wide, rounded up), so the
   driver sees one count per class, however many documents there are.
2. *Column generation.* A pattern says how many pieces of each class a sequence holds. A linear
   program over patterns covers the histogram with the fewest sequences: its duals price the
   classes, a knapsack dynamic program finds the pattern worth most, and the simplex step
   takes it in, until no pattern is worth more than a sequence (within ``TOLERANCE``).
3. *Rounding.* Pattern counts are rounded down, and the emptiest patterns lose sequences until the
   rest, filled to the brim, hold no more tokens than there are.
4. *Assignment.* Remainders are ranked within their class; the rank and the (small, bounded) table
   of patterns give a remainder's sequence and place in it, without looking at other documents.
5. *Filling up.* Remainders beyond the patterns' places, whole classes' leftovers and a few percent
   of the others, form one stream of tokens that is cut to fill the gaps of the sequences exactly,
   then further sequences, at last sequences of decreasing powers of two.

So there is no padding at all, and only documents longer than a sequence and those of the stream
are cut. Ranks, gaps and stream places are positions and running sums over range
partitions (:mod:`~indistar.llm.ranks`), also when all documents have one length. Token ids are
written once, compressed, and joined once with the plan by row.

Nulls: a null text is empty, and a document without text is the end id alone; ids may be null or
repeated (every row is packed). Very long texts are encoded whole; their blocks are written one by one.
The order of equal lengths is that of the rows' places in the input. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indistar.llm.common import id_text, materialize
from indistar.llm.ranks import positions, running_sum
from indistar.llm.tokens import Memo, WordEndEncoder, groups, units

#: Tokens of a sequence, and of a class of lengths (a divisor of it).
LENGTH, GRID = 4096, 32
#: The linear program ends when the best pattern is worth so little more than a sequence.
TOLERANCE = 1e-4
#: Bytes of ids given back in one batch.
BATCH_BYTES = 8 << 20


# ------------------------------------------------------------------ cutting stock

def best_pattern(worth: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of ``sizes`` within ``capacity`` that is worth most: (worth, counts)."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        if fits[c]:
            with_ = value[c - sizes[:fits[c]]] + worth[:fits[c]]
            k = int(with_.argmax())
            if with_[k] > value[c]:
                value[c], last[c] = with_[k], k
    counts, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(value[capacity]), counts


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                  tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns over ``sizes``, ascending) and their rates, covering ``demand`` exactly.

    Rates are those of a basic solution of the linear program: as many patterns as sizes at most.
    """
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse, rate = np.diag(1.0 / np.diag(basis)), demand / np.diag(basis)
    for step in range(50 * m + 50):
        if step % 100 == 99:
            inverse = np.linalg.inv(basis)
            rate = np.maximum(inverse @ demand, 0.0)
        worth, column = best_pattern(np.maximum(inverse.sum(axis=0), 0.0), sizes, capacity)
        if worth <= 1.0 + tolerance:
            break
        change = inverse @ column
        able = np.flatnonzero(change > 1e-9)
        out = able[np.argmin(rate[able] / change[able])]
        enters = rate[out] / change[out]
        rate = np.maximum(rate - enters * change, 0.0)
        rate[out] = enters
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
        basis[:, out] = column
    return basis, rate


@dataclass
class Plan:
    """``sequences`` numbered from 0 and, for every run of equal places, the row
    (class, first rank, end rank, pieces of the class in the pattern, first sequence, first place)."""

    sequences: int
    places: list[tuple[int, int, int, int, int, int]]


def plan(counts: dict[int, int], tokens: int, length: int = LENGTH, grid: int = GRID) -> Plan:
    """Patterns for ``counts`` of remainders by class that hold ``tokens`` tokens in all."""
    sizes = np.array(sorted(counts), dtype=np.int64)
    if not len(sizes):
        return Plan(0, [])
    demand = np.array([counts[int(s)] for s in sizes], dtype=float)
    basis, rate = cutting_stock(sizes, demand, length // grid)
    whole = np.floor(rate + 1e-9).astype(np.int64)
    # the emptiest patterns go first, until what remains can be filled to the brim
    order = np.argsort(sizes @ basis, kind="stable")
    spare = int(whole.sum()) - tokens // length
    for j in order:
        if spare > 0:
            less = min(spare, int(whole[j]))
            whole[j] -= less
            spare -= less
    used, first, places = np.zeros(len(sizes), dtype=np.int64), 0, []
    for j in order[::-1]:
        if not whole[j]:
            continue
        place = 0
        for k in np.flatnonzero(basis[:, j])[::-1]:  # long pieces first
            each = round(basis[k, j])
            # rounding may leave the last ranks of a place without a document: then it is a gap
            end = int(used[k] + whole[j] * each)
            places.append((int(sizes[k]), int(used[k]), end, each, first, place))
            used[k], place = end, place + each
        first += int(whole[j])
    return Plan(first, places)


# ------------------------------------------------------------------ token ids

def _encode(path: str, end_id: int):
    """A mapInArrow function: (row, doc_id, text) to (row, doc_id, n, ids as compressed unsigned 32-bit)."""
    memo: list[Memo] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = IdCodec()
        if not memo:
            memo.append(Memo(units, WordEndEncoder(path)))
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in groups(texts):
                ids, at = memo[0].encode(texts[lo:hi])[0]
                rows = [codec.pack(np.append(ids[at[i]:at[i + 1]], end_id)) for i in range(hi - lo)]
                n = pa.array(np.diff(at) + 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(lo, hi - lo), b.column("doc_id").slice(lo, hi - lo), n, pa.array(rows, pa.binary())],
                    names=["row", "doc_id", "n", "ids"])
    return run


class IdCodec:
    """Ids as compressed unsigned 32-bit numbers; one per task, as its contexts are costly to make."""

    def __init__(self):
        import zstandard

        self.packer, self.unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

    def pack(self, ids: np.ndarray) -> bytes:
        # bytes of equal weight side by side: high ones are mostly zero
        planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
        return self.packer.compress(np.ascontiguousarray(planes).tobytes())

    def unpack(self, data: bytes) -> bytes:
        planes = np.frombuffer(self.unpacker.decompress(data), dtype=np.uint8).reshape(4, -1)
        return np.ascontiguousarray(planes.T).tobytes()


def encode(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Written rows, by a vocabulary with word ends that drops white space: row (a key), doc_id, n tokens with the end id, compressed ids."""
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text")
    return materialize(rows.mapInArrow(_encode(path, end_id), "row long, doc_id long, n long, ids binary"), "token-ids")


# ------------------------------------------------------------------ assignment

def _assigned(rest: DataFrame, p: Plan) -> DataFrame:
    """Remainders with sequence and place, null for those of the stream; written."""
    spark = rest.sparkSession
    table = spark.createDataFrame(p.places, "class long, lo long, hi long, each long, first long, place0 long")
    ranked = positions(rest, "class", ["rem", "row"])
    # one entry per class of each pattern: bounded by the grid, whatever the input
    hit = (F.col("r.class") == F.col("t.class")) & (F.col("pos") >= F.col("lo")) & (F.col("pos") < F.col("hi"))
    k = F.col("pos") - F.col("lo")
    return materialize(
        ranked.alias("r").join(F.broadcast(table.alias("t")), hit, "left")
        .select("row", "start", "rem", (F.col("first") + F.floor(k / F.col("each"))).cast("long").alias("seq"),
                (F.col("place0") + k % F.col("each")).alias("place")), "packed-rests")


def _tail(first: int, start: int, tokens: int, length: int) -> list[tuple[int, int, int]]:
    """(sequence, start, length) of sequences of decreasing powers of two for the last tokens."""
    out, size = [], length
    while tokens:
        if size <= tokens:
            out.append((first + len(out), start, size))
            start, tokens = start + size, tokens - size
        else:
            size //= 2
    return out


def _overlaps(gaps: DataFrame, stream: DataFrame, length: int) -> DataFrame:
    """Pieces (row, start, length, seq, offset) where the gaps' and the stream's intervals meet.

    gaps: seq, used, size, at; stream: row, start, rem, at. Both cover the same range of places
    without holes. Intervals are cut at multiples of ``length``, so a block holds ``length``
    boundaries of either kind at most and is swept in order of place.
    """
    def cut(rows: DataFrame, size: str, what) -> DataFrame:
        blocks = F.sequence(F.floor(F.col("at") / length), F.floor((F.col("at") + F.col(size) - 1) / length))
        return (rows.withColumn("block", F.explode(blocks))
                .select("block", F.greatest(F.col("at"), F.col("block") * length).alias("x"), *what))

    gap = F.struct("seq", (F.col("used") - F.col("at")).alias("shift"))
    doc = F.struct("row", (F.col("start") - F.col("at")).alias("shift"))
    none = lambda s: F.lit(None).cast(s)
    marks = cut(gaps, "size", [gap.alias("gap"), none("struct<row:bigint,shift:bigint>").alias("doc")]).unionByName(
        cut(stream, "rem", [none("struct<seq:bigint,shift:bigint>").alias("gap"), doc.alias("doc")]))
    at_x = marks.groupBy("block", "x").agg(F.max("gap").alias("gap"), F.max("doc").alias("doc"))
    w = Window.partitionBy("block").orderBy("x")
    swept = at_x.select("x", F.last("gap", ignorenulls=True).over(w).alias("g"),
                        F.last("doc", ignorenulls=True).over(w).alias("d"),
                        F.lead("x").over(w).alias("next"), ((F.col("block") + 1) * length).alias("edge"))
    # the last interval ends where both do; gaps carry their end there
    return swept.select(F.col("d.row").alias("row"), (F.col("x") + F.col("d.shift")).alias("start"),
                        F.col("g.seq").alias("seq"), (F.col("x") + F.col("g.shift")).alias("offset"),
                        "x", F.coalesce("next", "edge").alias("end"))


def _pieces(ids: DataFrame, length: int, grid: int) -> DataFrame:
    """All pieces: row, start, length, seq, offset."""
    spark = ids.sparkSession
    rows = ids.select("row", "n", F.floor(F.col("n") / length).cast("long").alias("blocks"))
    start = F.col("blocks") * length
    rest = materialize(rows.where(F.col("n") > start).select(
        "row", start.alias("start"), (F.col("n") - start).alias("rem"),
        F.ceil((F.col("n") - start) / grid).cast("long").alias("class")), "rests")
    per_class = {r["class"]: r for r in rest.groupBy("class").agg(F.count(F.lit(1)).alias("c"), F.sum("rem").alias("t"))
                 .collect()}  # one row per class: length / grid at most
    tokens = sum(r["t"] for r in per_class.values())
    p = plan({k: r["c"] for k, r in per_class.items()}, tokens, length, grid)

    assigned = _assigned(rest, p)
    placed = assigned.where(F.col("seq").isNotNull())
    w = Window.partitionBy("seq").orderBy("place")
    packed = placed.select("row", "start", F.col("rem").alias("length"), "seq",
                           (F.sum("rem").over(w) - F.col("rem")).alias("offset"))

    # gaps of the patterns' sequences, then of further ones, up to the last token of the stream
    used = placed.groupBy("seq").agg(F.sum("rem").alias("used"))
    gaps = materialize(spark.range(p.sequences).select(F.col("id").alias("seq")).join(used, "seq", "left")
                       .select("seq", F.coalesce("used", F.lit(0).cast("long")).alias("used"))
                       .withColumn("size", length - F.col("used")).where("size > 0"), "gaps")
    stream = materialize(assigned.where(F.col("seq").isNull()).select("row", "start", "rem"), "stream")
    to_fill = gaps.agg(F.sum("size")).first()[0] or 0
    over = (stream.agg(F.sum("rem")).first()[0] or 0) - to_fill
    more = over // length
    tail = _tail(p.sequences + more, to_fill + more * length, over - more * length, length)
    opened = (running_sum(gaps, ["seq"], "size", "at").select("seq", "used", "size", "at")
              .unionByName(spark.range(more).select((F.col("id") + p.sequences).alias("seq"), F.lit(0).cast("long").alias("used"),
                                                    F.lit(length).cast("long").alias("size"),
                                                    (F.col("id") * length + to_fill).alias("at")))
              .unionByName(spark.createDataFrame([(s, 0, n, at) for s, at, n in tail],
                                                 "seq long, used long, size long, at long")))
    swept = _overlaps(opened, running_sum(stream, ["row"], "rem", "at"), length)
    end = F.least("end", F.lit(to_fill + over))
    filled = swept.select("row", "start", "seq", "offset", (end - F.col("x")).alias("length")).where("length > 0")
    # a piece cut at a block's edge only is one piece
    filled = filled.groupBy("row", "seq").agg(F.min("start").alias("start"), F.sum("length").alias("length"),
                                              F.min("offset").alias("offset"))

    first = p.sequences + more + len(tail)
    whole = materialize(rows.where("blocks > 0").select("row", "blocks"), "blocks")
    whole = (running_sum(whole, ["row"], "blocks", "before").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("row", (F.col("k") * length).alias("start"), F.lit(length).cast("long").alias("length"),
                     (F.col("before") + F.col("k") + first).alias("seq"), F.lit(0).cast("long").alias("offset")))
    names = ["row", "start", "length", "seq", "offset"]
    return packed.select(names).unionByName(filled.select(names)).unionByName(whole.select(names))


def _give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with compressed ids and their pieces, to one row per piece with its ids."""
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    out: list[list] = [[] for _ in names]
    codec, held = IdCodec(), 0
    for b in batches:
        flat = b.column("pieces").flatten()
        each = list(zip(*(flat.field(c).to_pylist() for c in ("start", "length", "seq", "offset")), strict=True))
        many = pc.list_value_length(b.column("pieces")).to_pylist()
        at = 0
        for doc_id, n, data, k in zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist(), b.column("ids"), many,
                                      strict=True):
            ids = codec.unpack(data.as_py())
            for start, length, seq, offset in each[at:at + k]:
                part = ids[4 * start:4 * (start + length)]
                for col, v in zip(out, (doc_id, start, length, part, n, seq, offset), strict=True):
                    col.append(v)
                held += len(part)
                if held > BATCH_BYTES:
                    yield _batch(out, names)
                    out, held = [[] for _ in names], 0
            at += k
    if out[0]:
        yield _batch(out, names)


def _batch(cols: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64())
                                       for c, n in zip(cols, names, strict=True)], names=names)


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, grid: int = GRID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers. ``length`` must be a power
    of two and ``grid`` divide it.
    """
    if length & (length - 1) or length % grid:
        raise ValueError("length must be a power of two, and a multiple of grid")
    ids = encode(docs, tokenizer, end_id)
    piece = F.struct("start", "length", "seq", "offset")
    by_row = _pieces(ids, length, grid).groupBy("row").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return ids.join(by_row, "row").select("doc_id", "n", "ids", "pieces").mapInArrow(
        _give, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
