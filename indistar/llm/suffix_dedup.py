"""Suffix dedup: remove every byte covered by a 400-byte string that starts anywhere else too.

The suffix order comes from column-wise construction of a collection's Burrows-Wheeler
transform and common prefixes: every round puts one more symbol in front of each string of the
collection and inserts the new suffixes into both sequences (:func:`insert_columns`). Rounds cost as
much as all symbols so far, so the collection is first cut into small independent ones:

1. *Cores.* With B starts to a block, every window of W = 400 bytes holds B cores of
   W - B + 1 bytes. The one of least hash (leftmost of equals) is the window's core. Equal
   windows have equal cores at equal places, so only occurrences of the same core can hold equal windows.
   Runs of windows that have the same core occurrence make one *context*: up to B - 1 bytes
   before the core, the core, up to B - 1 bytes after it.
2. *Repeated cores* are found by counting core hashes; everything else has no copy.
3. *Equal contexts* are stored once with their number; two or more make all their windows
   repeated.
4. *Different contexts of one core* are a collection. The core becomes one symbol, and what the
   contexts have in common next to it joins the core. In the collection's suffix order a window
   is repeated when its suffix and a neighbour have enough symbols in common. This gives the
   edges of repeats exactly, to the byte.
5. The windows' spans are united per document.

A collection larger than ``LARGEST`` strings is split: the starts of its contexts are halved,
which lengthens the core, and contexts regroup by the longer core; at one start per context the
core is the window itself and nothing remains to compare. So no core, however common, meets in
one task. What the method's original keeps in sequential external files here lies in the
tables between the steps (written to the shared folder) and in arrays bounded by a batch.

Null and empty texts have no bytes. Repeated rows are documents of their own, so their copies
count. An empty table gives an empty result; extra columns are ignored. Cores are identified
by 128 bits of hash, contexts by their core and 64 more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.chunk_dedup import span_report
from indistar.llm.common import (
    as_long,
    byte_sums,
    id_text,
    join_keys,
    materialize,
    mix,
    powers,
    range_hashes,
    with_row_key,
)

WIDTH = 400
BLOCK = 96
CORE = WIDTH - BLOCK + 1
LARGEST = 4096
#: Strings that one collection of several cores holds at about.
BATCH = 1500
#: Windows of a text that are hashed in one go; memory is about 100 bytes for each.
PIECE = 1 << 17
#: Contexts that a task gathers before it passes them on.
HELD = 20_000

ANCHOR_FIELDS = "h long, h2 long, context long, row long, lo long, n int, off int"


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value of every run of ``width`` values.

    Values count by their upper 32 bits, of equals the leftmost; the position rides in the lower 32.
    """
    n = len(x) - width + 1
    low = np.uint64(0xFFFFFFFF)
    y = np.full(len(x) + (-len(x) % width), np.uint64(0xFFFFFFFFFFFFFFFF))
    y[:len(x)] = (x & ~low) | np.arange(len(x), dtype=np.uint64)
    y = y.reshape(-1, width)
    left = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()  # from a place to its block's end
    right = np.minimum.accumulate(y, axis=1).ravel()  # from its block's start to a place
    return (np.minimum(left[:n], right[width - 1:width - 1 + n]) & low).astype(np.int64)


def pieces(text: pa.Scalar) -> Iterator[tuple[int, np.ndarray]]:
    """(first byte, bytes) of a text's pieces, which share no window of 400 bytes and together hold all.

    A context that lies across the end of a piece becomes two of the same core with windows of
    their own; neither holds the other's windows, so no window meets itself.
    """
    data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
    for at in range(0, len(data) - WIDTH + 1, PIECE):
        yield at, data[at:at + PIECE + WIDTH - 1]


def cores(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(prefix sums, core hashes, first starts, last starts, core positions) of a piece's contexts."""
    sums = byte_sums(data)
    n = len(data) - CORE + 1
    h = mix((sums[CORE:] - sums[:n]) * powers(n)[1] + np.uint64(CORE))
    core = window_minima(h, BLOCK)
    lo = np.concatenate([np.zeros(1, np.int64), np.flatnonzero(core[1:] != core[:-1]) + 1])
    hi = np.concatenate([lo[1:] - 1, [len(core) - 1]])
    p = core[lo]
    return sums, as_long(h[p]), lo, hi, p


def contexts(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(h, h2, context hash, first start, starts, core's offset) of a piece's contexts."""
    sums, h, lo, hi, p = cores(data)
    other = byte_sums(data ^ np.uint8(0x5A))
    return (h, as_long(range_hashes(other, p, p + CORE)), as_long(range_hashes(sums, lo, hi + WIDTH)), lo,
            (hi - lo + 1).astype(np.int32), (p - lo).astype(np.int32))


def _core_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, n) of the cores of a batch, equal ones added up."""
    for b in batches:
        found = [cores(data)[1] for t in b.column("text") for _, data in pieces(t)]
        h, n = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in ANCHOR_FIELDS.split(", ")]
    out, held = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)

    for b in batches:
        for row, text in zip(b.column("_row").to_pylist(), b.column("text"), strict=True):
            for at, data in pieces(text):
                h, h2, c, lo, n, off = contexts(data)
                out.append((h, h2, c, np.full(len(h), row, np.int64), lo.astype(np.int64) + at, n, off))
                held += len(h)
                if held > HELD:
                    yield batch()
                    out, held = [], 0
    if held:
        yield batch()


def insert_columns(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of a collection by inserting one symbol per string and round.

    ``strings`` hold symbols 1..65535. Returns, row by row of the sorted suffixes, the string
    and the length of the suffix, and the symbols it has in common with the row before.
    Equal suffixes are in order of their strings; no suffix equals the end of another beyond it.
    """
    m = len(strings)
    size = np.array([len(s) for s in strings], dtype=np.int64)
    end = np.cumsum(size)
    flat = np.concatenate(strings).astype(np.uint16)
    bwt = flat[end - 1]  # the empty suffixes, each preceded by its string's last symbol
    common = np.zeros(m + 1, dtype=np.int32)  # one more, for ranges that end at the end
    owner, length = np.arange(m, dtype=np.int32), np.zeros(m, dtype=np.int32)
    active, at, done = np.arange(m), np.arange(m), 0
    while len(active):
        done += 1
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(len(bwt), dtype=np.int64)
        rank[order] = np.arange(len(bwt))
        ended = int(np.count_nonzero(bwt == 0))
        k = rank[at]
        new = m + k - ended  # rows of the inserted suffixes after the insertion
        # common prefixes with the neighbours that start with the same symbol: 1 + a range's least
        lcp_new = np.zeros(len(active), dtype=np.int32)
        prev = order[np.maximum(k - 1, 0)]
        same = (k > 0) & (bwt[prev] == bwt[at])
        lcp_new[same] = 1 + _least(common, prev[same] + 1, at[same] + 1)
        nxt = order[np.minimum(k + 1, len(order) - 1)]
        follows = (k + 1 < len(order)) & (bwt[nxt] == bwt[at])
        lcp_next = 1 + _least(common, at[follows] + 1, nxt[follows] + 1)

        total = len(bwt) + len(active)
        old = np.ones(total, dtype=bool)
        old[new] = False
        left = size[active] - done
        before = np.where(left > 0, flat[np.maximum(end[active] - 1 - done, 0)], 0).astype(np.uint16)
        bwt = _spread(bwt, old, new, before)
        common = np.concatenate([_spread(common[:-1], old, new, lcp_new), [0]]).astype(np.int32)
        common[new[follows] + 1] = lcp_next
        owner = _spread(owner, old, new, active.astype(np.int32))
        length = _spread(length, old, new, np.full(len(active), done, dtype=np.int32))
        goes_on = left > 0
        active, at = active[goes_on], new[goes_on]
    return owner, length, common[:-1]


def _least(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of x[lo:hi] for every pair (none empty)."""
    if not len(lo):
        return np.empty(0, dtype=x.dtype)
    order = np.argsort(lo, kind="stable")
    ends = np.empty(2 * len(lo), dtype=np.int64)
    ends[0::2], ends[1::2] = lo[order], hi[order]
    out = np.empty(len(lo), dtype=x.dtype)
    out[order] = np.minimum.reduceat(x, ends)[0::2]
    return out


def _spread(x: np.ndarray, old: np.ndarray, new: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty(len(old), dtype=x.dtype)
    out[old] = x
    out[new] = values
    return out


def repeated_starts(groups: list[list[tuple[bytes, bytes]]], block: list[int]) -> list[list[np.ndarray]]:
    """For groups of contexts (bytes before and after a shared core), the repeated windows.

    ``block`` is each group's B: a window with a bytes before the core has B - 1 - a after it.
    Per context a boolean per start, the first start being the one with all bytes before.
    Contexts of a group differ, so each group has two at least.
    """
    strings, where = [], []
    for g, group in enumerate(groups):
        lefts, rights = [x[::-1] for x, _ in group], [y for _, y in group]
        skip_l, skip_r = _shared(lefts), _shared(rights)
        for i, (x, y) in enumerate(group):
            left = np.frombuffer(x[:len(x) - skip_l], dtype=np.uint8).astype(np.uint16) + 1
            right = np.frombuffer(y[skip_r:], dtype=np.uint8).astype(np.uint16) + 1
            strings.append(np.concatenate([left, [257 + g], right]))
            where.append((g, i, len(left), skip_l, skip_r))
    owner, length, common = insert_columns(strings)
    near = np.maximum(common, np.append(common[1:], 0))
    longest = max(map(len, strings))
    table = np.zeros((len(strings), longest + 1), dtype=np.int32)
    table[owner, length] = near
    out: list[list[np.ndarray]] = [[None] * len(g) for g in groups]
    for s, (g, i, left, skip_l, skip_r) in enumerate(where):
        x, y = groups[g][i]
        a = len(x) - np.arange(_starts(len(x), len(y), block[g]))  # bytes before the core, by start
        own = np.minimum(np.maximum(a - skip_l, 0), left)
        wanted = own + 1 + np.maximum(block[g] - 1 - a - skip_r, 0)
        out[g][i] = table[s, len(strings[s]) - left + own] >= wanted
    return out


def _starts(left: int, right: int, block: int) -> int:
    """Windows of a context: from a = left down to a = block - 1 - right."""
    return left + right - block + 2


def _shared(texts: list[bytes]) -> int:
    a, b = min(texts), max(texts)
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted contexts) to one row per context with the bytes on its core's sides."""
    for b in batches:
        out = []
        for row, text, wanted in zip(b.column("_row").to_pylist(), b.column("text"), b.column("wanted"), strict=True):
            data = text.as_buffer().to_pybytes()
            for w in wanted.as_py():
                p = w["lo"] + w["off"]
                out.append((w["h"], w["h2"], w["copies"], row, w["lo"], data[w["lo"]:p],
                            data[p + CORE:w["lo"] + w["n"] - 1 + WIDTH]))
                if len(out) > HELD:
                    yield _side_batch(out)
                    out = []
        yield _side_batch(out)


SIDE_FIELDS = "h long, h2 long, copies long, row long, lo long, before binary, after binary, block int"


def _side_batch(rows: list[tuple], block: int = BLOCK) -> pa.RecordBatch:
    types = [pa.int64()] * 5 + [pa.binary()] * 2 + [pa.int32()]
    rows = [r if len(r) == 8 else (*r, block) for r in rows]
    cols = list(zip(*rows, strict=True)) if rows else [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                                      names=[f.split()[0] for f in SIDE_FIELDS.split(", ")])


def _halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of a too large group, to two contexts of half the starts and a longer core.

    Starts a >= half keep ``half`` more bytes before the core in the new core; starts
    a < half keep block - half more after it. Both halves' B is smaller accordingly.
    """
    names = [f.split()[0] for f in SIDE_FIELDS.split(", ")]
    for b in batches:
        out = []
        for h, h2, copies, row, lo, x, y, block in zip(*(b.column(c).to_pylist() for c in names), strict=True):
            half = block // 2
            least = max(0, block - 1 - len(y))  # smallest a of this context
            for part, a_lo, a_hi in ((0, 0, half - 1), (1, half, block - 1)):
                a0, a1 = max(a_lo, least), min(a_hi, len(x))
                if a0 > a1:
                    continue
                # the new core takes a_lo bytes before and block - 1 - a_hi bytes after
                inner_l, inner_r = x[len(x) - a_lo:], y[:block - 1 - a_hi]
                left, right = x[len(x) - a1:len(x) - a_lo], y[block - 1 - a_hi:block - 1 - a0]
                data = np.frombuffer(bytes([part]) + inner_l + b"\\x00" + inner_r, dtype=np.uint8)
                ends = np.array([len(data)]), np.array([0])
                k1 = int(as_long(range_hashes(byte_sums(data), ends[1], ends[0]))[0])
                k2 = int(as_long(range_hashes(byte_sums(data ^ np.uint8(0x5A)), ends[1], ends[0]))[0])
                out.append((_fold(h, k1), _fold(h2, k2), copies, row, lo + len(x) - a1, left, right, a_hi - a_lo + 1))
        yield _side_batch(out)


def _fold(a: int, b: int) -> int:
    """Two hashes to one, in the range of a long."""
    x = np.array([a, b], dtype=np.int64).view(np.uint64)
    return int(as_long(range_hashes(byte_sums(x.view(np.uint8)), np.array([0]), np.array([16])))[0])


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by core, to the repeated spans (row, start, end) of single contexts."""
    names = [f.split()[0] for f in SIDE_FIELDS.split(", ")]

    def groups():
        key, group = None, []
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                if r[:2] != key:
                    if group:
                        yield group
                    key, group = r[:2], []
                group.append(r)
        if group:
            yield group

    def solve(held):
        # equal contexts may meet again after halving: they are copies of each other
        out, todo = [], []
        for group in held:
            by: dict[tuple[bytes, bytes], list] = {}
            for r in group:
                by.setdefault((r[5], r[6]), []).append(r)
            for (x, y), rows in by.items():
                if len(rows) > 1:
                    n = _starts(len(x), len(y), rows[0][7])
                    out += [(r[3], r[4], r[4] + n - 1 + WIDTH) for r in rows]
            if len(by) > 1:
                todo.append(by)
        if todo:
            found = repeated_starts([list(by) for by in todo], [next(iter(by.values()))[0][7] for by in todo])
            for by, flags in zip(todo, found, strict=True):
                for rows, flag in zip(by.values(), flags, strict=True):
                    if len(rows) == 1 and rows[0][2] == 1:
                        edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])))
                        out += [(rows[0][3], rows[0][4] + int(a), rows[0][4] + int(b) - 1 + WIDTH)
                                for a, b in zip(edge[::2], edge[1::2], strict=True)]
        cols = list(zip(*out, strict=True)) if out else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=["row", "start", "end"])

    held, n = [], 0
    for g in groups():
        held.append(g)
        n += len(g)
        if n >= BATCH:
            yield solve(held)
            held, n = [], 0
    if held:
        yield solve(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, found spans) to the rows' maximal spans, all rows of a batch at once.

    Every row's bytes get a range of their own, of 2**40, so that spans of two rows never touch.
    """
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for b in batches:
        found = b.column("found")
        base = np.arange(len(b), dtype=np.int64) << 40
        shift = np.repeat(base, np.diff(found.offsets.to_numpy()))
        start, end = (found.flatten().field(i).to_numpy() + shift for i in range(2))
        order = np.argsort(start, kind="stable")
        start, end = start[order], np.maximum.accumulate(end[order])
        first = np.concatenate([np.ones(min(1, len(start)), dtype=bool), start[1:] > end[:-1]])
        start, end = start[first], end[np.concatenate([first[1:], first[:1]])]
        cuts = np.searchsorted(start, np.append(base, len(b) << 40)).astype(np.int32)
        low = (1 << 40) - 1
        spans = pa.StructArray.from_arrays([pa.array(start & low), pa.array(end & low)], fields=list(kind))
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.ListArray.from_arrays(pa.array(cuts), spans)],
                                         names=["_row", "_spans"])


def find_spans(rows: DataFrame) -> DataFrame:
    """Written rows (_row, text) to (_row, _spans): the maximal repeated byte runs."""
    anchors = rows.select("_row", "text").mapInArrow(_anchors, ANCHOR_FIELDS)
    # written, so that the join below stands on plain exchanges and a hot core is split
    again = materialize(rows.select("text").mapInArrow(_core_hashes, "h long, n long").groupBy("h")
                        .agg(F.sum("n").alias("k")).where("k > 1").select("h"), "repeated-cores")
    shared = materialize(anchors.join(again, "h", "left_semi"), "shared-cores")
    key = ["h", "h2", "context", "n", "off"]
    kinds = materialize(shared.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "lo")).alias("one")),
                        "contexts")
    copied = shared.join(kinds.where("copies > 1").select(*key), key, "left_semi") \
        .select("row", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + WIDTH).alias("end"))

    several = kinds.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h", "h2")
    several = materialize(several, "shared-by-several")
    one = kinds.join(several, ["h", "h2"], "left_semi").select("h", "h2", "copies", "one.row", "one.lo", "n", "off")
    wanted = materialize(one.groupBy(F.col("row").alias("_row"))
                         .agg(F.collect_list(F.struct("h", "h2", "copies", "lo", "n", "off")).alias("wanted")), "wanted")
    sides = materialize(join_keys(rows.select("_row", "text"), wanted, "_row", "inner", F.size("wanted"))
                        .mapInArrow(_sides, SIDE_FIELDS), "sides")
    found = []
    for _ in range(BLOCK.bit_length()):
        sizes = materialize(sides.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > LARGEST)
                            .select("h", "h2"), "large-groups")
        if sizes.isEmpty():
            break
        small = sides.join(sizes, ["h", "h2"], "left_anti")
        sides = materialize(small.unionByName(sides.join(sizes, ["h", "h2"], "left_semi").mapInArrow(_halve, SIDE_FIELDS)),
                            "halved")
    # a lone context has nothing to meet; what is still large are equal windows, told by their number
    counted = sides.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("k"))
    large = materialize(counted.where(F.col("k") > LARGEST).select("h", "h2"), "equal-windows")
    if not large.isEmpty():
        found.append(sides.join(large, ["h", "h2"], "left_semi")
                     .select("row", F.col("lo").alias("start"), (F.col("lo") + WIDTH).alias("end")))
    meet = sides.join(counted.where((F.col("k") > 1) & (F.col("k") <= LARGEST)).select("h", "h2"), ["h", "h2"], "left_semi")
    edges = meet.repartition("h", "h2").sortWithinPartitions("h", "h2").mapInArrow(_collections, "row long, start long, end long")
    spans = copied.unionByName(edges)
    for f in found:
        spans = spans.unionByName(f)
    # one value per document, in proportion to its length
    return materialize(spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("found"))
                       .mapInArrow(_merge, "_row long, _spans array<struct<start:long,end:long>>"), "spans")


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes, n_repeated.

    ``n_repeated`` counts the bytes that repeated strings cover; here all of them are removed.
    """
    rows = with_row_key(id_text(docs))
    return span_report(join_keys(rows, find_spans(rows), "_row", "left", F.size("_spans")), "_spans") \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("n_removed").alias("n_repeated"))
