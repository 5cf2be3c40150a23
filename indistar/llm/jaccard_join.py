"""N-gram Jaccard join by universe partition and pigeonhole.

A document's set is its distinct 5-word shingles; two documents link when
``100 * |X & Y| >= 80 * |X | Y|``. Links are found without comparing all pairs:

1. *Collapse.* Documents with equal sets are one node (identified by the sum of its mixed
   64-bit shingle hashes and its size).
2. *Size bands.* Linked sets differ in size by a factor of 1.25 at most, so with bands of
   that ratio the smaller set's band and the next hold both. A node joins the scheme of its
   own band and that of the band below.
3. *Universe partition.* Scheme b hashes every shingle into one of m segments. A linked pair
   of the scheme differs in at most H shingles, H = floor((|X| + |Y|) / 9) <= floor(hi / 4)
   for the band's largest smaller set hi. Segments are matched in one of two ways: *exact*
   (equal contents) or with *one-deletion neighbourhoods* (contents equal after deleting at
   most one shingle from one side). With e exact and d deletion segments and
   e + 2d >= H + 1, some segment must match: else there were e + 2d > H differences.
4. *Allocation by cost.* Per scheme, (e, d) is the cheapest way to reach the bound: a
   signature costs one row, and a segment that holds few shingles costs the chance
   candidates it makes. A scheme of exact segments has more than H + 1 of them, m, so a linked
   pair shares at least m - H buckets. Once the buckets' sizes are known, a node that shares
   fewer buckets than that is out, and one that shares c probes its c - (m - H) + 1 smallest
   ones only, of which at least one is shared with every linked node. Large buckets, as of
   segments that are empty or hold one common passage, are so joined last or never.
5. *Candidates and exact check.* In every bucket the nodes are first compared with the
   bucket's most connected node. What is then still in different components is compared pair by
   pair inside the tasks, a large bucket in tiles of two blocks, so that no task holds a whole
   bucket and only pairs that may link are written.
   A candidate pair counts only after the two whole shingle sets are intersected; pairs whose
   bit sketches already differ in more cells than linked sets may differ in are left out.

Null or empty texts have the empty set and link with nothing. With fewer than five words the
whole sequence is the one shingle. Repeated rows have equal sets, so they link. Rows with a
null id take part: their component's id is the smallest id in it, null if there is none. An
empty table gives an empty result; extra columns are ignored.

Scale: signatures are the largest data, about 0.5 per shingle of a distinct set, shuffled
once as two longs. Later steps read only the texts of listed nodes, told by a 64-bit key of the text.
Texts are never shuffled while that list is short enough to broadcast (counted first). A bucket is a sorted run of rows that Spark spills, never a list in a
task; comparisons with the bucket's leader are linear in its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from indistar.llm.common import (
    U64,
    append_columns,
    as_long,
    id_text,
    join_keys,
    materialize,
    mix,
    neutral,
    shingle_sets,
)
from indistar.llm.components import connected_components

SHINGLE = 5
#: Link when LINK_DEN * intersection >= LINK_NUM * union.
LINK_NUM, LINK_DEN = 80, 100
#: Neighbouring bands' ratio; linked sizes differ by no more.
BAND = LINK_DEN / LINK_NUM
#: Cost, in signature rows, of one chance candidate per thousand nodes.
CHANCE_COST = 400.0
#: Cells of a sketch. Sets differ in at least as many shingles as their sketches do in cells.
SKETCH_BITS = 1024
#: Nodes of a large bucket that one task compares with as many others at a time.
BLOCK = 4096
#: Tasks that share the tiles of the buckets with one least node, at most.
SPREAD = 16


def band_limits(top: int = 1 << 40) -> list[int]:
    """Smallest size of each band; hi of band b is one less than limit b + 1."""
    limits = [1]
    while limits[-1] < top:
        limits.append(max(limits[-1] + 1, ceil(limits[-1] * BAND)))
    return limits


LIMITS = np.array(band_limits(), dtype=np.int64)


def max_difference(band: int) -> int:
    """H: the most shingles in which a linked pair differs whose smaller set is in ``band``."""
    hi = int(LIMITS[band + 1]) - 1
    return (LINK_DEN - LINK_NUM) * (hi + LINK_DEN * hi // LINK_NUM) // (LINK_DEN + LINK_NUM)


_ALLOCATION: dict[int, tuple[int, int, int]] = {}


def allocation(band: int) -> tuple[int, int, int]:
    """(exact segments, deletion segments, buckets that a linked pair shares at least).

    Cost of a choice: rows that a typical node emits, plus the chance that a segment matches
    by holding next to nothing (Poisson, mean shingles per segment; a deletion segment
    compares contents with one shingle less) beyond what the spare segments make up for.
    """
    if band in _ALLOCATION:
        return _ALLOCATION[band]
    need, size = max_difference(band) + 1, int(LIMITS[band + 1]) - 1
    best = None
    for d in sorted({0, *range(1, min(ceil(need / 2), 8) + 1), ceil(need / 2)}):
        exact = max(0, need - 2 * d)
        for spare in {0} if d else {exact // 8, exact // 4, exact // 2}:
            e = exact + spare
            mean = size / (e + d)
            bare = exp(-mean) * (1 + mean)
            chance = exact * max(0.0, bare - spare / max(e, 1)) + d * (bare + exp(-mean) * mean * mean / 2)
            cost = e + d * (mean + 1) + CHANCE_COST * chance
            if best is None or cost < best[0]:
                best = (cost, e, d, spare + 1)
    _ALLOCATION[band] = best[1:]
    return _ALLOCATION[band]


def band_of(size: int) -> int:
    return int(np.searchsorted(LIMITS, size, side="right")) - 1


def _signatures(s: np.ndarray, band: int) -> np.ndarray:
    """Signatures of one set under one scheme."""
    e, d, _ = allocation(band)
    m = e + d
    salt = mix(np.array([band + 1], dtype=U64))[0]
    seg = ((mix(s ^ salt) >> U64(32)) * U64(m)) >> U64(32)
    order = np.argsort(seg, kind="stable")
    seg, val = seg[order].astype(np.int64), mix(s + salt)[order]
    sizes = np.bincount(seg, minlength=m)
    cums = np.concatenate([np.zeros(1, U64), np.cumsum(val, dtype=U64)])
    ends = np.cumsum(sizes)
    sums = cums[ends] - cums[ends - sizes]
    tag = mix(np.arange(m, dtype=U64) + salt)
    whole = mix(sums + tag) ^ salt
    if not d:
        return whole
    own = seg >= e
    return np.concatenate([whole, mix(sums[seg[own]] - val[own] + tag[seg[own]]) ^ salt])


def node_of(s: np.ndarray) -> int:
    """The node id of a set: sum of its mixed hashes bound to its size, even (0: empty set)."""
    if len(s) == 0:
        return 0
    h = mix(np.array([np.sum(mix(s)) + U64(len(s))], dtype=U64))
    return int(as_long(h)[0]) & ~1 or 2


#: Texts encoded, and sets gathered, at a time.
PART = 512


def _sets(texts: list | pa.Array) -> Iterator[np.ndarray]:
    """The texts' shingle sets in order; only some texts are held encoded."""
    for i in range(0, len(texts), PART):
        part = texts[i:i + PART]
        part = part.to_pylist() if isinstance(part, pa.Array) else part
        yield from shingle_sets([t.encode("utf-8", "surrogatepass") if t else b"" for t in part], SHINGLE)


def with_nodes(docs: DataFrame, n_col: str, node_col: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the set's size and node id appended; nothing is shuffled."""
    fields = T.StructType([T.StructField(n_col, T.LongType()), T.StructField(node_col, T.LongType())])

    def compute(texts: list) -> list:
        got = [(len(s), node_of(s)) for s in _sets(texts)]
        return [[g[0] for g in got], [g[1] for g in got]]

    return append_columns(docs, text, fields, compute, keep_text)


def _needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, size) to the buckets it must share: (node, lower, need), a row per scheme."""
    for b in batches:
        nodes, bands = b.column("node").to_pylist(), [band_of(n) for n in b.column("size").to_pylist()]
        own = [allocation(x)[2] for x in bands]
        below = [allocation(x - 1)[2] if x else 1 for x in bands]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes * 2, pa.int64()), pa.array([False] * len(nodes) + [True] * len(nodes)),
             pa.array(own + below, pa.int64())], names=["node", "lower", "need"])


#: Nodes or pairs that a task remembers having written; a forgotten one is written again, harmlessly.
REMEMBERED = 200_000


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, entry) rows of every distinct set; an entry is the node, plus 1 in the lower scheme."""
    seen: set[int] = set()

    def out(sigs, entries):
        return pa.RecordBatch.from_arrays(
            [pa.array(as_long(np.concatenate(sigs))), pa.array(np.concatenate(entries))],
            names=["sig", "entry"])

    sigs, entries, held = [], [], 0
    for b in batches:
        for s in _sets(b.column("text")):
            node = node_of(s)
            if node == 0 or node in seen:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(node)
            own = band_of(len(s))
            for lower in (0, 1):
                if own >= lower:
                    g = _signatures(s, own - lower)
                    sigs.append(g)
                    entries.append(np.full(len(g), node + lower, dtype=np.int64))
                    held += len(g)
            if held > 100_000:
                yield out(sigs, entries)
                sigs, entries, held = [], [], 0
    if held:
        yield out(sigs, entries)


def _sketch(s: np.ndarray) -> bytes:
    """Presence of the set's shingles in ``SKETCH_BITS`` cells."""
    cells = np.zeros(SKETCH_BITS, dtype=np.uint8)
    cells[(mix(s) >> U64(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64)] = 1
    return np.packbits(cells).tobytes()


def _describe(what: str):
    """A mapInArrow function: texts to (node, size and sketch) or (node, whole set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, PART):
                # copies side by side are one
                sets = list(_sets(list(dict.fromkeys(whole.column("text").slice(i, PART).to_pylist()))))
                if what == "set":
                    cols = [pa.array([as_long(s) for s in sets], type=pa.list_(pa.int64()))]
                else:
                    cols = [pa.array([len(s) for s in sets], pa.int64()),
                            pa.array([_sketch(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), *cols],
                                                 names=["node", "set"] if what == "set" else ["node", "size", "sketch"])
    return run


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches differ in no more cells than linked sets may differ in shingles."""
    for b in batches:
        both = b.column("na").to_numpy() + b.column("nb").to_numpy()
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint64).reshape(b.num_rows, -1)
                for c in ("ka", "kb"))
        apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        good = pa.array((LINK_DEN + LINK_NUM) * apart <= (LINK_DEN - LINK_NUM) * both)
        yield pa.RecordBatch.from_arrays([b.column("a").filter(good), b.column("b").filter(good)], names=["a", "b"])


def _tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile, to the tile's pairs that may link across components.

    A tile holds two blocks of one bucket, or one with itself; only the pairs that the
    sketches let through are written. Two sets that nearly link share hundreds of buckets; a task
    gets those of one least node and remembers the pairs that it has written.
    """
    seen: set[tuple[int, int]] = set()

    names = ("sig", "t0", "t1", "block", "node", "component", "probe", "size")

    def pairs(g: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n, width = len(g["node"]), g["sketch"].shape[1]
        one = g["t0"][0] == g["t1"][0]
        for i in range(0, n, step := max(1, (1 << 21) // (n * width))):
            r = slice(i, i + step)
            ok = (g["node"][r, None] < g["node"]) & (g["component"][r, None] != g["component"]) \
                & (g["probe"][r, None] | g["probe"])
            if not one:
                ok &= g["block"][r, None] != g["block"]
            x, y = np.nonzero(ok)
            x = x + i
            apart = np.bitwise_count(g["sketch"][x] ^ g["sketch"][y]).sum(axis=1, dtype=np.int64)
            keep = (LINK_DEN + LINK_NUM) * apart <= (LINK_DEN - LINK_NUM) * (g["size"][x] + g["size"][y])
            yield g["node"][x[keep]], g["node"][y[keep]]

    def columns(b: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = {c: b.column(c).to_numpy(zero_copy_only=False) for c in names}
        out["sketch"] = np.frombuffer(b"".join(b.column("sketch").to_pylist()), dtype=np.uint64) \
            .reshape(b.num_rows, -1)
        return out

    def tiles() -> Iterator[dict[str, np.ndarray]]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            new = columns(b)
            held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in new}
            key = [held[c] for c in ("sig", "t0", "t1")]
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            for lo, hi in zip([0, *cut[:-1]], cut, strict=False):
                yield {c: v[lo:hi] for c, v in held.items()}
            if len(cut):
                held = {c: v[cut[-1]:] for c, v in held.items()}
        if held is not None:
            yield held

    def batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    found: list[tuple[int, int]] = []
    for tile in tiles():
        if len(seen) > REMEMBERED:
            seen.clear()
        for x, y in pairs(tile):
            new = set(zip(x.tolist(), y.tolist(), strict=True)) - seen
            seen |= new
            found += new
        if len(found) > 50_000:
            yield batch(found)
            found = []
    if found:
        yield batch(found)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both sets, to the pairs that link."""
    for b in batches:
        sa, sb = b.column("sa"), b.column("sb")
        good = np.zeros(b.num_rows, dtype=bool)
        for i in range(b.num_rows):
            x, y = sa[i].values.to_numpy(), sb[i].values.to_numpy()
            inter = len(x) + len(y) - len(np.union1d(x, y))
            good[i] = LINK_DEN * inter >= LINK_NUM * (len(x) + len(y) - inter)
        good = pa.array(good)
        yield pa.RecordBatch.from_arrays([b.column("a").filter(good), b.column("b").filter(good)], names=["a", "b"])


def text_key(text) -> Column:
    """What tells texts apart without their sets. Texts that share a key by chance are only read for nothing."""
    return F.xxhash64(text)


def _described(texts: DataFrame, known: DataFrame, nodes: DataFrame, what: str, fields: str) -> DataFrame:
    """One row per listed node; copies of one set meet again and one of them stays.

    Only the texts with the least key of a listed node are read: its set is made from them again.
    """
    wanted = materialize(known.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
                         .select("key").distinct(), "wanted-texts")
    rows = join_keys(texts.withColumn("key", text_key("text")), wanted, "key", "left_semi") \
        .select("text").mapInArrow(_describe(what), fields)
    names = rows.columns[1:]
    return materialize(rows.groupBy("node").agg(*(F.first(c).alias(c) for c in names)), what)


def _links(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link: sketches rule most others out, sets decide."""
    k = sketches
    near = (pairs.join(k.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("sketch").alias("ka")), "a")
            .join(k.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("sketch").alias("kb")), "b")
            .select("a", "b", "na", "nb", "ka", "kb").mapInArrow(_possible, "a long, b long"))
    near = materialize(near, "near")
    nodes = materialize(near.select(F.col("a").alias("node")).union(near.select("b")).distinct(), "near-nodes")
    sets = _described(texts, known, nodes, "set", "node long, set array<long>")
    both = (near.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b").select("a", "b", "sa", "sb"))
    return materialize(both.mapInArrow(_verify, "a long, b long"), "links")


def _probing(shared: DataFrame, known: DataFrame) -> DataFrame:
    """The rows (sig, node, probe) that can still make a linked pair, written."""
    nodes = shared.select("node").distinct()
    needs = known.select("node", "size").join(nodes, "node", "left_semi").distinct().mapInArrow(_needs, "node long, lower boolean, need long")
    bulk = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
    own = Window.partitionBy("node", "lower")
    ranked = (shared.join(bulk, "sig").join(needs, ["node", "lower"])
              .withColumn("shares", F.count(F.lit(1)).over(own)).where("shares >= need")
              .withColumn("rank", F.row_number().over(own.orderBy("size", "sig"))))
    rows = materialize(ranked.select("sig", "node", (F.col("rank") <= F.col("shares") - F.col("need") + 1)
                                     .alias("probe")), "ranked")
    live = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.max("probe").alias("probed")) \
        .where("n > 1 and probed")
    return materialize(rows.join(live.select("sig"), "sig", "left_semi"), "members")


def node_components(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(node, component) of every node that links with another; component is a node id.

    ``texts`` has the one column ``text``, without nulls; ``known`` is a written list of its rows'
    (node, size, key of the text), which may repeat nodes.
    """
    sigs = texts.mapInArrow(_emit, "sig long, entry long")
    by_sig = Window.partitionBy("sig")
    node = F.col("entry").bitwiseAND(F.lit(-2))
    shared = (sigs.withColumn("lo", F.min(node).over(by_sig)).withColumn("hi", F.max(node).over(by_sig))
              .where("lo != hi").select("sig", node.alias("node"), (F.col("entry") != node).alias("lower"))
              .distinct())
    members = _probing(materialize(shared, "buckets"), known)
    # the node that shares the most is each bucket's leader
    bulk = members.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
    weight = materialize(members.join(bulk, "sig").groupBy("node")
                         .agg(F.sum(F.least("size", F.lit(1000))).alias("weight")), "weights")
    sketches = _described(texts, known, weight.select("node"), "sketch", "node long, size long, sketch binary")
    leader = (members.join(weight, "node").groupBy("sig")
              .agg(F.max(F.struct("weight", "node", "probe")).alias("lead")))
    stars = materialize(members.join(leader, "sig")
                        .where("node != lead.node and (probe or lead.probe)")
                        .select(F.least("node", "lead.node").alias("a"),
                                F.greatest("node", "lead.node").alias("b")).distinct(), "star-pairs")
    links = _links(stars, sketches, texts, known)
    comp = materialize(connected_components(links), "star-components")

    # whatever still shares a bucket across components
    left = (members.join(comp, "node", "left")
            .select("sig", "node", "probe", F.coalesce("component", "node").alias("component")))
    mixed = (left.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.max("probe").alias("probed"), F.count(F.lit(1)).alias("n"),
                                     F.min("node").alias("least"))
             .where("lo != hi and probed").select("sig", "n", "least"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    tiled = (left.join(mixed, "sig").withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .join(sketches, "node")
             .select("sig", F.least("block", "other").alias("t0"), F.greatest("block", "other").alias("t1"),
                     "block", "node", "component", "probe", "size", "sketch", "least"))
    spread = F.pmod(F.xxhash64("sig", "t0", "t1"), F.lit(SPREAD))
    rest = (tiled.repartition("least", spread).drop("least").sortWithinPartitions("sig", "t0", "t1")
            .mapInArrow(_tile_pairs, "a long, b long").distinct())
    rest = materialize(rest.join(stars, ["a", "b"], "left_anti"), "rest-pairs")
    more = _links(rest, sketches, texts, known)
    return connected_components(links.unionByName(more))


def _grouped(docs: DataFrame) -> DataFrame:
    """Rows doc_id, key of the text, n_shingles, node, component (null for the empty set)."""
    ids = id_text(docs)
    rows = materialize(with_nodes(ids.withColumn("key", text_key("text")), "n_shingles", "node", keep_text=False), "nodes")
    known = rows.where("node != 0").select("node", F.col("n_shingles").alias("size"), "key")
    comp = materialize(node_components(ids.select("text"), known), "components")
    component = F.when(F.col("node") != 0, F.coalesce("component", "node"))
    return rows.join(comp, "node", "left").withColumn("component", component)


def components(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest linked id, itself included)."""
    rows = materialize(_grouped(docs), "grouped")
    least = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return (rows.join(least, "component", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least"))
                    .alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of linked documents (smallest id; null ids last).

    Rows with an empty set are all kept. Repeated rows (same id, same set) count as one
    document: one of them stays. All columns come back.
    """
    docs, names = neutral(docs)
    rows = materialize(_grouped(docs).where("component is not null"), "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")
    first = rows.groupBy("component").agg(F.min(order).alias("first"))
    judged = rows.join(first, "component")
    kept = (F.col("first.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("first.node") == F.col("node"))
    gone = F.col("doc_id").alias("_id"), F.col("key").alias("_key")
    dropped = materialize(judged.where(~kept).select(*gone).distinct(), "dropped")
    twice = judged.where(kept).groupBy(F.col("doc_id").alias("_twice"), F.col("node").alias("_node")).count().where("count > 1")
    again = materialize(judged.where(kept).join(twice, F.col("doc_id").eqNullSafe(F.col("_twice")) & (F.col("node") == F.col("_node")))
                        .select(*gone, "_node").distinct(), "repeated")
    noded = docs.withColumn("_own", text_key(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    same = (F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))) & (F.col("_own") == F.col("_key"))
    out = join_keys(noded, dropped, same, "left_anti")
    if not again.isEmpty():
        out = join_keys(out, again, same, "left_anti").select(*docs.columns).unionByName(
            join_keys(out, again, same, "inner").dropDuplicates(["_id", "_node"]).select(*docs.columns))
    return out.select(*docs.columns).toDF(*names)
