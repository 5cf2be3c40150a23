"""Merkle manifest of a dataset, with a proof for every row by pointer jumping.

*Digests.* H is the lowercase hex sha256 of its inputs' concatenation, digests as hex text. A
leaf is H of the row's fields (doc_id, source, lang, n_chars, text), each ``-`` if null, else
its UTF-8 byte count, ``:`` and the value, so no two rows give the same input. Per source the
leaves ascend by doc_id, and while several nodes remain every ``FANOUT`` consecutive ones become
their H; what remains is the source's subroot. The subroots, ordered by source (null first,
bytewise), give the root in the same way.

*Tree.* Positions come from a range partitioning (:mod:`~indistar.llm.ranks`), so a hot source
spreads over tasks. A level is one shuffle by (source, position div ``FANOUT``); a group has
``FANOUT`` rows at most, and each level is a ``FANOUT``-th of the one below.

*Proofs.* An inner node holds a segment of its way up: for each step the children of the node
it passes, and its own place among the next ones. At first the segment has one step and points
at the parent. Each round joins the nodes with themselves, pointer to node: the segment
grows by that of the node pointed at and the pointer jumps to where that one points, so
the distance doubles and the rounds grow with the logarithm of the tree's height. Nodes that have reached
the root leave the joins. At last every leaf, which knows its parent and its place there, joins its
parent's segment. Inner nodes are a fifteenth of the leaves, so the rounds move little, and no key
of the last join has more than ``FANOUT`` leaves.

Nulls: any field may be null, the source too (a group of its own); null ids come first. Equal ids
are ordered by their leaf; repeated rows are repeated leaves, and as their digests are equal their order
does not matter. Empty and very long texts are fields like others. A source with one row has that leaf as
subroot; with one source its subroot is the root; a single row is leaf, subroot and root with no
siblings. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import materialize
from indistar.llm.ranks import positions

FANOUT = 16
#: Hex digits of a digest.
DIGITS = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Name of the tree over the subroots; sources' trees are named ``-`` (null) or ``=source``.
TOP = ""
MAX_ROUNDS = 64


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def field(c: Column) -> Column:
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The leaf of a row; ``changed`` replaces fields by other columns."""
    return digest(F.concat(*(field(changed.get(f, F.col(f))) for f in FIELDS)))


def _node(tree: Column | str, level: Column, i: Column) -> Column:
    return F.concat_ws("/", level.cast("string"), i.cast("string"), tree)


def _next(i: str = "i") -> Column:
    return F.floor(F.col(i) / FANOUT).cast("long")


def _place(i: str = "i") -> Column:
    return F.pmod(F.col(i), F.lit(FANOUT)).cast("int")


def _runs(level: DataFrame) -> DataFrame:
    """One level up: (tree, level, i, digest, n) rows of trees with several nodes to their parents."""
    up = (level.where("n > 1").groupBy("tree", "level", _next().alias("up"))
          .agg(F.sort_array(F.collect_list(F.struct("i", "digest"))).alias("of"), F.max("n").alias("n")))
    children = F.array_join(F.transform("of", lambda x: x["digest"]), "")
    return (up.withColumn("children", children)
            .select("tree", (F.col("level") + 1).alias("level"), F.col("up").alias("i"), "children",
                    digest(F.col("children")).alias("digest"), F.ceil(F.col("n") / FANOUT).cast("long").alias("n")))


def _levels(level: DataFrame) -> DataFrame | None:
    """All inner nodes above ``level``, a written table each; None if no tree has any."""
    most, out = level.agg(F.max("n")).first()[0] or 0, None
    while most > 1:
        level = materialize(_runs(level), "merkle-level")
        out = level if out is None else out.unionByName(level)
        most = -(-most // FANOUT)
    return out


@dataclass
class Manifest:
    """Written tables of a manifest.

    ``leaves``: tree, pos, n and what :func:`build` was asked to carry; ``nodes``: tree, level, i,
    children, digest, n of the inner nodes (None: there are none); ``tops``: tree, digest, pos, n of
    the subroots; ``root``: None for an empty table.
    """

    leaves: DataFrame
    nodes: DataFrame | None
    tops: DataFrame
    root: str | None


def build(rows: DataFrame) -> Manifest:
    """The manifest of ``rows``: doc_id, tree, leaf and further columns to carry along."""
    leaves = materialize(positions(materialize(rows, "merkle-rows"), "tree", ["doc_id", "leaf"]), "merkle-leaves")
    first = leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("i"), F.col("leaf").alias("digest"), "n")
    inner = _levels(first)
    subroots = first if inner is None else first.unionByName(inner.drop("children"))
    subroots = materialize(subroots.where("n = 1").select(F.lit(TOP).alias("_top"), "tree", "digest"), "merkle-subroots")
    tops = materialize(positions(subroots, "_top", ["tree"]), "merkle-tops")
    upper = _levels(tops.select(F.lit(TOP).alias("tree"), F.lit(0).alias("level"), F.col("pos").alias("i"), "digest", "n"))
    nodes = [x for x in (inner, upper) if x is not None]
    nodes = nodes[0].unionByName(nodes[1]) if len(nodes) == 2 else nodes[0] if nodes else None
    last = (tops if upper is None else upper).where("n = 1").select("digest").first()
    return Manifest(leaves, nodes, tops, last[0] if last else None)


def segments(m: Manifest) -> DataFrame | None:
    """(id, steps, subroot) of every inner node: its whole way to the root.

    A step is (children, place): the children of the node passed and that node's place among
    the next step's children. ``subroot`` is null where the way passes none (the upper tree).
    """
    if m.nodes is None:
        return None
    up = (F.col("level") + 1)
    inside = m.nodes.where("n > 1").select(
        _node(F.col("tree"), F.col("level"), F.col("i")).alias("id"), _node(F.col("tree"), up, _next()).alias("to"),
        F.array(F.struct("children", _place().alias("place"))).alias("steps"), F.lit(None).cast("string").alias("subroot"))
    heads = m.nodes.where("n = 1")
    over = m.tops.select("tree", F.col("pos"), F.col("n").alias("m"))
    subs = heads.where(F.col("tree") != TOP).join(over, "tree").select(
        _node(F.col("tree"), F.col("level"), F.col("i")).alias("id"),
        F.when(F.col("m") > 1, _node(F.lit(TOP), F.lit(1), _next("pos"))).alias("to"),
        F.array(F.struct("children", _place("pos").alias("place"))).alias("steps"), F.col("digest").alias("subroot"))
    root = heads.where(F.col("tree") == TOP).select(
        _node(F.col("tree"), F.col("level"), F.col("i")).alias("id"), F.lit(None).cast("string").alias("to"),
        F.array(F.struct("children", F.lit(0).alias("place"))).alias("steps"), F.lit(None).cast("string").alias("subroot"))
    state = materialize(inside.unionByName(subs).unionByName(root), "merkle-ways")
    for _ in range(MAX_ROUNDS):
        moving = state.where(F.col("to").isNotNull())
        if moving.isEmpty():
            return state.drop("to")
        there = state.select(F.col("id").alias("to"), F.col("to").alias("far"), F.col("steps").alias("more"),
                             F.col("subroot").alias("over"))
        jumped = moving.join(there, "to").select("id", F.col("far").alias("to"), F.concat("steps", "more").alias("steps"),
                                                 F.coalesce("subroot", "over").alias("subroot"))
        state = materialize(state.where(F.col("to").isNull()).unionByName(jumped), "merkle-ways")
    raise RuntimeError(f"pointers did not reach the root within {MAX_ROUNDS} rounds")


def proofs(m: Manifest) -> DataFrame:
    """The leaves with subroot, root and ``siblings``: array of (left, right) hex text, leaf to root."""
    carried = [c for c in m.leaves.columns if c not in ("tree", "pos", "n")]
    many = m.leaves.where("n > 1").select(
        *carried, _node(F.col("tree"), F.lit(1), _next("pos")).alias("id"), _place("pos").alias("place"),
        F.lit(None).cast("string").alias("lone"))
    over = m.tops.select("tree", F.col("pos").alias("rank"), F.col("n").alias("m"))
    alone = m.leaves.where("n = 1").join(over, "tree").select(
        *carried, F.when(F.col("m") > 1, _node(F.lit(TOP), F.lit(1), _next("rank"))).alias("id"),
        _place("rank").alias("place"), F.col("leaf").alias("lone"))
    rows = many.unionByName(alone)
    ways = segments(m)
    none = F.array().cast("array<struct<children:string,place:int>>")
    if ways is None:
        rows = rows.withColumn("steps", none).withColumn("subroot", F.lit(None).cast("string"))
    else:
        rows = rows.join(ways, "id", "left").withColumn("steps", F.coalesce("steps", none))

    def sides(step: Column, k: Column) -> Column:
        place = F.when(k == 0, F.col("place")).otherwise(F.get("steps", k - 1)["place"])
        return F.struct(F.substring(step["children"], F.lit(1), place * DIGITS).alias("left"),
                        F.substring(step["children"], (place + 1) * DIGITS + 1, F.lit(FANOUT * DIGITS)).alias("right"))

    return rows.select(*carried, F.coalesce("lone", "subroot").alias("subroot"), F.lit(m.root).alias("root"),
                       F.transform("steps", sides).alias("siblings"))


def fold(start: Column, siblings: str | Column = "siblings") -> Column:
    """The root that ``start`` leads to by way of its siblings."""
    return F.aggregate(siblings, start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def proof_digest(siblings: str | Column = "siblings") -> Column:
    return digest(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), ""))


def tree_of(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


#: Of the rows whose crc32 this divides, the audit tampers with the text.
AUDITED = 5


def audit(docs: DataFrame) -> DataFrame:
    """Per row: its digests, and whether the proof holds for the row as it is read back.

    Rows chosen by ``AUDITED`` are read back with A-Z of the text in lower case.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % AUDITED == 0
    changed = leaf(text=F.translate(F.col("text"), upper, upper.lower()))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(f) for f in FIELDS[1:]))
            .select("doc_id", tree_of(F.col("source")).alias("tree"), leaf().alias("leaf"),
                    F.when(chosen, changed).alias("tampered")))
    out = proofs(build(rows)).withColumn("folded_root", fold(F.coalesce("tampered", "leaf")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
