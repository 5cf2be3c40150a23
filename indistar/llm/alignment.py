"""Alignment of two tokenizers' tokens over the same bytes, and corpus counts of linked ids.

*Alignment* (interval coalescing). Every token covers a range of the text's bytes. The tokens of
both sides are sorted lexically by start (and side), the running maximum of their ends is taken, and a new
group begins where a token's start reaches that maximum: there, and only there, tokens of both
sides end together, and tokens that overlap are in one group. Texts of a batch lie one after another in one
range of places, so a batch is sorted once; a text's end always ends a group.

*Links.* Within a group every A token is linked with every B token. A pair of ids counts the
documents that hold it linked, over the whole corpus.

*Scale.* A text is encoded once, and what later steps need of it (its distinct id pairs and how often
each is linked) is written. Pair counts aggregate before they shuffle. The most frequent pairs,
``HOT_PAIRS`` at most by a count threshold that a small histogram gives, are broadcast, as they hold most
links and would be hot keys; all others take a shuffle join on the pair. The highest count of an
A id is a table of at most the vocabulary's size. A group with very many links (a long run of bytes
that the two cut differently) is reduced to its distinct ids before they are paired.

Nulls: a null or empty text has no tokens, and neither has one whose joined token bytes differ from
space + text on either side (as with U+2581, which the B model writes for a space): all zeros, with an empty group text that is not hashed. Ids may be null; equal
ids are documents of their own. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import id_text, materialize
from indistar.llm.tokens import Memo, groups, json_encoder, piece_encoder, spaced_words

#: Pairs whose counts are broadcast at most (16 bytes each).
HOT_PAIRS = 200_000
#: Links of one group from which its ids are made distinct before they are paired.
LARGE_GROUP = 100_000
#: Links expanded at a time.
PART_LINKS = 4_000_000


# ------------------------------------------------------------------ token bytes

def byte_level_bytes(path: str) -> list[bytes]:
    """For every id of a byte-level vocabulary the bytes it stands for."""
    import json

    # printable bytes stand for themselves, the others for the code points from 256 on
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    out = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        out[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
    return out


def piece_bytes(path: str) -> list[bytes]:
    """For every id of a piece model the bytes it stands for (control pieces: their names)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def of(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
    return [of(i) for i in range(model.get_piece_size())]


# ------------------------------------------------------------------ alignment

def coalesce(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A and B token, from the byte lengths of both (equal in sum)."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    start = np.concatenate([a_end - a_len, b_end - b_len])
    end = np.concatenate([a_end, b_end])
    side = np.repeat(np.array([0, 1], dtype=np.int8), [len(a_len), len(b_len)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), dtype=np.int64)
    breaks[1:] = start[order[1:]] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[:len(a_len)], group[len(a_len):]


def linked(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, n: int
           ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """All links of ``n`` groups, some groups at a time: (group, A id, B id, times)."""
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    links = na * nb
    a_at, b_at = np.cumsum(na) - na, np.cumsum(nb) - nb
    large = links > LARGE_GROUP
    for g in np.flatnonzero(large).tolist():
        x, cx = np.unique(a[a_at[g]:a_at[g] + na[g]], return_counts=True)
        y, cy = np.unique(b[b_at[g]:b_at[g] + nb[g]], return_counts=True)
        for i in range(0, len(x), step := max(1, PART_LINKS // len(y))):
            rows = len(x[i:i + step])
            yield (np.full(rows * len(y), g), np.repeat(x[i:i + step], len(y)), np.tile(y, rows),
                   np.outer(cx[i:i + step], cy).ravel())
    small = np.where(large, 0, links)
    cuts = np.searchsorted(np.cumsum(small), np.arange(PART_LINKS, small.sum() + PART_LINKS, PART_LINKS))
    for lo, hi in zip([0, *cuts[:-1] + 1], np.minimum(cuts + 1, n), strict=False):
        g = np.arange(lo, hi)
        g = g[small[lo:hi] > 0]
        which = np.repeat(g, na[g])  # the groups' A tokens
        a_tokens = _ramp(a_at[g], na[g])
        per = nb[which]
        yield np.repeat(which, per), np.repeat(a[a_tokens], per), b[_ramp(b_at[which], per)], None


def _ramp(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] of them), start[1], ..."""
    end = np.cumsum(n)
    return np.repeat(start - (end - n), n) + np.arange(end[-1] if len(end) else 0)


class GroupText:
    """Writes groups as ``a1,a2|b1;a3|b2,b3`` for many texts at once."""

    WIDTH = 11

    def __init__(self, ids: int):
        digits = np.zeros((ids, self.WIDTH), dtype=np.uint8)
        self.shown = np.zeros((ids, self.WIDTH), dtype=bool)
        left = np.arange(ids)
        for k in range(self.WIDTH - 2, -1, -1):
            digits[:, k] = left % 10 + ord("0")
            self.shown[:, k] = (left > 0) | (k == self.WIDTH - 2)
            left = left // 10
        self.shown[:, -1] = True
        used = self.shown.any(axis=0)
        self.digits, self.shown = digits[:, used], self.shown[:, used]
        self.size = self.shown.sum(axis=1)

    def write(self, a, b, ga, gb) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, end of each group's bytes); every group ends with a ``;``."""
        ids = np.concatenate([a, b])
        order = np.argsort(np.concatenate([2 * ga, 2 * gb + 1]), kind="stable")
        ids, key = ids[order], np.concatenate([2 * ga, 2 * gb + 1])[order]
        last = np.append(key[1:] != key[:-1], True)
        shape = self.digits[ids]
        shape[:, -1] = np.where(last, np.where(key % 2 == 0, ord("|"), ord(";")), ord(","))
        ends = np.cumsum(self.size[ids])
        return shape[self.shown[ids]], ends[last & (key % 2 == 1)]


class Aligner:
    """Encodes and aligns texts; one per worker."""

    def __init__(self, a_path: str, b_path: str):
        self.bytes = byte_level_bytes(a_path), piece_bytes(b_path)
        self.len = [np.array([len(x) for x in t], dtype=np.int64) for t in self.bytes]
        self.memo = Memo(spaced_words, json_encoder(a_path, plain_specials=True, prefix=" "), piece_encoder(b_path))
        self.text = GroupText(max(map(len, self.bytes)))
        self.base = len(self.bytes[1])

    def _tokens(self, texts: list[str]):
        """Ids and offsets of both sides, without the texts that do not give their bytes back."""
        (a, at), (b, bt) = self.memo.encode(texts)
        whole = "".join(" " + t for t in texts).encode("utf-8", "surrogatepass")
        fine = np.array([bool(t) and "▁" not in t for t in texts])
        joined = [b"".join(map(table.__getitem__, x.tolist())) for table, x in zip(self.bytes, (a, b), strict=True)]
        if joined != [whole, whole]:
            for i, t in enumerate(texts):
                want = (" " + t).encode("utf-8", "surrogatepass")
                fine[i] &= all(b"".join(map(table.__getitem__, x[o[i]:o[i + 1]].tolist())) == want
                               for table, x, o in zip(self.bytes, (a, b), (at, bt), strict=True))
        na, nb = np.diff(at) * fine, np.diff(bt) * fine
        return a[np.repeat(fine, np.diff(at))], na, b[np.repeat(fine, np.diff(bt))], nb

    def align(self, texts: list[str]) -> tuple[list, list[np.ndarray], list[np.ndarray]]:
        """Per text (n_a, n_b, n_groups, n_links, digest), its distinct pairs, and their links."""
        a, na, b, nb = self._tokens(texts)
        n = len(texts)
        if not len(a):
            return [(0, 0, 0, 0, "")] * n, [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n
        ga, gb = coalesce(self.len[0][a], self.len[1][b])
        n_groups = int(ga[-1]) + 1
        doc_of_a = np.repeat(np.arange(n), na)
        doc = np.zeros(n_groups, dtype=np.int64)
        doc[ga] = doc_of_a
        per_doc = np.bincount(doc, minlength=n)
        data, ends = self.text.write(a, b, ga, gb)
        data, stop = data.tobytes(), np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_doc)])].tolist()
        keys, times = [], []
        span = np.int64(self.base) * len(self.bytes[0])
        for g, x, y, t in linked(a, b, ga, gb, n_groups):
            k = doc[g] * span + x.astype(np.int64) * self.base + y
            if t is None:
                k, t = np.unique(k, return_counts=True)
            keys.append(k)
            times.append(t)
        key, times = np.concatenate(keys), np.concatenate(times)
        if len(keys) > 1:
            key, at = np.unique(key, return_inverse=True)
            times = np.bincount(at, weights=times).astype(np.int64)
        edge = np.searchsorted(key, np.arange(n + 1) * span)
        total = np.concatenate([[0], np.cumsum(times)])[edge]
        rows = [(int(na[i]), int(nb[i]), int(per_doc[i]), int(total[i + 1] - total[i]),
                 hashlib.sha256(data[stop[i]:stop[i + 1] - 1]).hexdigest() if na[i] else "") for i in range(n)]
        cut = lambda v: [v[edge[i]:edge[i + 1]] for i in range(n)]
        return rows, cut(key % span), cut(times)


_FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def _align(a_path: str, b_path: str):
    """A mapInArrow function: (row, doc_id, text) to the text's figures, pairs and their links."""
    held: list[Aligner] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Aligner(a_path, b_path))
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in groups(texts, 500_000):
                rows, pairs, times = held[0].align(texts[lo:hi])
                cols = [pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True))[:4]]
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(lo, hi - lo), b.column("doc_id").slice(lo, hi - lo), *cols,
                     pa.array([r[4] for r in rows], pa.string()), pa.array(pairs, pa.list_(pa.int64())),
                     pa.array(times, pa.list_(pa.int64()))],
                    names=["row", "doc_id", *_FIELDS, "groups_sha256", "pairs", "times"])
    return run


# ------------------------------------------------------------------ corpus counts

def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Written rows: row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times.

    ``pairs`` are the distinct linked id pairs of the text as A id * (size of B's vocabulary) + B id,
    ``times`` how often each is linked.
    """
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text")
    return materialize(rows.mapInArrow(
        _align(a_path, b_path), "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                "groups_sha256 string, pairs array<long>, times array<long>"), "aligned")


def pair_counts(aligned: DataFrame, b_ids: int) -> DataFrame:
    """Written (pair, docs, best): the documents that link a pair; whether no pair of its A id has more."""
    counts = materialize(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair")
                         .agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    a_id = F.floor(F.col("pair") / b_ids)
    top = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("top"))  # as many rows as A has ids, at most
    return materialize(counts.withColumn("a", a_id).join(F.broadcast(top), "a")
                       .select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")), "pair-table")


def hot_threshold(counts: DataFrame, at_most: int = HOT_PAIRS) -> int:
    """Least count from which on no more than ``at_most`` pairs have as many documents."""
    by_size = counts.groupBy(F.floor(F.log2("docs") * 8).cast("int").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.min("docs").alias("least"))
    rows = sorted(by_size.collect(), key=lambda r: -r["k"])  # one row per eighth of a power of two
    held, least = 0, 1 << 62
    for r in rows:
        held += r["n"]
        if held > at_most:
            break
        least = r["least"]
    return least


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = align(docs, a_path, b_path)
    counts = pair_counts(aligned, len(piece_bytes(b_path)))
    least = hot_threshold(counts)
    hot, rare = counts.where(F.col("docs") >= least), counts.where(F.col("docs") < least)
    links = (aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
             .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")))
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum")]
    frequent = links.join(F.broadcast(hot), "pair").groupBy("row").agg(*sums)
    others = links.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(rare, "pair").groupBy("row").agg(*sums)
    both = frequent.unionByName(others).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.join(both, "row", "left").select(
        "doc_id", *_FIELDS, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256")
