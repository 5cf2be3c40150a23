"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Every word 3-gram of a test item is a seed. None is left out for being common or rare: an
   edited copy may hold any of them.
2. A document that holds two different seeds of an item (one, if the item has fewer), on
   diagonals as near to each other as an alignment that reaches the score allows, is a
   candidate, at every position that such an alignment can reach.
3. The passage and the item are aligned word by word (match 2, other word or gap -1). The
   score is the best local alignment as a share of the item's own; at ``MIN_SCORE`` the
   passage is a copy, however edited or paraphrased around the kept words. Candidates whose
   passage holds too few of the item's words to reach the score are not aligned.

So a copy that reaches the score is found whenever two of its kept 3-grams differ.

Words are runs between white space and punctuation, lower-cased. Null and empty texts have
none and match nothing; an item with fewer than three words has its words as one seed.
Items of equal text each report. Repeated documents each report. Empty tables on either
side give an empty result; extra columns are ignored by ``find`` and kept by ``clean``.

The items are handled in blocks of ``BLOCK_ITEMS``, chosen by a digest of the item: one
block's items and seeds are what is broadcast, so its size is bounded, and every block meets
every document. Per task the work is one document at a time; no text is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.llm.common import append_columns, id_text, materialize, neutral

GRAM = 3
NEEDED_SEEDS = 2
MIN_SCORE = 0.5
MATCH, OTHER, GAP = 2, -1, -1
BLOCK_ITEMS = 5_000
#: Characters that end a word, besides white space.
PUNCTUATION = ".,;:!?\"'()[]{}<>|/\\-_*#$%&=+~`^@"

_TABLE = str.maketrans(PUNCTUATION, " " * len(PUNCTUATION))


def words(text: str) -> list[str]:
    return text.lower().translate(_TABLE).split()


@dataclass
class Items:
    """One block of test items: word ids, the items' words and the postings of every gram."""

    vocabulary: dict[str, int]
    ids: list[int | None]
    texts: list[np.ndarray]
    grams: np.ndarray  # sorted keys
    offsets: np.ndarray  # by gram: where its postings begin
    post_items: np.ndarray
    post_positions: np.ndarray
    lengths: np.ndarray
    needed: np.ndarray  # by item: different seeds that make a candidate

    def keys(self, w: np.ndarray) -> np.ndarray:
        """Key of the gram at every position, -1 where a word is unknown."""
        n = len(w) - GRAM + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64)
        base = np.int64(len(self.vocabulary) + 1)
        k, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        for j in range(GRAM):
            k = k * base + w[j:j + n]
            known &= w[j:j + n] >= 0
        return np.where(known, k, -1)

    def found(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of grams of this block, and their indexes."""
        keys = self.keys(w)
        if not len(keys) or not len(self.grams):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        at = np.flatnonzero(keys >= 0)
        i = np.searchsorted(self.grams, keys[at])
        i[i == len(self.grams)] = 0
        hit = self.grams[i] == keys[at]
        return at[hit], i[hit]

    def ids_of(self, tokens: list[str]) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(t, -1) for t in tokens], dtype=np.int64)


def block_of(rows: list[tuple[int | None, str]]) -> Items:
    vocabulary: dict[str, int] = {}
    ids, texts = [], []
    for item, text in rows:
        w = words(text)
        if w:
            ids.append(item)
            texts.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in w], dtype=np.int64))
    none = np.empty(0, dtype=np.int64)
    block = Items(vocabulary, ids, texts, none, none, none, none, np.array([len(t) for t in texts], dtype=np.int64), none)
    if len(vocabulary) >= 1 << 20:
        raise ValueError("a block's vocabulary is too large for its gram keys: use smaller blocks")
    keys = [block.keys(t) for t in texts]
    every = np.concatenate([none, *keys])
    order = np.argsort(every, kind="stable")
    block.grams, first = np.unique(every[order], return_index=True)
    block.offsets = np.append(first, len(every))
    block.post_items = np.repeat(np.arange(len(keys)), [len(k) for k in keys])[order]
    block.post_positions = np.concatenate([none, *(np.arange(len(k)) for k in keys)])[order]
    block.needed = np.array([min(NEEDED_SEEDS, len(np.unique(k))) for k in keys], dtype=np.int64)
    return block


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of b against a, and the position after its end in a."""
    ramp = np.arange(len(a) + 1, dtype=np.int64) * -GAP
    row = np.zeros(len(a) + 1, dtype=np.int64)
    best, end = 0, 0
    for x in b:
        step = np.maximum(row[:-1] + np.where(a == x, MATCH, OTHER), row[1:] + GAP)
        new = np.zeros_like(row)
        np.maximum(step, 0, out=new[1:])
        row = np.maximum.accumulate(new + ramp) - ramp  # gaps within the row
        j = int(row.argmax())
        if row[j] > best:
            best, end = int(row[j]), j
    return best, end


def matches(tokens: list[str], block: Items, min_score: float = MIN_SCORE) -> list[tuple[int, float, int, int, int]]:
    """(item index, score, seeds, first word, word after the last) of every copied item."""
    w = block.ids_of(tokens)
    at, grams = block.found(w)
    out = []
    if len(at):
        # one hit per gram of the document and posting, by item and diagonal
        size = block.offsets[grams + 1] - block.offsets[grams]
        post = np.arange(size.sum()) + np.repeat(block.offsets[grams] - np.cumsum(size) + size, size)
        items, seeds = block.post_items[post], np.repeat(grams, size)
        diagonals = np.repeat(at, size) - block.post_positions[post]
        order = np.lexsort((diagonals, items))
        items, seeds, diagonals = items[order], seeds[order], diagonals[order]
        # gaps an alignment of this score can have: 2 a match of at most n, less 1 a gap
        reach = np.floor((1 - min_score) * MATCH * block.lengths / -GAP + 1e-9).astype(np.int64)
        new_item = items[1:] != items[:-1]
        cuts = np.flatnonzero(new_item | (diagonals[1:] - diagonals[:-1] > reach[items[1:]])) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(items))
        enough = np.flatnonzero(ends - starts >= block.needed[items[starts]])
        best: dict[int, tuple[int, int, int]] = {}
        for a, b in zip(starts[enough].tolist(), ends[enough].tolist(), strict=True):  # runs of neighbouring diagonals
            item = int(items[a])
            if len(np.unique(seeds[a:b])) < block.needed[item]:
                continue
            n, text, far = int(block.lengths[item]), block.texts[item], int(reach[item])
            lo, hi = max(0, int(diagonals[a]) - far), min(len(w), int(diagonals[b - 1]) + n + far)
            if np.isin(text, w[lo:hi]).sum() < min_score * n:
                continue
            score, end = align(w[lo:hi], text)
            if score >= min_score * MATCH * n and (item not in best or score > best[item][0]):
                _, back = align(w[lo:lo + end][::-1], text[::-1])
                best[item] = (score, lo + end - back, lo + end)
        for item, (score, first, end) in sorted(best.items()):
            a, b = np.searchsorted(items, [item, item + 1])
            out.append((item, score / (MATCH * int(block.lengths[item])), len(np.unique(seeds[a:b])), first, end))
    # items of fewer words than a gram: the words themselves in a row
    for item, n in enumerate(block.lengths.tolist()):
        if n < GRAM and len(w) >= n:
            same = np.ones(len(w) - n + 1, dtype=bool)
            for j in range(n):
                same &= w[j:len(w) - n + 1 + j] == block.texts[item][j]
            if same.any():
                p = int(same.argmax())
                out.append((item, 1.0, 1, p, p + n))
    return out


def blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> Iterator:
    """Broadcast variables of :class:`Items`, block by block."""
    spark = benchmark.sparkSession
    items = materialize(id_text(benchmark, "item_id").where("trim(text) != ''"), "items")
    number = -(-items.count() // max(1, block_items // 2))  # half full on average, so that none overflows
    for k in range(number):
        rows = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(number)) == k) \
            .orderBy("doc_id", "text").collect()  # bounded by the block's size
        yield spark.sparkContext.broadcast(block_of([(r["doc_id"], r["text"]) for r in rows]))


def find(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document and copied item: doc_id, item_id, score, n_seeds, first_word, end_word."""
    schema = "doc_id long, item_id long, score double, n_seeds int, first_word int, end_word int"
    parts = []
    ids = id_text(docs)
    for shared in blocks(benchmark):
        def run(batches, shared=shared):
            for b in batches:
                rows = []
                for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                    rows += [(d, shared.value.ids[m[0]], *m[1:]) for m in matches(words(t), shared.value, min_score)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                                                 names=["doc_id", "item_id", "score", "n_seeds", "first_word", "end_word"])
        parts.append(ids.mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents that hold no copied item, with all their columns."""
    out, names = neutral(docs)
    for shared in blocks(benchmark):
        def compute(texts, shared=shared):
            return [[bool(t) and bool(matches(words(t), shared.value, min_score)) for t in texts]]
        field = T.StructType([T.StructField("_copied", T.BooleanType())])
        out = append_columns(out, "text", field, compute).where("not _copied").drop("_copied")
    return out.toDF(*names)
