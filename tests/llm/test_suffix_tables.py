"""Suffix dedup against all windows of whole tables; opt-in, as it takes minutes.

INDISTAR_SUFFIX_TABLES lists folders with a documents table, separated by colons.
"""

import hashlib
import os

import numpy as np
import pytest

from indistar.llm import suffix_dedup
from indistar.llm.common import byte_sums, range_hashes

FOLDERS = [f for f in os.environ.get("INDISTAR_SUFFIX_TABLES", "").split(":") if f]
WIDTH = suffix_dedup.WIDTH


def _windows(data):
    n = len(data) - WIDTH + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    at = np.arange(n)
    return range_hashes(byte_sums(np.frombuffer(data, np.uint8)), at, at + WIDTH)


@pytest.mark.skipif(not FOLDERS, reason="INDISTAR_SUFFIX_TABLES is not set")
@pytest.mark.parametrize("folder", FOLDERS)
def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r[0]: (r[1] or "").encode() for r in docs.select("doc_id", "text").toLocalIterator()}
    every = np.sort(np.concatenate([_windows(t) for t in texts.values()]))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    del every
    wrong = cut = 0
    for r in suffix_dedup.report(docs).toLocalIterator():
        data = texts[r["doc_id"]]
        h = _windows(data)
        at = np.searchsorted(twice, h)
        hit = np.flatnonzero(twice[np.minimum(at, len(twice) - 1)] == h) if len(twice) else np.empty(0, np.int64)
        edges = np.zeros(len(data) + 1, dtype=np.int64)
        np.add.at(edges, hit, 1)
        np.add.at(edges, hit + WIDTH, -1)
        gone = np.cumsum(edges[:-1]) > 0
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        want = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        wrong += (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) != want
        cut += spans > 0
    print(f"{folder}: {len(texts)} documents, {cut} with removals, {wrong} differ")
    assert wrong == 0 and cut > 0
