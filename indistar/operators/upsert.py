"""N07/N08/J05 incremental table maintained by keyed upsert, bucket by bucket.

New state = (current rows whose key is not in the batch) + (all batch rows). Rows of one key are
replaced as a group and in-batch duplicates are kept, the delete-then-insert semantics of
an incremental model with a unique key. Applying the same batch again gives the same
rows, so a retried run or a replayed micro-batch is harmless.

Storage: every row belongs to a bucket, by a digest of its key and, if given, of ``cluster``
columns that the key determines (rows of one key have equal values there; for the facts,
the year, which is part of the key). A manifest (:mod:`indistar.sources.manifest`) lists each bucket's
folders. An upsert writes the batch once, straight into the table's layout, and rewrites the surviving rows
of the buckets that the batch touches; all others are carried over by reference. With ``cluster``, a batch
that restates one year rewrites that year's buckets only. The commit is one small file: a failed write never becomes
current, its folder is removed, and what a killed writer leaves goes with the next upsert.

Scale: only touched buckets are read. The batch's keys are anti-joined with them: a small batch
is broadcast by the planner from its file size, a large one gives a sort-merge anti join on two
plain exchanges, in which AQE splits a key that holds a third of the table (an aggregate between
exchange and sort, such as a distinct of the keys, would prevent that). Writes go through a
rebalancing by bucket, so a bucket gets few files and a hot one is split over tasks.

Disk: a shuffle of whole rows takes several times the room of their Parquet files. So large batches are laid
out in slices, one after another, and a slice's shuffle is gone when the next one begins: each some of the rows of a new
batch, so that a bucket gets a folder per slice, or some of the buckets whose rows are written again.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.session import freed_shuffles
from indistar.sources import fs, manifest

KEPT_VERSIONS = 3
#: Digest slots of the cluster columns, and of the key within each. Buckets: their product.
CLUSTERS, PER_CLUSTER = 32, 8
#: Bytes of Parquet files whose rows one slice shuffles, and the most slices.
SLICE_BYTES, SLICES = 1 << 30, 8
BUCKET = "_bucket"
DATA = "data"


def slot(cols: Sequence[str], n: int) -> Column:
    """0 to n - 1 by a digest of the columns' text."""
    text = F.concat_ws("-", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % n


def bucket_of(key: str, cluster: Sequence[str], clusters: int, per: int) -> Column:
    own = slot([key], per) if cluster else slot([key], clusters * per)
    return (slot(cluster, clusters) * per + own if cluster else own).cast("int")


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The table's rows, through its newest manifest."""
    m = manifest.current(spark, root)
    if m is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return _read(spark, root, m, [p for paths in m.entries.values() for p in paths])


def _read(spark: SparkSession, root: str, m: manifest.Manifest, folders: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(m.facts["schema"]))
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root.rstrip('/')}/{p}" for p in folders))


def merge_batch(current: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """The upserted rows, lazily: the anti join (J05) plus the batch."""
    if current is None:
        return batch
    return survivors(current, batch, key).unionByName(batch.select(*current.columns))


def survivors(current: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    return current.join(batch.select(key), on=key, how="left_anti")


def slices_of(spark: SparkSession, *folders: str) -> int:
    """Into how many slices the rows of written Parquet folders are cut."""
    total = sum(fs.size(spark, f) for f in folders)
    return min(SLICES, max(1, math.ceil(total / SLICE_BYTES)))


def _write(rows: DataFrame, root: str, folder: str, bucket: Column, slices: int = 1, by: Sequence[str] = ()
           ) -> dict[str, list[str]]:
    """Write rows by bucket, in slices told apart by a hash of the columns ``by``; the folders of every bucket that has any."""
    out: dict[str, list[str]] = {}
    for n in range(slices):
        own, at = (rows.where(F.pmod(F.xxhash64(*by), F.lit(slices)) == n), f"{folder}/{n}") if slices > 1 else (rows, folder)
        (own.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
         .write.partitionBy(BUCKET).parquet(f"{root}/{at}"))
        prefix = f"{BUCKET}="
        for name in fs.list_dirs(rows.sparkSession, f"{root}/{at}"):
            if name.startswith(prefix):
                out.setdefault(name.removeprefix(prefix), []).append(f"{at}/{name}")
    return out


def _write_survivors(spark: SparkSession, root: str, folder: str, m: manifest.Manifest, added: dict[str, list[str]],
                     bucket: Column) -> dict[str, list[str]]:
    """Write the rows that a batch, written as ``added``, leaves of its buckets; rows of a key are in one bucket."""
    touched, kept = [b for b in added if m.entries.get(b)], {}
    slices = slices_of(spark, *(f"{root}/{p}" for b in touched for p in added[b] + m.entries[b]))
    for n in range(slices):
        own = [b for b in touched if int(b) % slices == n]
        if own:
            before, new = ([p for b in own for p in of[b]] for of in (m.entries, added))
            rows = survivors(_read(spark, root, m, before), _read(spark, root, m, new), m.facts["key"])
            kept |= _write(rows, root, f"{folder}/{n}" if slices > 1 else folder, bucket)
    return kept


def upsert(batch: DataFrame, root: str, key: str, cluster: Sequence[str] = (),
           clusters: int = CLUSTERS, per: int = PER_CLUSTER, slices: int = 1) -> str:
    """Upsert ``batch`` into the table at ``root`` (made if there is none); returns ``root``.

    ``cluster``, ``clusters`` and ``per`` lay out a new table; an existing one keeps its own.
    Null keys match nothing, so their rows are kept and added. ``slices``: of a batch that reads written tables,
    :func:`slices_of` these; they are read once per slice. Any other batch is computed once, in one slice.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    m = manifest.current(spark, root)
    if m is None:
        plain = batch.schema.json()
        m = manifest.Manifest(0, {}, {"schema": plain, "key": key, "cluster": list(cluster),
                                      "clusters": clusters, "per": per})
    elif m.facts["key"] != key:
        raise ValueError(f"the table's key is {m.facts['key']}")
    bucket = bucket_of(key, m.facts["cluster"], m.facts["clusters"], m.facts["per"])
    columns = [f["name"] for f in json.loads(m.facts["schema"])["fields"]]
    folder = f"{DATA}/w-{uuid.uuid4().hex[:12]}"
    try:
        with freed_shuffles(spark):
            by = [c for c in columns if c != key] or columns  # the key may be a digest, dear for rows of other slices
            added = _write(batch.select(*columns), root, f"{folder}/new", bucket, slices, by)
            kept = _write_survivors(spark, root, f"{folder}/kept", m, added, bucket)
        entries = m.entries | {b: paths + kept.get(b, []) for b, paths in added.items()}
        manifest.commit(spark, root, entries, m.facts)
    except BaseException:
        fs.delete(spark, f"{root}/{folder}")
        raise
    vacuum(spark, root, KEPT_VERSIONS)
    return root


def rewritten(spark: SparkSession, root: str) -> DataFrame:
    """(bucket, rewritten) of the newest version against the one before it; at most a row per bucket."""
    have = [m for m in (manifest.read(spark, root, v) for v in manifest.versions(spark, root)) if m]
    old = have[-2].entries if len(have) > 1 else {}
    return spark.createDataFrame([(int(b), old.get(b) != paths) for b, paths in have[-1].entries.items()],
                                 "bucket int, rewritten boolean")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Drop versions older than the newest ``keep`` and files that none of those lists."""
    return manifest.vacuum(spark, root, DATA, keep)
