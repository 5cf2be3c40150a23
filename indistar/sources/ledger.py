"""Which input files have been processed, so that a run stages only new ones.

A committed record holds path, length, time of change and a digest of each file. A run lists its input; files that
the record holds unchanged are not opened. Of the others a digest is computed: a file that was only
touched or copied over itself is known by it and is recorded anew without being staged, a file with
other content is new. The record grows by one written folder per run, under a manifest
(:mod:`indistar.sources.manifest`), and is committed after the run's own writes: a run that
dies before it finds the same files pending again, and the keyed upsert makes repeating it harmless.

The listing and the record meet in a join; only the paths of files to be read come to the driver,
as a reader needs them there. Rows of a file that is replaced by another are upserted by key; keys that
it no longer holds keep their old rows. Missing files are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.sources import fs, manifest

SCHEMA = "path string, length long, modified timestamp, digest string"
DATA = "records"
FILES = "files"
#: Records of so many runs are merged into one folder.
MERGED_FROM = 20


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, length, modified of every non-empty file below ``path``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", "length", F.col("modificationTime").alias("modified")).where("length > 0"))


def digests(spark: SparkSession, files: list[str]) -> DataFrame:
    """path, digest of text files: their lines as a bag, as byte ranges differ between sessions."""
    parts = (spark.read.option("lineSep", "\n").text(files)
             .select(F.col("_metadata.file_path").alias("path"), F.xxhash64("value").alias("h"))
             .groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"),
                                  F.bit_xor("h").alias("x")))
    return parts.select("path", F.concat_ws("-", "n", "s", "x").alias("digest"))


def records(spark: SparkSession, root: str) -> DataFrame:
    """What has been processed: the newest record of every path."""
    m = manifest.current(spark, root)
    folders = [f"{root.rstrip('/')}/{p}" for p in (m.entries.get(FILES, []) if m else [])]
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    every = spark.read.schema(SCHEMA + ", run long").parquet(*folders)
    last = every.groupBy("path").agg(F.max(F.struct("run", "length", "modified", "digest")).alias("r"))
    return last.select("path", "r.length", "r.modified", "r.digest")


@dataclass
class Pending:
    """``files``: those to be read; ``rows``: what :func:`commit` will record (written)."""

    files: list[str]
    folder: str | None


def pending(spark: SparkSession, root: str, path: str) -> Pending:
    """Files under ``path`` that are not in the record at ``root``."""
    root = root.rstrip("/")
    known = records(spark, root)
    here = listing(spark, path)
    unseen = here.join(known, ["path", "length", "modified"], "left_anti").select("path", "length", "modified")
    candidates = [r[0] for r in unseen.select("path").collect()]
    if not candidates:
        return Pending([], None)
    m = manifest.current(spark, root)
    run = m.version + 1 if m else 1
    folder = f"{DATA}/r-{uuid.uuid4().hex[:12]}"
    (unseen.join(digests(spark, candidates), "path").withColumn("run", F.lit(run).cast("long"))
     .write.parquet(f"{root}/{folder}"))
    new = (spark.read.schema(SCHEMA).parquet(f"{root}/{folder}")
           .join(known.select("path", "length", "digest"), ["path", "length", "digest"], "left_anti"))
    return Pending(sorted(r[0] for r in new.select("path").collect()), folder)


def commit(spark: SparkSession, root: str, p: Pending) -> None:
    """Record the pending files as processed."""
    if p.folder is None:
        return
    root = root.rstrip("/")
    m = manifest.current(spark, root)
    folders = [*(m.entries.get(FILES, []) if m else []), p.folder]
    if len(folders) >= MERGED_FROM:
        merged = f"{DATA}/r-{uuid.uuid4().hex[:12]}"
        every = spark.read.schema(SCHEMA + ", run long").parquet(*(f"{root}/{f}" for f in folders))
        (every.groupBy("path").agg(F.max(F.struct("run", "length", "modified", "digest")).alias("r"))
         .select("path", "r.length", "r.modified", "r.digest", "r.run").write.parquet(f"{root}/{merged}"))
        folders = [merged]
    manifest.commit(spark, root, {FILES: folders})
    manifest.vacuum(spark, root, DATA, keep=1)


def discard(spark: SparkSession, root: str, p: Pending) -> None:
    """Drop what a run that failed would have recorded."""
    if p.folder:
        fs.delete(spark, f"{root.rstrip('/')}/{p.folder}")
