"""Publishing and reading back the marts.

N05  views: a model is a lazy DataFrame, registered under its name
N06  table materialisation: full rebuild, written as Parquet
N09  one Parquet dataset per mart, replaced on every run by one commit for all marts
N10  output prefix: '/' stripped at both ends; an empty prefix writes at the root
N11  listing of what was published (file metadata only, no content read)
N12  ad-hoc SQL over the published tables

Exports are written by all tasks in parallel (a folder of part files); nothing
is coalesced to one file or routed through the driver. A mart at ``<prefix>/<name>.parquet`` is
written to a new folder below that and shown by a manifest beside the marts
(:mod:`indistar.sources.manifest`), so readers find the old marts or the new ones, never none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.sources import fs, manifest

#: Versions of the published marts that are kept, for readers that have begun.
KEPT_VERSIONS = 2


def output_prefix(prefix: str | None) -> str:
    """No '/' at either end."""
    return (prefix or "").strip("/")


def output_uri(root: str, prefix: str | None, name: str) -> str:
    """Where mart ``name`` is published: ``<root>/<prefix>/<name>.parquet``."""
    key_prefix = output_prefix(prefix)
    root = root.rstrip("/")
    if key_prefix:
        return f"{root}/{key_prefix}/{name}.parquet"
    return f"{root}/{name}.parquet"


def _home(root: str, prefix: str | None) -> str:
    key_prefix = output_prefix(prefix)
    return f"{root.rstrip('/')}/{key_prefix}" if key_prefix else root.rstrip("/")


def stage(df: DataFrame, root: str, prefix: str | None, name: str) -> str:
    """Write a mart to its final place, not yet visible; returns the folder."""
    folder = f"{output_uri(root, prefix, name)}/v={uuid.uuid4().hex[:12]}"
    df.write.parquet(folder)
    return folder


def commit(spark: SparkSession, root: str, prefix: str | None, staged: Mapping[str, str]) -> dict[str, str]:
    """Make the staged marts the published ones, all at once; returns their URIs.

    Marts that are not among them stay as they are. Older folders stay for readers that have begun, one version long.
    """
    home = _home(root, prefix)
    before = manifest.current(spark, home)
    entries = dict(before.entries) if before else {}
    entries.update({name: [folder.removeprefix(f"{home}/")] for name, folder in staged.items()})
    manifest.commit(spark, home, entries)
    manifest.vacuum(spark, home, [f"{name}.parquet" for name in entries], KEPT_VERSIONS)
    return {name: output_uri(root, prefix, name) for name in staged}


def publish(df: DataFrame, root: str, prefix: str | None, name: str) -> str:
    """Publish one mart in place of the one before; returns its URI."""
    return publish_all({name: df}, root, prefix)[name]


def publish_all(marts: Mapping[str, DataFrame], root: str, prefix: str | None,
                workers: int = 4) -> dict[str, str]:
    """Publish every mart; the independent writes run as concurrent jobs, one commit shows them all.

    If a write fails, nothing is published and what the others wrote is removed.
    """
    spark = next(iter(marts.values())).sparkSession
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(stage, df, root, prefix, name) for name, df in marts.items()}
    failed = [f.exception() for f in futures.values() if f.exception()]
    if failed:
        discard(spark, [f.result() for f in futures.values() if not f.exception()])
        raise failed[0]
    return commit(spark, root, prefix, {name: f.result() for name, f in futures.items()})


def discard(spark: SparkSession, folders: Iterable[str]) -> None:
    """Remove staged marts that will not be published."""
    for folder in folders:
        fs.delete(spark, folder)


def current_path(spark: SparkSession, uri: str) -> str:
    """The folder that holds the published rows of the mart at ``uri``."""
    home, _, name = uri.rstrip("/").rpartition("/")
    m = manifest.current(spark, home)
    entry = (m.entries if m else {}).get(name.removesuffix(".parquet"))
    if not entry:
        raise FileNotFoundError(f"nothing published at {uri}")
    return f"{home}/{entry[0]}"


def read_mart(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, uri))


def register_views(spark: SparkSession, tables: Mapping[str, str | DataFrame]) -> list[str]:
    """Register each table (a mart's URI or a DataFrame) as a temp view."""
    for name, source in tables.items():
        df = read_mart(spark, source) if isinstance(source, str) else source
        df.createOrReplaceTempView(name)
    return list(tables)


def adhoc_sql(spark: SparkSession, tables: Mapping[str, str | DataFrame], query: str) -> DataFrame:
    """Run ``query`` over the published tables registered by name."""
    register_views(spark, tables)
    return spark.sql(query)


def register_tables(spark: SparkSession, uris: Mapping[str, str], statistics: bool = True) -> list[str]:
    """The published marts as external tables of the session's catalog, with statistics.

    A table points at the folder that is published now; its row count and its columns' statistics are computed once
    (a pass over the mart) and let the planner estimate joins and filters (``spark.sql.cbo.enabled``).
    Register again after a publish.
    """
    for name, uri in uris.items():
        folder = current_path(spark, uri).replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        spark.sql(f"CREATE TABLE `{name}` USING parquet LOCATION '{folder}'")
        if statistics:
            spark.sql(f"ANALYZE TABLE `{name}` COMPUTE STATISTICS FOR ALL COLUMNS")
    return list(uris)


def inventory(spark: SparkSession, root: str, prefix: str | None = None) -> DataFrame:
    """Files published under the prefix, aggregated per mart.

    Only folders of the current manifest are listed. The binary-file source lists their files
    recursively; selecting only ``path``/``length`` prunes the ``content`` column, so no file is read.
    Hidden files (commit markers, checksums) are not listed.
    """
    home = _home(root, prefix)
    m = manifest.current(spark, home)
    folders = [f"{home}/{p}" for paths in (m.entries.values() if m else ()) for p in paths]
    if not folders:
        return spark.createDataFrame([], "mart string, n_files long, total_bytes long, last_modified timestamp")
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", True)
             .load(folders)
             .select("path", "length", "modificationTime"))
    return (files
            .withColumn("mart", F.regexp_extract("path", r"/([^/]+)\.parquet/", 1))
            .groupBy("mart")
            .agg(F.count(F.lit(1)).alias("n_files"),
                 F.sum("length").alias("total_bytes"),
                 F.max("modificationTime").alias("last_modified")))
