"""Committed versions of a folder: ``<root>/v=<n>/`` with Spark's ``_SUCCESS`` marker.

A version is written beside the others and becomes current when its write commits; nothing
is renamed or overwritten, so this holds on object stores too. A failed write is never
current. One writer per root is assumed.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from indistar.sources import fs

_VERSION = re.compile(r"^v=(\d+)$")


def committed(spark: SparkSession, root: str) -> list[int]:
    out = []
    for name in fs.list_dirs(spark, root):
        m = _VERSION.match(name)
        if m and fs.is_complete(spark, f"{root.rstrip('/')}/{name}"):
            out.append(int(m.group(1)))
    return sorted(out)


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:08d}"


def current_path(spark: SparkSession, root: str) -> str | None:
    have = committed(spark, root)
    return version_path(root, have[-1]) if have else None


def next_path(spark: SparkSession, root: str) -> str:
    """A free path for the next version; leftovers of a failed attempt are removed."""
    have = committed(spark, root)
    path = version_path(root, (have[-1] + 1) if have else 1)
    if fs.exists(spark, path):
        fs.delete(spark, path)
    return path


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Drop committed versions older than the newest ``keep``."""
    have = committed(spark, root)
    dropped = [version_path(root, v) for v in (have[:-keep] if keep > 0 else have)]
    for path in dropped:
        fs.delete(spark, path)
    return dropped
