"""Committed manifests: what a table, or a set of tables, consists of at each version.

Data files are written first, under names of their own, and never change. A version becomes
current by writing one small file, ``<root>/_manifest/<n>.json``, which lists what belongs to it.
A reader takes the newest complete manifest and from there on only the files that it lists, so it sees
the state before or after a commit, never a mixture or nothing. A version can list files of
an earlier one, so what did not change is not written again. Nothing is renamed; the file is created
only where it does not exist, so of two writers with the same base one gets
:class:`ConflictError` on file systems that create atomically.

Manifests are read and written on the driver; their size follows the number of listed folders
(marts, buckets), never the rows or files.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from indistar.sources import fs

FOLDER = "_manifest"
_NAME = re.compile(r"^(\d{8})\.json$")


class ConflictError(RuntimeError):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class Manifest:
    """``entries``: name -> folders, relative to the root; ``facts``: anything else that readers need."""

    version: int
    entries: dict[str, list[str]]
    facts: dict = field(default_factory=dict)


def _path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{version:08d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    names = fs.list_files(spark, f"{root.rstrip('/')}/{FOLDER}")
    return sorted(int(m.group(1)) for m in map(_NAME.match, names) if m)


def read(spark: SparkSession, root: str, version: int) -> Manifest | None:
    """The manifest, or None where its write was cut short."""
    try:
        got = json.loads(fs.read_text(spark, _path(root, version)))
        return Manifest(got["version"], got["entries"], got["facts"])
    except (json.JSONDecodeError, KeyError, TypeError):
        return None


def current(spark: SparkSession, root: str) -> Manifest | None:
    for v in reversed(versions(spark, root)):
        found = read(spark, root, v)
        if found:
            return found
    return None


def commit(spark: SparkSession, root: str, entries: dict[str, list[str]], facts: dict | None = None) -> Manifest:
    """Make ``entries`` the current state."""
    have = versions(spark, root)
    new = Manifest((have[-1] + 1) if have else 1, entries, facts or {})
    text = json.dumps({"version": new.version, "entries": new.entries, "facts": new.facts})
    if not fs.create_text(spark, _path(root, new.version), text):
        raise ConflictError(f"version {new.version} of {root} exists already")
    return new


def vacuum(spark: SparkSession, root: str, data: str | list[str], keep: int = 2) -> list[str]:
    """Drop all but the newest ``keep`` manifests, and what no remaining one lists.

    ``data`` names folders under the root whose sub-folders hold the data; the sub-folders that
    are listed nowhere, in part or whole, go (also those that a failed writer left). One
    writer at a time is assumed.
    """
    root = root.rstrip("/")
    kept, gone = [], []
    for v in reversed(versions(spark, root)):
        m = read(spark, root, v) if len(kept) < keep else None
        if m:
            kept.append(m)
        else:
            fs.delete(spark, _path(root, v))
            gone.append(_path(root, v))
    used = {p for m in kept for paths in m.entries.values() for p in paths}
    heads = {"/".join(p.split("/")[:k]) for p in used for k in range(1, p.count("/") + 1)}

    def sweep(folder: str) -> None:
        for name in fs.list_dirs(spark, f"{root}/{folder}"):
            here = f"{folder}/{name}"
            if here in used:
                continue
            if here in heads:
                sweep(here)
            else:
                fs.delete(spark, f"{root}/{here}")
                gone.append(here)
    for name in [data] if isinstance(data, str) else data:
        sweep(name.strip("/"))
    return gone
