"""A job's steps, each done once, also when the job is killed and run again.

A ledger (:mod:`indistar.sources.manifest`) under the job's work root holds, for every finished step, its
output folder and a fingerprint of what it was made from: the fingerprints of the steps before it, parameters, the input's
version. A run that finds a step with the same fingerprint takes its output; any other step
writes to a folder of its own name and becomes finished by one commit. What a killed run has left
half-written is listed nowhere and goes when the next step commits. A run that completes closes the ledger, so
the next run does everything anew and its folders replace the old ones.

Steps may run in threads; commits are made one at a time. One job at a time per work root is assumed.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from indistar.sources import manifest

FOLDER = "steps"


@dataclass
class Steps:
    spark: SparkSession
    root: str
    #: Names of the steps that this run has really done, in order of completion.
    done: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self._lock = threading.Lock()
        m = manifest.current(self.spark, self.root)
        self.open = bool(m and m.facts.get("open"))
        self.entries = dict(m.entries) if m else {}
        self.prints = dict(m.facts["prints"]) if self.open else {}
        self.results = dict(m.facts["results"]) if self.open else {}

    def path(self, name: str) -> str:
        """The folder of a finished step."""
        return f"{self.root}/{self.entries[name][0]}"

    def fingerprint(self, name: str, made_from: list, after: tuple[str, ...]) -> str:
        text = json.dumps([name, made_from, [self.prints[a] for a in after]], default=str)
        return hashlib.md5(text.encode()).hexdigest()

    def _finish(self, name: str, print_: str, folder: str | None, result) -> None:
        with self._lock:
            if folder:
                self.entries[name] = [folder]
            self.prints[name], self.results[name] = print_, result
            self.done.append(name)
            self._commit(True)

    def _commit(self, open_: bool) -> None:
        facts = {"open": open_, "prints": self.prints, "results": self.results}
        manifest.commit(self.spark, self.root, self.entries, facts)

    def write(self, name: str, rows: Callable[[], DataFrame], made_from: list | None = None,
              after: tuple[str, ...] = ()) -> DataFrame:
        """The step that writes ``rows()``; its written table."""
        def write() -> str:
            folder = f"{FOLDER}/{name}/{uuid.uuid4().hex[:12]}"
            rows().write.parquet(f"{self.root}/{folder}")
            return folder
        print_ = self.fingerprint(name, made_from or [], after)
        if self.prints.get(name) != print_:
            self._finish(name, print_, write(), None)
        return self.spark.read.parquet(self.path(name))

    def call(self, name: str, action: Callable[[], object], made_from: list | None = None,
             after: tuple[str, ...] = ()):
        """A step with writes of its own, which must be harmless to repeat; its (JSON) result."""
        print_ = self.fingerprint(name, made_from or [], after)
        if self.prints.get(name) != print_:
            self._finish(name, print_, None, action())
        return self.results[name]

    def close(self) -> None:
        """The run is complete: the next one starts anew, and what no step holds goes."""
        with self._lock:
            self.prints, self.results = {}, {}
            self._commit(False)
            manifest.vacuum(self.spark, self.root, FOLDER, keep=1)
