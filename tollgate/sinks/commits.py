"""What a set of tables consists of, as versions of one small document.

Data files are written under names of their own and mean nothing until a version names them.
A version is one file that is created whole or not at all, so a reader sees what was there
before or all that is new, whatever a writer was doing when it died; a second writer that
started from the same version is refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import SparkSession

from tollgate.refusals import CommitConflict
from tollgate.sinks import folders

KEEP = 10


class Commits:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in folders.names(self.spark, self.path) if re.fullmatch(r"\d{20}\.json", n)]

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:020d}.json"

    def read(self, version: int) -> dict:
        return json.loads(folders.read_text(self.spark, self._file(version)))

    def latest(self) -> tuple[int, dict]:
        """The newest version and what it says; 0 and nothing where there is none."""
        found = self._versions()
        return (found[-1], self.read(found[-1])) if found else (0, {})

    def commit(self, seen: int, state: dict) -> int:
        """Makes ``state`` the version after ``seen``; refuses if another writer has."""
        version = seen + 1
        if not folders.create_text(self.spark, self._file(version), json.dumps(state, sort_keys=True)):
            raise CommitConflict(f"{self.path}: version {version} was written by another run")
        for old in self._versions()[:-KEEP]:
            folders.remove(self.spark, self._file(old))
        return version

    def forget(self, kept: Callable[[dict], set[str]], root: str) -> list[str]:
        """Removes the folders under root that no version names any more (kept: the names in a version), for when no writer is at work."""
        named = set().union(*[kept(self.read(v)) for v in self._versions()])
        gone = [n for n in folders.names(self.spark, root) if n not in named and not n.startswith((".", "_SUCCESS"))]
        for n in gone:
            folders.remove(self.spark, f"{root}/{n}")
        return gone
