"""Tables derived from a ``CommitLog``, kept up commit by commit.

A derived table (a word index, zone maps, partial aggregates) has a log of its own under
``<table>/derived/<name>``.  Each of its commits names the folders of the table that it covers, so

* ``refresh`` reads only folders that no commit covers yet, all of them in one job;
* two refreshers at once cover no folder twice (the one that loses the version looks again);
* folders not covered yet are known, and a reader takes them from the table itself: an answer
  is whole whether or not the derived table is up to date.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpscope.sources.commit_log import MAX_ATTEMPTS, CommitLog


class Snapshot(NamedTuple):
    """What a reader sees: commits of the derived table, and the table's commits on both sides."""

    derived: list[dict]
    covered: list[dict]
    pending: list[dict]


def folder_name() -> Column:
    """The commit's folder that a row was read from."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)


class Derived:
    """``derive(rows)`` gives the derived rows of some commits' rows."""

    def __init__(self, table: CommitLog, name: str, derive: Callable[[DataFrame], DataFrame]):
        self.table, self.derive = table, derive
        self.log = CommitLog(table.spark, f"{table.path}/derived/{name}")

    def snapshot(self) -> Snapshot:
        derived = self.log.commits()              # before the table's: what it covers is in the table by then
        covers = {f for c in derived for f in c["covers"]}
        rows = [c for c in self.table.commits() if c["folder"]]
        return Snapshot(derived, [c for c in rows if c["folder"] in covers], [c for c in rows if c["folder"] not in covers])

    def refresh(self) -> int:
        """Cover every commit of the table; the number of folders taken in."""
        for _ in range(MAX_ATTEMPTS):
            seen = self.snapshot()
            if not seen.pending:
                return 0
            new = self.derive(self.table.read(seen.pending))
            folder, n = self.log.stage(new)
            version = seen.derived[-1]["version"] + 1 if seen.derived else 0
            if self.log.claim(version, {"batch": None, "folder": folder if n else None, "rows": n, "skipped": 0,
                                        "schema": new.schema.jsonValue(), "covers": [c["folder"] for c in seen.pending]}):
                return len(seen.pending)
        raise RuntimeError(f"no version of {self.log.path} could be claimed in {MAX_ATTEMPTS} attempts")

    def rows(self, seen: Snapshot) -> DataFrame | None:
        """Derived rows of the whole table: the stored ones, and those of pending folders computed
        now; None if the table has no rows."""
        stored = self.log.read(seen.derived)
        fresh = self.derive(self.table.read(seen.pending)) if seen.pending else None
        if stored is None or fresh is None:
            return stored if fresh is None else fresh
        return stored.unionByName(fresh)
