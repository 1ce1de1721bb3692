"""A table of Parquet folders under a versioned commit log: keys stay unique under concurrent and
repeated writes.

    path/data/<id>/part-*.parquet     folders of rows, visible once committed
    path/_log/<version>.json          one commit each: folder, rows, skipped, and the batch it came from

A writer reads the log, writes the rows whose keys it lacks to a folder of its own, and claims the
next version by creating its file - which the file system grants to one writer only.  The loser
reads what was committed meanwhile, takes those keys out of its rows (only the new folders are read)
and tries the next version.  A commit may carry the name of its batch; a batch that the log names
already adds nothing, so a writer may be ended anywhere and run again.

A folder that no commit names (its writer was ended) is never read.  The claim needs a file system
where creating a link or a rename fails if the target exists: local ones and HDFS-like ones do; an
object store without conditional writes does not.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpscope.operators.ingest import new_rows
from chirpscope.session import scratch_path

#: Attempts to claim a version; each failure means that another writer got one.
MAX_ATTEMPTS = 1000


class _Files:
    """The few calls on the table's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(path).getFileSystem(self.conf)
        self.local = self.fs.getUri().getScheme() == "file"

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Create ``path`` with its whole content at once; False if it exists."""
        draft = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
        out = self.fs.create(self._path(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self.local:
                os.link(urlparse(draft).path, urlparse(path).path)
            else:
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
                none = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                context.rename(self._path(draft), self._path(path), none)      # no options: fails if the target exists
            return True
        except FileExistsError:
            return False
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        finally:
            self.fs.delete(self._path(draft), False)


class CommitLog:
    """One table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _Files(spark, self.path)

    def _name(self, version: int) -> str:
        return f"{self.path}/_log/{version:020d}.json"

    def commits(self, after: int = -1) -> list[dict]:
        """Commits above version ``after``, in order."""
        versions = sorted(int(n.removesuffix(".json")) for n in self.files.names(f"{self.path}/_log")
                          if n.endswith(".json") and n[0] != ".")
        return [json.loads(self.files.read(self._name(v))) for v in versions if v > after]

    def exists(self) -> bool:
        return bool(self.files.names(f"{self.path}/_log"))

    def folders(self, commits: Sequence[dict]) -> list[str]:
        return [f"{self.path}/data/{c['folder']}" for c in commits if c["folder"]]

    def read(self, commits: Sequence[dict] | None = None) -> DataFrame | None:
        """The committed rows (of these commits); None if there is no commit yet."""
        commits = self.commits() if commits is None else commits
        if not commits:
            return None
        schema = T.StructType.fromJson(commits[0]["schema"])
        folders = self.folders(commits)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def stage(self, rows: DataFrame) -> tuple[str, int]:
        """Write rows to a folder of their own: its name and their number."""
        folder, seen = uuid.uuid4().hex, Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/data/{folder}")
        return folder, int(seen.get["n"])

    def claim(self, version: int, commit: dict) -> bool:
        """Commit as ``version``; False if another writer has it."""
        return self.files.create(self._name(version), json.dumps(commit | {"version": version}))

    def insert(self, batch: DataFrame, key: str, order=(), batch_id: str | None = None) -> dict:
        """Commit the rows of ``batch`` whose key is not in the table, the first in ``order`` of a
        repeated key: {"inserted", "skipped"}.  A batch that the log names returns its counts with
        ``"repeated": True`` and adds nothing."""
        known = self.commits()
        done = _of_batch(known, batch_id)
        if done:
            return done
        raw, seen = scratch_path(self.spark, "insert-batch"), Observation()       # read twice, computed once
        batch.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(raw)
        keys = self.read(known)
        fresh = new_rows(self.spark.read.schema(batch.schema).parquet(raw), None if keys is None else keys.select(key), key, order,
                         sum(c["rows"] for c in known))
        return self._commit(fresh, key, int(seen.get["n"]), known, {"batch": batch_id})

    def append_new(self, rows: DataFrame, key: str, batch_id: str, writer: str, base: int) -> dict:
        """Commit ``rows`` of one micro-batch of the stream ``writer``, which knows by its own state that
        their keys are neither in version ``base`` nor in its own commits.  Only what other writers
        committed since then is read."""
        known = self.commits()
        done = _of_batch(known, batch_id)
        if done:
            rows.write.format("noop").mode("overwrite").save()      # the stream's state has to move on all the same
            return done
        others = self.read([c for c in known if c["version"] > base and c.get("writer") != writer])
        fresh = rows if others is None else rows.join(others.select(key), on=key, how="left_anti").select(*rows.columns)
        return self._commit(fresh, key, None, known, {"batch": batch_id, "writer": writer, "base": base})

    def base_of(self, writer: str) -> int | None:
        """The version that the state of a stream began with; None if it has committed nothing yet."""
        return next((c["base"] for c in self.commits() if c.get("writer") == writer), None)

    def _commit(self, fresh: DataFrame, key: str, total: int | None, known: list[dict], names: dict) -> dict:
        schema = fresh.schema
        folder, n = self.stage(fresh)
        for _ in range(MAX_ATTEMPTS):
            version = known[-1]["version"] + 1 if known else 0
            skipped = 0 if total is None else total - n
            if self.claim(version, names | {"folder": folder if n else None, "rows": n, "skipped": skipped, "schema": schema.jsonValue()}):
                return {"inserted": n, "skipped": skipped}
            later = self.commits(version - 1)
            done = _of_batch(later, names["batch"])
            if done:
                return done
            known += later
            others = self.read(later)
            if n and others is not None:
                own = self.spark.read.schema(schema).parquet(f"{self.path}/data/{folder}")
                left = own.join(others.select(key), on=key, how="left_anti").select(*schema.names)
                if left.count() < n:
                    folder, n = self.stage(left)
        raise RuntimeError(f"no version of {self.path} could be claimed in {MAX_ATTEMPTS} attempts")


def _of_batch(commits: list[dict], batch_id: str | None) -> dict | None:
    for c in commits:
        if batch_id is not None and c["batch"] == batch_id:
            return {"inserted": c["rows"], "skipped": c["skipped"], "repeated": True}
    return None
