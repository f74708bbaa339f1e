"""Sinks: JSON export (S5) and TTL result snapshots.

A snapshot is the Spark-side counterpart of the reference's cache-aside
store: a computed DataFrame is written once as a parquet folder of its own and
re-read while it is younger than the TTL.  A small manifest next to the versions, one
JSON file an entry, names the current one (see ``_Store``); a read lists and reads a
few files however often the snapshot was renewed.  Use a shared folder (for example under
``spark.checkpoint.dir``) on a cluster; a remote (Spark Connect) session has no file system here.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How long a version that was replaced stays readable.
RETENTION_SECONDS = 86_400
#: Entries kept behind the current one.
KEPT_ENTRIES = 8
#: Length of an entry's name up to its number.
ENTRY_PREFIX = len("part-") + 19
STAMP = "%Y%m%dT%H%M%S%f"


def to_json_rows(df: DataFrame, col: str = "json") -> DataFrame:
    """One JSON document per row; NULL fields are left out (like ``omitempty``)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(col))


def from_json_rows(df: DataFrame, schema, col: str = "json") -> DataFrame:
    """X12 decode: parse JSON documents back into columns of ``schema``."""
    return df.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows as JSON lines (one file per partition)."""
    df.write.mode(mode).json(path)


@dataclass(frozen=True)
class Commit:
    """An entry of a snapshot's manifest: the version it makes current, or marks expired."""
    seq: int
    name: str
    version: str
    created_at: _dt.datetime
    expired: bool


class _Store:
    """A snapshot's folder on the session's file system.

    A version is a folder of its own, written before any entry names it.  An
    entry becomes visible by one rename.  Entries carry a running number; of two with
    one number an expiry comes before a version, then the smaller name: all readers agree on the current one,
    whatever the order in which writers ran.  The file system needs no locks and no exclusive create.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.jvm = spark, path.rstrip("/"), spark.sparkContext._jvm
        root = self._hadoop(self.path)
        self.fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, folder: str, prefix: str) -> list:
        where = self._hadoop(folder)
        if not self.fs.exists(where):
            return []
        return [x for x in self.fs.listStatus(where) if x.getPath().getName().startswith(prefix)]

    def entries(self) -> list[str]:
        """Names of the entries, the current one first."""
        names = [x.getPath().getName() for x in self._names(f"{self.path}/_manifest", "part-")]
        top = max((n[:ENTRY_PREFIX] for n in names), default="")
        return sorted(n for n in names if n.startswith(top)) + sorted((n for n in names if not n.startswith(top)), reverse=True)

    def current(self) -> Commit | None:
        """The current entry; None only where there is none yet.  Lists one small folder and reads one file."""
        names = self.entries()
        if not names:
            return None
        stream = self.fs.open(self._hadoop(f"{self.path}/_manifest/{names[0]}"))
        try:
            row = json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Commit(int(names[0][5:ENTRY_PREFIX]), names[0], row["version"], _dt.datetime.fromisoformat(row["created_at"]), row["expired"])

    def commit(self, seq: int, version: str, created_at: _dt.datetime, expired: bool) -> Commit:
        name = f"part-{seq:019d}-{'a' if expired else 'b'}-{uuid.uuid4().hex}.json"
        hidden, shown = self._hadoop(f"{self.path}/_manifest/_{name}"), self._hadoop(f"{self.path}/_manifest/{name}")
        out = self.fs.create(hidden, False)
        try:
            out.write(json.dumps({"version": version, "created_at": created_at.isoformat(), "expired": expired}).encode())
        finally:
            out.close()
        if not self.fs.rename(hidden, shown):
            raise OSError(f"{shown} could not be committed")
        return Commit(seq, name, version, created_at, expired)

    def tidy(self, current: Commit, now: _dt.datetime, retention_seconds: float) -> None:
        """Drops entries that can no longer be current, and versions that were left behind longer than the retention ago."""
        for name in self.entries():
            if int(name[5:ENTRY_PREFIX]) < current.seq - KEPT_ENTRIES:
                self.fs.delete(self._hadoop(f"{self.path}/_manifest/{name}"), False)
        oldest = now - _dt.timedelta(seconds=retention_seconds)
        for folder in self._names(self.path, "v-"):
            name = folder.getPath().getName()
            idle = time.time() - folder.getModificationTime() / 1000 >= retention_seconds
            if name != current.version and idle and _dt.datetime.strptime(name.split("-")[1], STAMP) <= oldest:
                self.fs.delete(folder.getPath(), True)

    def read(self, commit: Commit) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{commit.version}")


def snapshot(spark: SparkSession, build: Callable[[], DataFrame], path: str, ttl_seconds: float, now: _dt.datetime,
             retention_seconds: float = RETENTION_SECONDS) -> tuple[DataFrame, bool]:
    """Return ``(frame, hit)``.

    Hit: the current version is younger than ``ttl_seconds`` at ``now`` and not
    expired; it is read back.  Miss: ``build()`` is computed, written as a new
    version, made current by one rename, and read back.  Of writers that finish at once one
    version becomes current for all of them, and never a mix of theirs.  Versions that were
    replaced are kept for ``retention_seconds``, for those who still read them.
    """
    store = _Store(spark, path)
    last = store.current()
    if last is not None and not last.expired and (now - last.created_at).total_seconds() < ttl_seconds:
        return store.read(last), True
    version = f"v-{now.strftime(STAMP)}-{uuid.uuid4().hex}"
    build().write.parquet(f"{store.path}/{version}")
    own = store.commit(last.seq + 1 if last else 1, version, now, False)
    current = store.current()
    store.tidy(current, now, retention_seconds)
    # a conflict: another writer's version, or an expiry that came between
    return store.read(own if current.expired else current), False


def expire_snapshot(spark: SparkSession, path: str, now: _dt.datetime) -> None:
    """Mark the current snapshot expired; the next read recomputes, also where a writer was at work meanwhile."""
    store = _Store(spark, path)
    last = store.current()
    if last is not None:
        store.commit(last.seq + 1, last.version, now, True)


def drop_cached(df: DataFrame) -> DataFrame:
    """S7 for in-session caching: release a persisted frame."""
    return df.unpersist()
