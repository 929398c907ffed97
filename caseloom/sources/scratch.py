"""Intermediate tables that belong to one run and go away with it."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the driver and all executors see.

    `spark.checkpoint.dir` of the session, else the session's warehouse. A cluster on which neither
    is set has no such folder, and that is an error rather than a local folder of each machine.
    """
    given = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or given.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (given.contains("spark.sql.warehouse.dir") or spark.sparkContext.master.startswith("local")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


class Scratch:
    """Tables written under one folder of the shared storage.

    `keep` writes a table and returns it read back, so lineage is cut, an executor may be lost, and a
    later plan begins at a file scan that is pruned and filtered like any other. `drop` removes one
    table as soon as its last reader is done; leaving the `with` block, or `close`, removes all of
    them. A table handed out to a caller that reads it later stays until the session's JVM ends, or
    until that caller closes the run: use `lasting` for those.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/scratch-{label}-{uuid.uuid4().hex}"
        self._tables: dict[int, tuple[DataFrame, str]] = {}
        self._lasting: list[str] = []
        self._adopted: list[Scratch] = []
        # Should the session end in the middle of a run, the file system removes the folder.
        self._system(self.folder).deleteOnExit(self._path(self.folder))

    def keep(self, df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write `df` as Parquet and return the stored table."""
        path = f"{self.folder}/{label}-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._tables[id(stored)] = stored, path  # held, so that its id stays its own
        return stored

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that no later plan reads."""
        for table in tables:
            self._delete(self._tables.pop(id(table))[1])

    def lasting(self, df: DataFrame, label: str) -> DataFrame:
        """`keep` for a table that outlives the `with` block because the result reads it."""
        stored = self.keep(df, label)
        self._lasting.append(self._tables[id(stored)][1])
        return stored

    def adopt(self, run: Scratch) -> None:
        """Let the lasting tables of an ended run go with this one."""
        self._adopted.append(run)

    def close(self, all: bool = True) -> None:
        """Remove the run's tables; the lasting ones only if `all`."""
        if all or not (self._lasting or self._adopted):
            self._delete(self.folder)
            self._lasting = []
            for run in self._adopted:
                run.close()
            self._adopted = []
        else:
            for _, path in self._tables.values():
                if path not in self._lasting:
                    self._delete(path)
        self._tables = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        self.close(all=kind is not None)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _delete(self, path: str) -> None:
        self._system(path).delete(self._path(path), True)


_SESSIONS: dict[str, Scratch] = {}
_LOCK = threading.Lock()


def session_scratch(spark: SparkSession) -> Scratch:
    """The run of a whole application, for tables that returned plans read; they go when it ends."""
    application = spark.sparkContext.applicationId
    with _LOCK:  # plans may run in more than one thread
        if application not in _SESSIONS:
            _SESSIONS.clear()
            _SESSIONS[application] = Scratch(spark, "session")
        return _SESSIONS[application]
