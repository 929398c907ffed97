"""What a run has finished, so that a run started again goes on where it was lost."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Number, and a sum of hashes of name, length and time, of the files under each path; no file is opened."""
    parts = []
    for path in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        one = files.agg(F.count("*").alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")).alias("h")).first()
        parts.append(f"{path}:{one['n']}:{one['h']}")
    return "|".join(parts)


class Ledger:
    """A record per step under `folder`: what it read, and what it left behind.

    A step counts as done if the files it read and the files it wrote are those of its record, so a
    changed source, a lost output or a step before it that ran anew makes it run again. The record is
    written last: a step cut off in the middle has none.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.ran: list[str] = []

    def _recorded(self, name: str) -> dict:
        try:
            row = self.spark.read.text(f"{self.folder}/{name}").first()
        except AnalysisException:
            return {}
        return json.loads(row.value) if row else {}

    def _seen(self, paths: Sequence[str]) -> str | None:
        try:
            return fingerprint(self.spark, *paths)
        except AnalysisException:  # something is not there
            return None

    def step(self, name: str, reads: Sequence[str], writes: Sequence[str], run: Callable[[], None]) -> bool:
        """Run a step unless it is done; returns whether it ran."""
        before = fingerprint(self.spark, *reads)
        record = self._recorded(name)
        if record and record["read"] == before and record["wrote"] == self._seen(writes):
            return False
        run()
        record = json.dumps({"read": before, "wrote": fingerprint(self.spark, *writes)})
        self.spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{name}")
        self.ran.append(name)
        return True
