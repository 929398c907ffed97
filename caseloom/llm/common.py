"""Helpers shared by the operators: reading tables, stored intermediates, word hashes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.sources.scratch import Scratch, session_scratch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_RUN: ContextVar[Scratch | None] = ContextVar("run", default=None)


@contextmanager
def intermediates(spark: SparkSession, label: str) -> Iterator[Scratch]:
    """A run of its own for an operator: what it stores inside goes when it ends, but for `lasting` tables.

    Those the result reads. They go with the run around this one if there is one, else with the session.
    """
    outer, run = _RUN.get(), Scratch(spark, label)
    mark = _RUN.set(run)
    try:
        with run:
            yield run
    finally:
        _RUN.reset(mark)
    if outer is not None:
        outer.adopt(run)


#: Spark's setting that removes the shuffle files of a finished query; it is set for the writes of `store` alone.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it again: cuts lineage, and outlives executors.

    Nothing else reads the shuffles of the write, so Spark may remove their files as soon as it ends.
    """
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        return (_RUN.get() or session_scratch(spark)).keep(df, label)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def drop(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more, where a run owns them."""
    run = _RUN.get()
    if run is not None:
        run.drop(*tables)


def lower_ascii(column):
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


LOWER = {i: i + 32 for i in range(65, 91)}


def mix64(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of unsigned integers."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def roll(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of `n` consecutive ids, in order; empty when there are fewer."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(ids) - n + 1, np.uint64)
        for k in range(n):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - n + 1 + k]
    return mix64(out)
