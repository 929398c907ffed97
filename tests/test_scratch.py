"""Intermediate tables: where they go, when they go."""

from __future__ import annotations

import os

import pytest

from caseloom.sources.scratch import Scratch, shared_folder


def tables(run):
    folder = run.folder.removeprefix("file:")
    return sorted(name.split("-")[0] for name in os.listdir(folder)) if os.path.isdir(folder) else []


def test_tables_go_when_their_reader_is_done(spark):
    with Scratch(spark, "test") as run:
        first = run.keep(spark.range(10).selectExpr("id", "id % 2 AS odd"), "first")
        second = run.keep(first.where("odd = 1"), "second")
        run.drop(first)
        assert tables(run) == ["second"] and second.count() == 5
        assert run.folder.startswith(shared_folder(spark)) and spark.conf.get("spark.checkpoint.dir") in run.folder
    assert tables(run) == []


def test_what_the_result_reads_stays_until_closed(spark):
    with Scratch(spark, "test") as run:
        run.keep(spark.range(3), "passing")
        result = run.lasting(spark.range(4), "result").where("id > 0")
    assert tables(run) == ["result"] and result.count() == 3
    run.close()
    assert tables(run) == []


def test_a_failed_run_leaves_nothing(spark):
    with pytest.raises(ZeroDivisionError), Scratch(spark, "test") as run:
        run.lasting(spark.range(4), "result")
        1 / 0  # noqa: B018
    assert tables(run) == []


def test_stored_tables_are_pruned_scans(spark):
    with Scratch(spark, "test") as run:
        stored = run.keep(spark.range(10).selectExpr("id", "id % 3 AS part", "'x' AS wide"), "wide", ["part"])
        plan = stored.where("part = 1 and id > 4").select("id")._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<id:bigint>" in plan and "PartitionFilters: [isnotnull(part" in plan
        assert "GreaterThan(id,4)" in plan
