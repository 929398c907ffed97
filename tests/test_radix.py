"""Order statistics by counting, exact percentiles and exact stratified shares."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import metrics, splits
from caseloom.operators.radix import code_double, codes_at, double_code
from caseloom.sources.scratch import Scratch

HARD = [0.0, -0.0, 1.0, -1.0, 1.5, 2.0**-1022, 2.0**-1074, -(2.0**-1074), 2.0**-1030, 1e308, -1e308, 0.1, 0.1 + 2**-56,
        1 - 2**-53, 1 + 2**-52, 2.0**1023, float("inf"), float("-inf"), 3.141592653589793, 8.0, 7.999999999999999]


def test_codes_order_as_doubles_do(spark):
    rng = random.Random(3)
    values = HARD + [math.ldexp(rng.uniform(-1, 1), rng.randrange(-1070, 1020)) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", double_code(F.col("v")).alias("code")).withColumn("back", code_double(F.col("code"))).collect()
    assert all(r.back == r.v for r in rows)
    ordered = sorted(rows, key=lambda r: r.v)
    assert all((a.code < b.code) == (a.v < b.v) for a, b in zip(ordered, ordered[1:]))
    none = spark.createDataFrame([(None,), (float("nan"),)], "v double").select(double_code(F.col("v")).alias("c"))
    assert [r.c for r in none.collect()] == [None, None]


@pytest.mark.parametrize("bits, step", [(64, 16), (60, 15), (60, 20)])
def test_codes_at_ranks_equal_sorting(spark, bits, step):
    rng = random.Random(bits + step)
    low = -(1 << 63) if bits == 64 else 0
    data = {g: [rng.randrange(low, 1 << (bits - (bits == 64))) if rng.random() < 0.7 else 7 for _ in range(n)] for g, n in (("a", 400), ("b", 1))}
    rows = spark.createDataFrame([(g, c) for g, codes in data.items() for c in codes], "group string, code long").repartition(5)
    ranks = [("a", f"r{i}", i) for i in (0, 1, 57, 200, 201, 399, 400)] + [("b", "r0", 0), ("b", "r1", 1), ("c", "r0", 0)]
    with Scratch(spark, "test") as run:
        got = codes_at(rows, spark.createDataFrame(ranks, "group string, name string, rank long"), run, bits=bits, step=step).collect()
    expected = {}
    for g, name, rank in ranks:
        if rank < len(data.get(g, ())):
            code = sorted(data[g])[rank]
            expected[g, name] = (code, sum(c < code for c in data[g]))
    assert {(r.group, r.name): (r.code, r.smaller) for r in got} == expected


def test_percentiles_with_infinities_and_ties(spark):
    values = [float("-inf"), -2.0, -2.0, 0.0, 1.0, 1.0, 1.0, 5.0, float("inf"), float("inf")]
    shares = [0.0, 0.1, 0.25, 0.5, 0.8, 0.95, 1.0]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    finite = [v for v in values if math.isfinite(v)]
    got = metrics.percentiles(df.where("abs(v) < 100"), "v", shares).first()
    assert list(got) == [float(np.percentile(finite, 100 * s)) for s in shares]
    expected = []
    for share in shares:
        place = (len(values) - 1) * share
        low, high = sorted(values)[math.floor(place)], sorted(values)[math.ceil(place)]
        expected.append(low if low == high else low + (high - low) * (place - math.floor(place)))
    np.testing.assert_array_equal(list(metrics.percentiles(df, "v", shares).first()), expected)
    assert list(metrics.percentiles(df.where("v IS NULL"), "v", [0.5]).first()) == [None]
    plan = metrics.percentiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def quotas(n, weights=(0.7, 0.1, 0.2)):
    ends = [math.floor(n * round(sum(weights[: i + 1]), 12) + 0.5) for i in range(3)]
    return [b - a for a, b in zip([0, *ends], ends)]


def test_classes_are_split_in_exact_shares(spark):
    rows = [(i, y) for y, n in ((0, 997), (1, 103), (2, 1), (None, 20)) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, diabetes int")
    got = {(r.row_id, r.diabetes): r.split for r in splits.stratified_split(df).collect()}
    assert got == {(r.row_id, r.diabetes): r.split for r in splits.stratified_split(df.repartition(9)).collect()}
    assert len(got) == len(rows)

    def draw(i, y):
        return int(hashlib.md5(f"{i}:{'' if y is None else y}:42".encode()).hexdigest()[:15], 16)

    for y, n in ((0, 997), (1, 103), (2, 1), (None, 20)):
        ordered = sorted(range(n), key=lambda i: draw(i, y))
        parts = [got[i, y] for i in ordered]
        expected = [p for p, k in zip(("train", "calibration", "test"), quotas(n)) for _ in range(k)]
        assert parts == expected


def test_splits_keep_columns_and_take_any_weights(spark):
    df = spark.createDataFrame([(1, 0, "old", 5)], "row_id long, diabetes int, split string, _draw int")
    out = splits.stratified_split(df, weights={"one": 1.0}, name="part")
    assert out.columns == [*df.columns, "part"] and out.first().part == "one"
    halves = splits.stratified_split(df.drop("_draw"), weights={"a": 1.0, "b": 0.0})
    assert halves.columns == ["row_id", "diabetes", "split"] and halves.first().split == "a"
    assert splits.stratified_split(df.drop("_draw").limit(0)).collect() == []
