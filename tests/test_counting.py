"""Heavy keys with proof, and calibration by sums."""

from __future__ import annotations

import math
import random

import pytest

from caseloom.operators import metrics, models, quality


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
@pytest.mark.parametrize("flat", [False, True])
def test_heavy_keys_equal_full_counts(spark, buckets, flat):
    rng = random.Random(buckets + flat)
    keys = [f" k{rng.randrange(300) if flat else int(rng.paretovariate(0.6))} " for _ in range(4000)] + [None] * 9
    df = spark.createDataFrame([(k,) for k in keys], "id string")
    counts = {}
    for k in keys:
        shown = k and k.strip()
        counts[shown] = counts.get(shown, 0) + 1
    expected = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    for top in (1, 5, 20, 5000):
        got = [tuple(r) for r in quality.key_repeats(df, "id", top, buckets).collect()]
        assert got == expected[:top], top
    assert [tuple(r) for r in quality.key_repeats(df, "id", None).collect()] == expected
    assert quality.key_repeats(df.limit(0), "id").collect() == []


def pairs(n, slope, shift, seed):
    rng = random.Random(seed)
    xs = [rng.random() for _ in range(n)]
    return [(x, int(rng.random() < 1 / (1 + math.exp(-(slope * x + shift))))) for x in xs]


def test_newton_equals_the_library_fit(spark):
    rows = pairs(4000, 7.0, -4.0, 2)
    df = spark.createDataFrame([*rows, (None, 1), (float("nan"), 0), (0.5, 2)], "prob_diabetic_raw double, diabetes int")
    slope, shift, steps = models.platt_newton(df)
    usable = df.where("diabetes < 2 AND prob_diabetic_raw < 2")
    fitted = models.fit_platt(usable, tol=1e-10, max_iter=200).stages[-1]
    assert slope == pytest.approx(fitted.coefficients[0], abs=1e-4) and shift == pytest.approx(fitted.intercept, abs=1e-4)
    assert steps < 12
    # At the optimum the mean probability is the share of positives.
    mean = models.apply_platt(usable, slope, shift).selectExpr("avg(prob_diabetic) AS p", "avg(diabetes) AS y").first()
    assert mean.p == pytest.approx(mean.y, abs=1e-9)


def test_calibration_without_an_optimum_is_an_error(spark):
    for rows in ([(0.1, 1), (0.9, 1)], [(0.5, 0), (0.5, 1)], []):
        with pytest.raises(ValueError):
            models.platt_newton(spark.createDataFrame(rows, "prob_diabetic_raw double, diabetes int"))


def test_rows_that_metrics_leave_out_are_counted(spark):
    rows = [(0, 0.1), (1, 0.9), (2, 0.5), (None, 0.5), (1, None), (1, float("nan")), (2, None)]
    df = spark.createDataFrame(rows, "diabetes int, score double")
    assert tuple(metrics.usable_rows(df).first()) == (7, 2, 3, 2)
