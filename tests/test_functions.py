"""Scalar functions on hand-made dirty values; expected results are written out."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions import bands, text


def values(spark, inputs, function, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


def test_missing_sets(spark):
    inputs = [None, "", " NA ", "n/a", "null", "none", "NaN", "unknown", "0", "\t "]
    profile = values(spark, inputs, lambda c: text.is_missing(c, spec.PROFILE_BLANKS))
    assert profile == [True] * 8 + [False, True]
    cleaning = values(spark, inputs, text.is_missing)
    assert cleaning == [True] * 7 + [False, False, True]


def test_parse_double(spark):
    inputs = ["12", " 1e3 ", "abc", "3d", "1_0", "_1", "1__0", "0x1p3", "-.5", "5.", "inf", "nan", "", None, " 7\t"]
    got = values(spark, inputs, text.parse_double)
    assert got == [12.0, 1000.0, None, None, 10.0, None, None, None, -0.5, 5.0, float("inf"), None, None, None, 7.0]


def test_parse_whole(spark):
    inputs = ["7", "2.0", "2.5", "x", "1e3", "12345678901234567", "1_000", "", None]
    assert values(spark, inputs, text.parse_whole) == [7, 2, None, None, 1000, 12345678901234567, 1000, None, None]


def test_flags(spark):
    inputs = ["0", "0.0", "1", " 1.0 ", "2", "", None]
    assert values(spark, inputs, text.parse_flag) == [0, 0, 1, 1, None, None, None]
    assert values(spark, inputs, text.flag_state) == ["0", "0", "1", "1", "INVALID", None, None]


def test_text_cleaning(spark):
    assert values(spark, [" a\t", "N/A", None, "unknown"], text.clean_text) == ["a", "Unknown", "Unknown", "unknown"]
    assert values(spark, [" 1 ", "null", None], text.keep_text) == ["1", "", ""]


def test_strip_takes_all_white_space(spark):
    inputs = ["\u00a0 a\u3000", "\x1c\x0b b c\r\n", "é ", "\t", None]
    assert values(spark, inputs, text.strip) == ["a", "b c", "é", "", None]


def test_smoking(spark):
    inputs = ["never", "ever", "Not Current", "No Info", "cigar", " current ", None]
    expected = ["Never", "Former", "Former", "Unknown", "Unknown", "Current", "Unknown"]
    assert values(spark, inputs, text.smoking_group) == expected


def test_normalize_line(spark):
    inputs = ["  a , No Info ,b \r", "x,no info,No info", "a, b"]
    assert values(spark, inputs, text.normalize_line) == ["a\tno_info\tb", "x\tno_info\tno_info", "a\tb"]


def test_fixed_text(spark):
    assert values(spark, [1.0, 0.12345, None], text.four_places, "double")[:1] == ["1.0000"]
    assert values(spark, [None], text.four_places, "double") == [None]


@pytest.mark.parametrize(
    "band, inputs, expected",
    [
        (spec.AGE_COHORT, [24.9, 25.0, 39.9, 55.0, 70.0, None], ["0-24", "25-39", "25-39", "55-69", "70+", "Unknown"]),
        (spec.BMI_COHORT, [18.4, 18.5, 25.0, 30.0, None], ["Underweight", "Normal", "Overweight", "Obese", "Unknown"]),
        (spec.HBA1C_RANGE, [5.69, 5.7, 6.5], list(spec.HBA1C_RANGE.labels)),
        (spec.AGE_STAGE, [-1.0, 0.0, 119.9, 120.0, None], [None, "children", "senior", None, None]),
        (spec.BMI_STAGE, [199.9, 200.0], ["obese", None]),
    ],
)
def test_bands(spark, band, inputs, expected):
    assert values(spark, inputs, lambda c: bands.bucketize(c, band), "double") == expected


def test_race(spark):
    rows = spark.createDataFrame(
        [("1", "0", "0"), ("0", "0.0", ""), ("1", "1.0", "0"), ("x", "0", "1.0")], "`race:A` string, `race:B` string, `race:C` string"
    )
    label = bands.race_from_flags({"race:A": "A", "race:B": "B", "race:C": "C"})
    assert [r.x for r in rows.coalesce(1).select(label.alias("x")).collect()] == ["A", "Unknown", "Multiple", "C"]


def test_tiers(spark):
    assert values(spark, [0.2001, 0.20, 0.08, 0.0799], bands.rate_tier, "double") == ["HI", "MID", "MID", "LO"]


def test_cohort_label(spark):
    rows = spark.createDataFrame(
        [("hypertension", "1.0"), ("heart_disease", "0"), ("race", "Asian"), ("year", "2019")], "d string, v string"
    )
    label = bands.cohort_label(F.col("d"), F.col("v"))
    got = [r.x for r in rows.coalesce(1).select(label.alias("x")).collect()]
    assert got == ["Hypertension: Yes", "Heart disease: No", "Race: Asian", "year: 2019"]


def test_risk_band(spark):
    got = values(spark, [0.1, 0.2, 0.3], lambda c: bands.risk_band(c, F.lit(0.2), F.lit(0.3)), "double")
    assert got == ["Low", "Medium", "High"]
