"""Ranked reports over a cohort summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.bands import bucketize, cohort_label
from caseloom.operators.cohorts import cohort_prevalence
from caseloom.operators.filters import parsed_only
from caseloom.operators.ordered import number_rows
from caseloom.operators.shape import ordinal_of

_NUMBERS = {"cohort_size": "whole", "diabetes_count": "whole", "prevalence_rate": "double"}


def typed_summary(summary: DataFrame) -> DataFrame:
    """A cohort summary read back from text: numbers parsed, rows with a bad number left out."""
    return parsed_only(summary, _NUMBERS)


def top_ranked(df: DataFrame, n: int, *order: Column | str, name: str = "rank") -> DataFrame:
    """The first n rows in order, numbered from 1. The window sees only those n rows."""
    return df.orderBy(*order).limit(n).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def rank_cohorts(
    summary: DataFrame,
    n: int = spec.TOP_PROFILES,
    min_size: int = spec.MIN_COHORT_SIZE,
    exclude: Sequence[str] = ("location",),
    dimensions: Sequence[str] = tuple(spec.COHORT_DIMENSIONS),
) -> DataFrame:
    """The n cohorts with the highest rounded rate among those large enough, with readable labels.

    Ties: larger cohort, then dimension order, then value.
    """
    dimension = F.col("cohort_dimension")
    kept = summary.where((F.col("cohort_size") >= min_size) & ~dimension.isin(*exclude))
    order = (
        F.desc("prevalence_rate"),
        F.desc("cohort_size"),
        ordinal_of(dimension, dimensions),
        F.col("cohort_value"),
    )
    return top_ranked(kept, n, *order).select(
        "rank",
        cohort_label(dimension, F.col("cohort_value")).alias("cohort_label"),
        "cohort_size",
        "diabetes_count",
        "prevalence_rate",
    )


def rank_locations(
    summary: DataFrame, min_size: int = spec.MIN_COHORT_SIZE, dimension: str = "location"
) -> DataFrame:
    """Every large enough value of one dimension, numbered by rounded rate, then by name."""
    kept = summary.where((F.col("cohort_dimension") == dimension) & (F.col("cohort_size") >= min_size))
    renamed = kept.withColumnRenamed("cohort_value", dimension).select(
        dimension, "cohort_size", "diabetes_count", "prevalence_rate"
    )
    return number_rows(renamed, F.desc("prevalence_rate"), F.asc(dimension))


def top_groups(rates: DataFrame, n: int = 15) -> DataFrame:
    """The n groups with the highest percent rate, best first, ties by name."""
    return rates.orderBy(F.desc("rate"), "bucket").limit(n)


def stage_dimensions() -> Mapping[str, Column]:
    """Cohort dimensions that mix lab bands with demographic and lifestyle columns."""
    return {
        "hba1c_bucket": bucketize(F.col("hbA1c_level"), spec.HBA1C_STAGE),
        "glucose_bucket": bucketize(F.col("blood_glucose_level"), spec.GLUCOSE_STAGE),
        "age_bucket": bucketize(F.col("age"), spec.AGE_STAGE),
        "bmi_bucket": bucketize(F.col("bmi"), spec.BMI_STAGE),
        "hypertension": F.col("hypertension"),
        "heart_disease": F.col("heart_disease"),
        "smoking_history": F.col("smoking_history"),
        "gender": F.col("gender"),
    }


def top_profiles(
    df: DataFrame, n: int = 5, min_size: int = spec.MIN_COHORT_SIZE, dimensions: Mapping[str, Column] | None = None
) -> DataFrame:
    """The n cohorts with the highest unrounded percent rate over mixed dimensions."""
    dimensions = stage_dimensions() if dimensions is None else dimensions
    summary = cohort_prevalence(df, dimensions).where(
        F.col("cohort_value").isNotNull() & (F.col("cohort_size") >= min_size)
    )
    dimension = F.col("cohort_dimension")
    rated = summary.select(
        cohort_label(dimension, F.col("cohort_value")).alias("label"),
        F.col("cohort_size").alias("size"),
        F.col("diabetes_count").alias("diabetic"),
        (F.col("diabetes_count") / F.col("cohort_size") * 100).alias("rate"),
        ordinal_of(dimension, list(dimensions)).alias("_dimension"),
        F.col("cohort_value").alias("_value"),
    )
    order = (F.desc("rate"), F.desc("size"), F.col("_dimension"), F.col("_value"))
    return top_ranked(rated, n, *order).select("rank", "label", "size", "diabetic", "rate")
