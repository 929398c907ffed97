"""The row-level result table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.bands import risk_band
from caseloom.operators.metrics import percentiles


def cut_offs(tuning: DataFrame, score: str = "score", low: float = 0.8, high: float = 0.9) -> DataFrame:
    """The two risk cut-offs, exact percentiles of the tuning scores, as columns low and high."""
    return percentiles(tuning, score, [low, high]).toDF("low", "high")


def with_risk_band(df: DataFrame, cuts: DataFrame, score: str = "score", name: str = "risk_band") -> DataFrame:
    """Band rows by one-row cut-offs read through a scalar subquery."""
    pair = cuts.select(F.struct("low", "high")).scalar()
    return df.withColumn(name, risk_band(F.col(score), pair.getField("low"), pair.getField("high")))


def final_table(
    banded: DataFrame,
    other_scores: DataFrame,
    measures: DataFrame,
    key: str = "row_id",
    label: str = spec.LABEL,
    score: str = "prob_diabetic",
    features: Sequence[str] = tuple(spec.FEATURES),
) -> DataFrame:
    """Join the calibrated score and band, the second model's score and the raw measures on a unique key.

    One key throughout, so the first join's partitioning serves the second.
    """
    first = banded.select(key, label, F.col(score).alias("lr_prob_calibrated"), "risk_band")
    second = other_scores.select(key, F.col(score).alias("rf_prob"))
    return first.join(second, key).join(measures.select(key, *features), key)


def key_loss(inputs: dict[str, DataFrame], result: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows of each input, of the result, and the rows lost between them."""
    kept = result.agg(F.count(key)).scalar()
    parts = [
        df.agg(F.count(key).alias("rows_in")).select(F.lit(name).alias("input"), "rows_in") for name, df in inputs.items()
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table.withColumn("rows_out", kept).withColumn("rows_lost", F.col("rows_in") - F.col("rows_out"))
