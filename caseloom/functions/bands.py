"""Banding of measures, flags and scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.text import lookup, parse_flag


def bucketize(c: Column, bands: spec.Bands) -> Column:
    """Label of the left-closed band holding `c`.

    NULL gives the null label; a value under `low` or at or over `top` gives NULL.
    """
    chain = F.when(c.isNull(), F.lit(bands.null_label))
    if bands.low is not None:
        chain = chain.when(c < F.lit(float(bands.low)), F.lit(None))
    for edge, label in zip(bands.edges, bands.labels):
        chain = chain.when(c < F.lit(float(edge)), F.lit(label))
    if bands.top is None:
        return chain.otherwise(F.lit(bands.labels[-1]))
    return chain.when(c < F.lit(float(bands.top)), F.lit(bands.labels[-1]))


def race_from_flags(flags: Mapping[str, str]) -> Column:
    """One label from one-hot columns: Unknown if none is set, Multiple if several are.

    The flags become the bits of one number, so each column is parsed once.
    """
    bits = [F.coalesce(parse_flag(F.col(f"`{name}`")), F.lit(0)) * (1 << i) for i, name in enumerate(flags)]
    names = {0: "Unknown"} | {1 << i: label for i, label in enumerate(flags.values())}
    return lookup(sum(bits, F.lit(0)), names, "Multiple")


def rate_tier(rate: Column, high: float = 0.20, middle: float = 0.08) -> Column:
    """HI above `high`, MID from `middle`, LO below."""
    return F.when(rate > high, "HI").when(rate >= middle, "MID").otherwise("LO")


def lab_outlier(hba1c: Column, glucose: Column, hba1c_over: float = 8.0, glucose_over: float = 200.0) -> Column:
    """True where either lab value is over its limit."""
    return (hba1c > hba1c_over) | (glucose > glucose_over)


def comorbidity_flag(first: Column, second: Column) -> Column:
    """1 where both conditions hold."""
    return F.coalesce(((first == 1) & (second == 1)).cast("int"), F.lit(0))


def comorbidity_tier(hypertension: Column, heart_disease: Column) -> Column:
    """One of four tiers from two condition flags."""
    none, first, second, both = spec.COMORBIDITY_TIERS
    return (
        F.when((hypertension == 1) & (heart_disease == 1), both)
        .when(hypertension == 1, first)
        .when(heart_disease == 1, second)
        .otherwise(none)
    )


def risk_band(score: Column, low: Column, high: Column) -> Column:
    """Low, Medium or High from two inclusive cut-offs."""
    names = spec.RISK_BANDS
    return F.when(score >= high, names[2]).when(score >= low, names[1]).otherwise(names[0])


def predicted(score: Column, threshold: Column | float) -> Column:
    """1 where the score reaches the threshold."""
    return (score >= threshold).cast("int")


def cohort_label(dimension: Column, value: Column, titles: Mapping[str, str] = spec.COHORT_TITLES) -> Column:
    """Readable 'Title: value' text; condition flags read Yes or No, unknown dimensions keep their name."""
    answer = F.when(parse_flag(value) == 1, "Yes").otherwise("No")
    shown = F.when(dimension.isin(*spec.YES_NO_DIMENSIONS), answer).otherwise(value)
    title = F.coalesce(lookup(dimension, titles), dimension)
    return F.concat(title, F.lit(": "), shown)
