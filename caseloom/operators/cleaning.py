"""From raw string rows to the ten-column analysis table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.bands import bucketize, race_from_flags
from caseloom.functions.text import clean_text, keep_text, parse_double, smoking_group
from caseloom.sources.readers import present

_TEXT = ("gender", "location")
_CODED = ("year", "hypertension", "heart_disease", "diabetes")
_BANDED = {"age_bucket": ("age", spec.AGE_COHORT), "bmi_bucket": ("bmi", spec.BMI_COHORT)}


def clean_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Standardise raw rows in one pass; `keep` passes key columns through.

    Text gets Unknown where missing, coded columns the empty string. An absent source column counts
    as missing in every row, so the output always has the same columns.
    """
    def source(name: str) -> Column:
        return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")

    def cleaned(name: str) -> Column:
        if name in _TEXT:
            return clean_text(source(name))
        if name in _CODED:
            return keep_text(source(name))
        if name == "smoking_history":
            return smoking_group(source(name))
        if name == "race":
            return race_from_flags({flag: spec.RACE_LABELS[flag] for flag in present(df, spec.RACE_FLAGS)})
        measure, bands = _BANDED[name]
        return bucketize(F.col(f"_{measure}"), bands)

    # Numbers get a projection of their own: a banding names its input once per edge.
    parsed = df.withColumns({f"_{measure}": parse_double(source(measure)) for measure, _ in _BANDED.values()})
    return parsed.select(*keep, *[cleaned(name).alias(name) for name in spec.CLEAN_COLUMNS])
