"""The overview of a raw table: its size and classes, shares, rates and highest-risk groups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.bands import bucketize
from caseloom.operators.cohorts import bucket_shares, comorbidity_tiers, data_card, group_rates, label_crosstab, rows_per_year
from caseloom.operators.filters import typed
from caseloom.operators.quality import missing_counts
from caseloom.operators.ranking import top_groups, top_profiles
from caseloom.sources.quarantine import read_checked
from caseloom.sources.readers import require_columns
from caseloom.sources.writers import write_report, write_table


def run_overview(spark: SparkSession, source: str, out: str, sep: str = ",", multi_line: bool = True) -> dict[str, str]:
    """From a raw delimited file or folder to the overview tables under `out`; returns their paths."""
    needed = ["year", "location", *spec.MODEL_COLUMNS]
    raw = read_checked(
        spark, source, f"{out}/raw", sep, multi_line=multi_line, view=lambda df: require_columns(df, needed)
    )
    paths = {"raw": f"{out}/raw", "typed": write_table(typed(raw.every), f"{out}/typed")}
    rows = spark.read.parquet(paths["typed"])
    bands = {name: bucketize(F.col(name), stage) for name, stage in (("age", spec.AGE_STAGE), ("bmi", spec.BMI_STAGE))}
    shares = {
        "hba1c": (bucketize(F.col("hbA1c_level"), spec.HBA1C_STAGE), spec.HBA1C_STAGE.labels),
        "glucose": (bucketize(F.col("blood_glucose_level"), spec.GLUCOSE_STAGE), spec.GLUCOSE_STAGE.labels),
    }
    located = group_rates(rows, {"location": F.col("location")})
    tables: Mapping[str, tuple[DataFrame, list]] = {
        "data_card": (data_card(rows), []),
        "missing_counts": (missing_counts(raw.every), ["column_name"]),
        "rows_per_year": (rows_per_year(rows), ["year"]),
        "bucket_shares": (bucket_shares(rows, shares), ["dimension", "ord"]),
        "crosstab_age": (label_crosstab(rows, bands["age"], spec.AGE_STAGE.labels), ["ord"]),
        "crosstab_bmi": (label_crosstab(rows, bands["bmi"], spec.BMI_STAGE.labels), ["ord"]),
        "group_rates": (group_rates(rows, bands), ["dimension", "bucket"]),
        "comorbidity_tiers": (comorbidity_tiers(rows), ["ord"]),
        "top_locations": (top_groups(located), [F.desc("rate"), "bucket"]),
        "top_profiles": (top_profiles(rows), []),
    }
    for name, (table, order) in tables.items():
        paths[name] = write_report(table, f"{out}/{name}", order)
    return paths
