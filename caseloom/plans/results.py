"""The result tables shown after a scoring run, from the reports that it wrote."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.cohorts import flag_risk, predicted_vs_actual
from caseloom.operators.metrics import compare_models, confusion_shares
from caseloom.operators.models import shown_importance
from caseloom.operators.shape import share_of_total
from caseloom.sources.readers import read_result
from caseloom.sources.writers import write_report

_TEXT = {"dimension", "bucket", "risk_band", "feature"}
_WHOLE = {"n", "tp", "tn", "fp", "fn", "rank"}

#: Bands shown with predicted beside actual rates, and flags shown with their display names.
SHOWN_BANDS = ("age", "bmi", "hbA1c_level", "blood_glucose_level")
SHOWN_FLAGS = ("hypertension", "heart_disease")


def typed_result(df: DataFrame) -> DataFrame:
    """A report read from text: counts as whole numbers, keys as text, the rest as fractions."""
    kinds = {name: "string" if name in _TEXT else "bigint" if name in _WHOLE else "double" for name in df.columns}
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])


def run_results(spark: SparkSession, out: str) -> dict[str, str]:
    """From the evaluation reports under `out` to the tables under `out`/results; returns their paths."""

    def report(name: str) -> DataFrame:
        return typed_result(read_result(spark, f"{out}/evaluation/{name}"))

    logistic, forest, risk = report("metrics_lr"), report("metrics_rf"), report("risk_aggregation_lr")
    tables: Mapping[str, tuple[DataFrame, list]] = {
        "calibration_effect": (report("calibration_check"), []),
        "confusion_shares": (confusion_shares(logistic), []),
        "band_shares": (share_of_total(report("risk_summary_lr"), "n", "percent"), ["avg_prob"]),
        "model_comparison": (compare_models({"lr": logistic, "rf": forest}), ["metric"]),
        "shown_importance": (shown_importance(report("feature_importance_rf")), ["importance", "feature"]),
        **{f"predicted_vs_actual_{name}": (predicted_vs_actual(risk, name), ["ord"]) for name in SHOWN_BANDS},
        **{f"flag_risk_{name}": (flag_risk(risk, name), ["bucket"]) for name in SHOWN_FLAGS},
    }
    return {name: write_report(table, f"{out}/results/{name}", order) for name, (table, order) in tables.items()}
