"""Clean, split, train two models, calibrate, evaluate, band, and assemble the final table.

Stages hand over through written tables, as a cluster job would: each later stage reads Parquet, and
a lost executor costs one stage's tasks, not the chain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from caseloom import spec
from caseloom.operators.artifact import cut_offs, final_table, key_loss, with_risk_band
from caseloom.operators.cohorts import risk_aggregation, risk_band_summary
from caseloom.operators.filters import dropped_report, keep_valid, kept_counts, typed, with_row_id
from caseloom.operators.metrics import calibration_check, metrics_row, scores_row, usable_rows
from caseloom.operators.models import (
    apply_calibration,
    convergence,
    feature_importance,
    fit_forest,
    fit_logistic,
    fit_platt,
    load_model,
    score_rows,
)
from caseloom.operators.splits import split_parts, stratified_split
from caseloom.plans.ledger import Ledger
from caseloom.session import shuffle_width
from caseloom.sources.quarantine import FILE, MALFORMED, RECORD, read_checked
from caseloom.sources.readers import read_table, require_columns
from caseloom.sources.writers import (
    check_outputs,
    read_bucketed,
    save_model,
    write_bucketed,
    write_manifest,
    write_report,
    write_table,
)

_SCORE = "prob_diabetic"


def prepare(spark: SparkSession, source: str, out: str, multi_line: bool = True) -> None:
    """Validated rows with an identity, the malformed records, and the report of what was dropped.

    One job reads and parses the text, writes the typed columns and counts. Malformed records are stored
    with their text under `rejected`; as far as their cells are there they take part, like in any
    lenient reader, and the rules decide.
    """
    rules = {"strict": spec.STRICT_VALIDITY}

    def view(raw: DataFrame) -> DataFrame:
        return typed(require_columns(raw, spec.MODEL_COLUMNS).select(*spec.MODEL_COLUMNS, RECORD, FILE, MALFORMED))

    checked = read_checked(
        spark, source, f"{out}/typed", multi_line=multi_line, view=view, counts=kept_counts(rules)
    )
    write_report(dropped_report(spark, checked.counts, rules), f"{out}/evaluation/dropped_rows")
    write_table(checked.bad, f"{out}/rejected")
    write_table(with_row_id(keep_valid(checked.every, spec.STRICT_VALIDITY)), f"{out}/processed")


def split(spark: SparkSession, out: str) -> None:
    """Train, calibration and test rows: one table, one write, a folder for each part."""
    divided = stratified_split(read_table(spark, f"{out}/processed"))
    write_bucketed(divided, f"{out}/features", "row_id", shuffle_width(spark), ["split"])


def _keyed(spark: SparkSession, path: str) -> DataFrame:
    return read_bucketed(spark, path, "row_id", shuffle_width(spark))


def _part(spark: SparkSession, out: str, name: str) -> DataFrame:
    return split_parts(_keyed(spark, f"{out}/features"))[name]


def logistic(spark: SparkSession, out: str) -> None:
    """Logistic regression, Platt calibration, calibrated scores, metrics and risk bands."""
    fitted = fit_logistic(_part(spark, out, "train"))
    # How often the fit iterated is known only here; a saved model has lost it.
    training = spark.createDataFrame([(convergence(fitted),)], "iterations int")
    write_report(training, f"{out}/evaluation/training_lr")
    save_model(fitted, f"{out}/models/logistic")
    model = load_model(f"{out}/models/logistic")
    tuning = _part(spark, out, "calibration")
    save_model(fit_platt(score_rows(model, tuning, [spec.LABEL], "prob_diabetic_raw")), f"{out}/models/platt")
    platt = load_model(f"{out}/models/platt")
    write_table(apply_calibration(model, platt, tuning), f"{out}/predictions/logistic_calibration")
    write_table(apply_calibration(model, platt, _part(spark, out, "test"), ["row_id"]), f"{out}/predictions/logistic_test")

    tuned = read_table(spark, f"{out}/predictions/logistic_calibration", [spec.LABEL, _SCORE])
    scored = read_table(spark, f"{out}/predictions/logistic_test")
    both = read_table(spark, f"{out}/predictions/logistic_calibration")
    write_report(calibration_check(both, "prob_diabetic_raw", _SCORE), f"{out}/evaluation/calibration_check_tuning")
    write_report(usable_rows(scored, score=_SCORE), f"{out}/evaluation/usable_rows_lr")
    write_report(calibration_check(scored, "prob_diabetic_raw", _SCORE), f"{out}/evaluation/calibration_check")
    write_report(metrics_row(scored, tuned, score=_SCORE), f"{out}/evaluation/metrics_lr")
    banded = with_risk_band(scored, cut_offs(tuned, _SCORE), _SCORE)
    write_bucketed(banded, f"{out}/predictions/risk_stratified", "row_id", shuffle_width(spark))
    banded = read_table(spark, f"{out}/predictions/risk_stratified")
    write_report(risk_band_summary(banded, score=_SCORE), f"{out}/evaluation/risk_summary_lr", ["avg_prob"])


def forest(spark: SparkSession, out: str) -> None:
    """Random forest, its scores, metrics and importances."""
    save_model(fit_forest(_part(spark, out, "train")), f"{out}/models/forest")
    model = load_model(f"{out}/models/forest")
    test = _part(spark, out, "test")
    scores = score_rows(model, test, ["row_id", spec.LABEL])
    write_bucketed(scores, f"{out}/predictions/forest_test", "row_id", shuffle_width(spark))
    scored = read_table(spark, f"{out}/predictions/forest_test")
    write_report(scores_row(scored, score=_SCORE), f"{out}/evaluation/metrics_rf")
    write_report(feature_importance(model, scored), f"{out}/evaluation/feature_importance_rf", ["rank"])


def joined_final(spark: SparkSession, out: str) -> DataFrame:
    """The join of the stored tables; all three are dealt by the row's key, so none is shuffled."""
    return final_table(
        _keyed(spark, f"{out}/predictions/risk_stratified"),
        _keyed(spark, f"{out}/predictions/forest_test"),
        _part(spark, out, "test"),
    )


def assemble_final(spark: SparkSession, out: str) -> None:
    """The row-level table of both scores, the band and the measures, and the rows lost in joining them."""
    write_table(joined_final(spark, out), f"{out}/predictions/final_dataset")
    inputs = {
        "risk_stratified": read_table(spark, f"{out}/predictions/risk_stratified"),
        "forest_test": read_table(spark, f"{out}/predictions/forest_test"),
        "features": _part(spark, out, "test"),
    }
    lost = key_loss(inputs, read_table(spark, f"{out}/predictions/final_dataset"))
    write_report(lost, f"{out}/evaluation/key_loss", ["input"])


def aggregate_risk(spark: SparkSession, out: str) -> None:
    """Predicted and actual risk per band of six dimensions."""
    final = read_table(spark, f"{out}/predictions/final_dataset")
    table = risk_aggregation(final, "lr_prob_calibrated")
    write_report(table, f"{out}/evaluation/risk_aggregation_lr", ["dimension", "bucket"])


def validate(spark: SparkSession, out: str) -> DataFrame:
    """Check every evaluation output and write the manifest; comes last, when all outputs exist."""
    names = ["metrics_lr", "metrics_rf", "feature_importance_rf", "risk_summary_lr", "risk_aggregation_lr"]
    status = check_outputs(spark, {name: f"{out}/evaluation/{name}" for name in names})
    final_path = f"{out}/predictions/final_dataset"
    write_manifest(final_path, read_table(spark, final_path).count(), status, f"{out}/manifest")
    return status


def run_scoring(spark: SparkSession, source: str, out: str) -> DataFrame:
    """All stages; returns the status of the outputs.

    Each stage is recorded with the files that it read and wrote. Started again after a loss, a run goes
    on with the first stage that is not done, or whose input is another one. The two models read the
    same split table and nothing of each other, so their jobs share the cluster.
    """
    ledger = Ledger(spark, f"{out}/ledger")
    features, predictions, models = f"{out}/features", f"{out}/predictions", f"{out}/models"

    def step(stage: Callable[..., None], reads: Sequence[str], writes: Sequence[str], *more: str) -> None:
        ledger.step(stage.__name__, reads, writes, lambda: stage(spark, *more, out))

    step(prepare, [source], [f"{out}/processed"], source)
    step(split, [f"{out}/processed"], [features])
    _keyed(spark, features)  # known to the catalog before both branches ask for it
    branches = [
        (logistic, [features], [f"{predictions}/risk_stratified", f"{models}/logistic", f"{models}/platt"]),
        (forest, [features], [f"{predictions}/forest_test", f"{models}/forest"]),
    ]
    with ThreadPoolExecutor(len(branches)) as pool:
        for branch in [pool.submit(step, *b) for b in branches]:
            branch.result()
    step(assemble_final, [features, f"{predictions}/risk_stratified", f"{predictions}/forest_test"], [f"{predictions}/final_dataset"])
    step(aggregate_risk, [f"{predictions}/final_dataset"], [f"{out}/evaluation/risk_aggregation_lr"])
    return validate(spark, out)
