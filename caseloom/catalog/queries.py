"""One registered query per operator, over whole tables. Averages and rates are rounded for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.bands import bucketize, comorbidity_flag, comorbidity_tier, predicted, risk_band
from caseloom.functions.text import four_places, is_missing, parse_double, parse_flag, parse_whole
from caseloom.operators import artifact, cohorts, filters, metrics, models, quality, ranking, rules, splits
from caseloom.operators.cleaning import clean_rows
from caseloom.operators.shape import share_of_total
from caseloom.sources.encounters import encounters, key_draw, raw_encounters, raw_lines
from caseloom.sources.readers import normalized_lines, read_table
from caseloom.sources.writers import checkpointed

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    """All queries by name."""
    return dict(_REGISTRY)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


def _typed_raw(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    # Stored, as every condition of a filter would parse its column again.
    return checkpointed(filters.typed(raw_encounters(spark, folder, columns)))


def _loose(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    rows = _typed_raw(spark, folder, *spec.LOOSE_VALIDITY.ranges, *more)
    return filters.keep_valid(rows, spec.LOOSE_VALIDITY)


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_rows(raw_encounters(spark, folder))


def _model_rows(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return filters.keep_valid(encounters(spark, folder, ["row_id", *spec.MODEL_COLUMNS, *more]), spec.STRICT_VALIDITY)


def _divided(df: DataFrame) -> DataFrame:
    return splits.assign_split(df, key_draw() / 1000.0)


def _scored_parts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return splits.split_parts(_divided(_model_rows(spark, folder, "score")))


# --- rows, filters, cleaning -------------------------------------------------------------------


@_query
def encounter_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The derived encounter table itself."""
    return encounters(spark, folder)


@_query
def validity_filter_strict(spark: SparkSession, folder: str) -> DataFrame:
    valid = filters.keep_valid(_typed_raw(spark, folder, *spec.MODEL_COLUMNS), spec.STRICT_VALIDITY)
    return valid.select("row_id", *spec.MODEL_COLUMNS)


@_query
def validity_filter_loose(spark: SparkSession, folder: str) -> DataFrame:
    return _loose(spark, folder, *spec.MODEL_COLUMNS).select("row_id", *spec.MODEL_COLUMNS)


@_query
def dropped_rows(spark: SparkSession, folder: str) -> DataFrame:
    return filters.dropped_rows(
        _typed_raw(spark, folder, *spec.MODEL_COLUMNS), {"strict": spec.STRICT_VALIDITY, "loose": spec.LOOSE_VALIDITY}
    )


@_query
def parsed_values(spark: SparkSession, folder: str) -> DataFrame:
    """The scalar parsers on raw columns."""
    hba1c, age = F.col("hbA1c_level"), F.col("age")
    return raw_encounters(spark, folder).select(
        "row_id",
        is_missing(F.col("gender"), spec.PROFILE_BLANKS).alias("gender_missing_profile"),
        is_missing(F.col("gender")).alias("gender_missing_cleaning"),
        parse_double(hba1c).alias("hba1c"),
        parse_whole(age).alias("whole_age"),
        parse_flag(F.col("hypertension")).alias("hypertension_flag"),
        parse_flag(F.col("heart_disease")).alias("heart_flag"),
        quality.flag_state(F.col("race:Caucasian")).alias("flag_state"),
        four_places(parse_double(age)).alias("age_text"),
    )


@_query
def clean_table(spark: SparkSession, folder: str) -> DataFrame:
    return clean_rows(raw_encounters(spark, folder), keep=("row_id",))


@_query
def normalize_lines(spark: SparkSession, folder: str) -> DataFrame:
    return normalized_lines(raw_lines(spark, folder))


@_query
def band_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Every banding side by side."""
    df = encounters(spark, folder)
    measures = {"hba1c": "hbA1c_level", "glucose": "blood_glucose_level", "bmi": "bmi", "age": "age"}
    open_bands = {name: cohorts.RISK_DIMENSIONS[column] for name, column in measures.items()}
    closed = {"age": spec.AGE_STAGE, "bmi": spec.BMI_STAGE}
    cohort = {"age": spec.AGE_COHORT, "bmi": spec.BMI_COHORT}
    return df.select(
        "row_id",
        *[bucketize(F.col(measures[n]), b).alias(f"{n}_range") for n, b in open_bands.items()],
        *[bucketize(F.col(measures[n]), b).alias(f"{n}_stage") for n, b in closed.items()],
        *[bucketize(F.col(measures[n]), b).alias(f"{n}_cohort") for n, b in cohort.items()],
        comorbidity_flag(F.col("hypertension"), F.col("heart_disease")).alias("comorbidity"),
        comorbidity_tier(F.col("hypertension"), F.col("heart_disease")).alias("tier"),
        predicted(F.col("score"), 0.5).alias("guess"),
        risk_band(F.col("score"), F.lit(0.5), F.lit(0.6)).alias("band"),
    )


# --- grouped summaries -------------------------------------------------------------------------


@_query
def bmi_bucket_summary(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.bmi_bucket_summary(_loose(spark, folder, spec.LABEL))


@_query
def yearly_summary(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.yearly_summary(_loose(spark, folder, "year", spec.LABEL))


@_query
def comorbidity_profile(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.comorbidity_profile(_loose(spark, folder, "hypertension", "heart_disease", spec.LABEL))


@_query
def cohort_prevalence(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.in_dimension_order(cohorts.cohort_prevalence(_cleaned(spark, folder)))


@_query
def value_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.value_frequencies(_cleaned(spark, folder)).orderBy("column_name", "value")


@_query
def risk_aggregation(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(cohorts.risk_aggregation(_model_rows(spark, folder, "score")), 6, "avg_prob", "diabetic_rate")


@_query
def predicted_vs_actual(spark: SparkSession, folder: str) -> DataFrame:
    aggregated = cohorts.risk_aggregation(_model_rows(spark, folder, "score"))
    return _rounded(cohorts.predicted_vs_actual(aggregated, "age"), 6, "avg_prob", "diabetic_rate")


@_query
def flag_risk(spark: SparkSession, folder: str) -> DataFrame:
    aggregated = cohorts.risk_aggregation(_model_rows(spark, folder, "score"))
    return _rounded(cohorts.flag_risk(aggregated, "hypertension"), 6, "avg_prob", "diabetic_rate")


def _risk_of(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.risk_aggregation(_model_rows(spark, folder, "score"))


@_query
def predicted_vs_actual_bmi(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(cohorts.predicted_vs_actual(_risk_of(spark, folder), "bmi"), 6, "avg_prob", "diabetic_rate")


@_query
def predicted_vs_actual_hba1c(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(cohorts.predicted_vs_actual(_risk_of(spark, folder), "hbA1c_level"), 6, "avg_prob", "diabetic_rate")


@_query
def predicted_vs_actual_glucose(spark: SparkSession, folder: str) -> DataFrame:
    found = cohorts.predicted_vs_actual(_risk_of(spark, folder), "blood_glucose_level")
    return _rounded(found, 6, "avg_prob", "diabetic_rate")


@_query
def flag_risk_heart_disease(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(cohorts.flag_risk(_risk_of(spark, folder), "heart_disease"), 6, "avg_prob", "diabetic_rate")


@_query
def rate_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """Each band's positive rate against a baseline band of its dimension."""
    rates = cohorts.risk_aggregation(_model_rows(spark, folder, "score")).drop("avg_prob")
    baseline = {"age": "Young (18-34)", "bmi": "Normal (18.5-24.9)", "hypertension": "0", "heart_disease": "0"}
    return _rounded(cohorts.rate_ratios(rates, baseline, "diabetic_rate"), 6, "diabetic_rate", "rate_ratio")


@_query
def data_card(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.data_card(encounters(spark, folder))


@_query
def rows_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.rows_per_year(encounters(spark, folder, ["year"]))


@_query
def bucket_share(spark: SparkSession, folder: str) -> DataFrame:
    df = encounters(spark, folder, ["hbA1c_level", "blood_glucose_level"])
    shares = cohorts.bucket_shares(
        df,
        {
            "hba1c": (bucketize(F.col("hbA1c_level"), spec.HBA1C_STAGE), spec.HBA1C_STAGE.labels),
            "glucose": (bucketize(F.col("blood_glucose_level"), spec.GLUCOSE_STAGE), spec.GLUCOSE_STAGE.labels),
        },
    )
    return _rounded(shares, 6, "percent")


@_query
def label_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    df = encounters(spark, folder, ["age", "diabetes"])
    return cohorts.label_crosstab(df, bucketize(F.col("age"), spec.AGE_STAGE), spec.AGE_STAGE.labels)


@_query
def label_crosstab_bmi(spark: SparkSession, folder: str) -> DataFrame:
    df = encounters(spark, folder, ["bmi", "diabetes"])
    return cohorts.label_crosstab(df, bucketize(F.col("bmi"), spec.BMI_STAGE), spec.BMI_STAGE.labels)


@_query
def group_rates(spark: SparkSession, folder: str) -> DataFrame:
    rates = cohorts.group_rates(
        encounters(spark, folder, ["age", "bmi", "location", "diabetes"]),
        {
            "age": bucketize(F.col("age"), spec.AGE_STAGE),
            "bmi": bucketize(F.col("bmi"), spec.BMI_STAGE),
            "location": F.col("location"),
        },
    )
    return _rounded(rates, 6, "rate", "overall_rate")


@_query
def comorbidity_tiers(spark: SparkSession, folder: str) -> DataFrame:
    tiers = cohorts.comorbidity_tiers(encounters(spark, folder, ["hypertension", "heart_disease", "diabetes"]))
    return _rounded(tiers, 6, "rate", "overall_rate", "ratio_to_first")


@_query
def top_locations(spark: SparkSession, folder: str) -> DataFrame:
    df = encounters(spark, folder, ["location", "diabetes"])
    rates = cohorts.group_rates(df, {"location": F.col("location")})
    return _rounded(ranking.top_groups(rates), 6, "rate", "overall_rate")


@_query
def top5_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(ranking.top_profiles(encounters(spark, folder)), 6, "rate")


# --- profile -----------------------------------------------------------------------------------


def _profiled(spark: SparkSession, folder: str) -> DataFrame:
    return raw_encounters(spark, folder).drop("row_id")


@_query
def table_size(spark: SparkSession, folder: str) -> DataFrame:
    return quality.table_size(_profiled(spark, folder))


@_query
def missing_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.missing_counts(_profiled(spark, folder))


@_query
def numeric_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.numeric_profile(_profiled(spark, folder))


@_query
def binary_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.binary_profile(_profiled(spark, folder))


@_query
def invalid_flag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.invalid_flag_counts(_profiled(spark, folder))


@_query
def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return quality.label_distribution(_profiled(spark, folder))


@_query
def one_hot_consistency(spark: SparkSession, folder: str) -> DataFrame:
    return quality.one_hot_consistency(_profiled(spark, folder))


@_query
def out_of_range_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.out_of_range_counts(_profiled(spark, folder))


@_query
def profile_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.profile_report(_profiled(spark, folder))


@_query
def derived_field_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.derived_field_checks(_cleaned(spark, folder))


@_query
def key_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return quality.key_repeats(read_table(spark, f"{folder}/events.parquet"), "user_id")


@_query
def category_sample(spark: SparkSession, folder: str) -> DataFrame:
    return quality.category_values(read_table(spark, f"{folder}/events.parquet"), "event_type")


# --- ranking and rules -------------------------------------------------------------------------


@_query
def ranked_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.rank_cohorts(cohorts.cohort_prevalence(_cleaned(spark, folder)))


@_query
def ranked_locations(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.rank_locations(cohorts.cohort_prevalence(_cleaned(spark, folder), ["location"]))


@_query
def rule_screening(spark: SparkSession, folder: str) -> DataFrame:
    return rules.screen_rules(_cleaned(spark, folder))


# --- split, weights, scaling -------------------------------------------------------------------


@_query
def stratified_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_counts(splits.stratified_split(_model_rows(spark, folder)))


@_query
def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.class_counts(_model_rows(spark, folder))


@_query
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(models.class_weights(_model_rows(spark, folder)), 9, "weight_positive", "weight_negative")


@_query
def standardized_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = _model_rows(spark, folder).withColumns({name: F.col(name).cast("double") for name in spec.FEATURES})
    return _rounded(models.standardized(rows), 4, *spec.FEATURES).select("row_id", *spec.FEATURES)


# --- evaluation on a fixed score ---------------------------------------------------------------


@_query
def auc_roc(spark: SparkSession, folder: str) -> DataFrame:
    curve = metrics.score_curve(_model_rows(spark, folder, "score"))
    return _rounded(metrics.auc_roc(curve), 8, "auc_roc")


@_query
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    curve = metrics.score_curve(_model_rows(spark, folder, "score"))
    return _rounded(metrics.average_precision(curve), 8, "auc_pr")


@_query
def tied_score_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Both areas on a score of two decimals, so that most rows tie."""
    rows = _model_rows(spark, folder, "score").withColumn("score", F.floor(F.col("score") * 100.0) / 100.0)
    return _rounded(metrics.ranking_metrics(metrics.score_curve(rows)), 8, "auc_roc", "auc_pr")


@_query
def brier_score(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.brier_score(_model_rows(spark, folder, "score")), 8, "brier")


@_query
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    points = metrics.pr_curve(metrics.score_curve(_model_rows(spark, folder, "score")))
    return _rounded(points, 8, "threshold", "precision", "recall", "f2")


@_query
def f2_threshold(spark: SparkSession, folder: str) -> DataFrame:
    curve = metrics.score_curve(_scored_parts(spark, folder)["calibration"])
    return _rounded(metrics.best_threshold(metrics.pr_curve(curve)), 8, "threshold", "f2")


@_query
def usable_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the evaluation reads and leaves out, on scores of which some are missing and labels of which some are 2."""
    rows = encounters(spark, folder, ["row_id", "diabetes", "score"])
    holes = {"score": F.when(F.col("row_id") % 7 != 0, F.col("score")), "diabetes": F.when(F.col("row_id") % 11 == 0, 2).otherwise(F.col("diabetes"))}
    return metrics.usable_rows(rows.withColumns(holes))


@_query
def platt_newton(spark: SparkSession, folder: str) -> DataFrame:
    """The fixed score calibrated on one part of the exact split, by class, and applied to another."""
    parts = splits.split_parts(splits.stratified_split(checkpointed(_model_rows(spark, folder, "score"))))
    slope, shift, _ = models.platt_newton(parts["calibration"], "score")
    calibrated = models.apply_platt(parts["test"], slope, shift, "score", "prob_diabetic")
    return _rounded(calibrated.select("row_id", spec.LABEL, "score", "prob_diabetic"), 6, "score", "prob_diabetic")


@_query
def confusion_metrics(spark: SparkSession, folder: str) -> DataFrame:
    table = metrics.confusion_metrics(_model_rows(spark, folder, "score"), 0.6)
    return _rounded(table, 8, "sensitivity", "specificity", "precision", "accuracy", "f1")


@_query
def confusion_shares(spark: SparkSession, folder: str) -> DataFrame:
    table = metrics.confusion_metrics(_model_rows(spark, folder, "score"), 0.6)
    return _rounded(metrics.confusion_shares(table), 6, "percent")


@_query
def metrics_row(spark: SparkSession, folder: str) -> DataFrame:
    parts = _scored_parts(spark, folder)
    return metrics.metrics_row(parts["test"], parts["calibration"], digits=8)


@_query
def percentile_cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    cuts = metrics.percentiles(_model_rows(spark, folder, "score"), "score", [0.5, 0.8, 0.9])
    return _rounded(cuts, 8, *cuts.columns)


@_query
def risk_band_summary(spark: SparkSession, folder: str) -> DataFrame:
    parts = _scored_parts(spark, folder)
    banded = artifact.with_risk_band(parts["test"], artifact.cut_offs(parts["calibration"]))
    summary = share_of_total(cohorts.risk_band_summary(banded), "n", "percent")
    return _rounded(summary, 6, "avg_prob", "diabetic_rate", "percent")


@_query
def calibration_check(spark: SparkSession, folder: str) -> DataFrame:
    rows = _model_rows(spark, folder, "score").withColumn("squared", F.col("score") * F.col("score"))
    return _rounded(metrics.calibration_check(rows, "score", "squared"), 8, "pre_avg", "post_avg", "true_prev")


def _final(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _model_rows(spark, folder, "score")
    first = rows.select("row_id", spec.LABEL, "score").withColumn(
        "risk_band", risk_band(F.col("score"), F.lit(0.5), F.lit(0.6))
    )
    second = rows.select("row_id", (F.col("score") * F.col("score")).alias("score"))
    return first, second, encounters(spark, folder, ["row_id", *spec.FEATURES])


@_query
def final_artifact(spark: SparkSession, folder: str) -> DataFrame:
    return artifact.final_table(*_final(spark, folder), score="score")


@_query
def key_loss(spark: SparkSession, folder: str) -> DataFrame:
    first, second, measures = _final(spark, folder)
    result = artifact.final_table(first, second, measures, score="score")
    return artifact.key_loss({"first": first, "second": second, "measures": measures}, result)


# --- fitted models: no closed-form SQL ---------------------------------------------------------


def _model_parts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    # Fits and scoring make several passes; each then reads the files of its part alone.
    divided = splits.stratified_split(checkpointed(_model_rows(spark, folder)))
    return splits.split_parts(checkpointed(divided, partition_by=["split"]))


@_query
def lr_scores(spark: SparkSession, folder: str) -> DataFrame:
    parts = _model_parts(spark, folder)
    return models.score_rows(models.fit_logistic(parts["train"]), parts["test"], ["row_id", spec.LABEL])


@_query
def lr_convergence(spark: SparkSession, folder: str) -> DataFrame:
    model = models.fit_logistic(_model_parts(spark, folder)["train"])
    return spark.range(1).select(F.lit(models.convergence(model)).alias("iterations"))


def _calibrated(parts: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    model = models.fit_logistic(parts["train"])
    platt = models.fit_platt(models.score_rows(model, parts["calibration"], [spec.LABEL], "prob_diabetic_raw"))
    return tuple(models.apply_calibration(model, platt, parts[name], ["row_id"]) for name in ("calibration", "test"))


@_query
def platt_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _calibrated(_model_parts(spark, folder))[1]


@_query
def rf_scores(spark: SparkSession, folder: str) -> DataFrame:
    parts = _model_parts(spark, folder)
    return models.score_rows(models.fit_forest(parts["train"]), parts["test"], ["row_id", spec.LABEL])


@_query
def rf_importance(spark: SparkSession, folder: str) -> DataFrame:
    train = _model_parts(spark, folder)["train"]
    return models.feature_importance(models.fit_forest(train), train)


@_query
def shown_importance(spark: SparkSession, folder: str) -> DataFrame:
    return models.shown_importance(rf_importance(spark, folder))


@_query
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    parts = _model_parts(spark, folder)
    logistic = _calibrated(parts)[1]
    forest = models.score_rows(models.fit_forest(parts["train"]), parts["test"], ["row_id", spec.LABEL])
    rows = {name: metrics.scores_row(df, score="prob_diabetic") for name, df in (("lr", logistic), ("rf", forest))}
    return metrics.compare_models(rows)


@_query
def calibrated_metrics(spark: SparkSession, folder: str) -> DataFrame:
    tuning, test = _calibrated(_model_parts(spark, folder))
    return metrics.metrics_row(test, tuning, score="prob_diabetic")


