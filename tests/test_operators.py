"""Operators on small hand-made tables, with expected rows or a plain recomputation."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.operators import artifact, cohorts, filters, metrics, models, ordered, quality, ranking, rules, splits
from caseloom.operators.cleaning import clean_rows


def encounter(**changes):
    row = dict(age=40.0, bmi=22.0, hbA1c_level=5.5, blood_glucose_level=100.0, hypertension=0, heart_disease=0, diabetes=0)
    return {**row, **changes}


_TYPES = "age double, bmi double, hbA1c_level double, blood_glucose_level double, hypertension int, heart_disease int, diabetes int"


def typed_rows(spark, *rows):
    names = [part.split()[0] for part in _TYPES.split(", ")]
    return spark.createDataFrame([tuple(row[name] for name in names) for row in rows], _TYPES)


@pytest.mark.parametrize(
    "changes, strict, loose",
    [
        ({"age": 0.0}, 1, 0),
        ({"bmi": 55.0}, 1, 0),
        ({"blood_glucose_level": 45.0}, 1, 0),
        ({"hbA1c_level": 3.2}, 0, 1),
        ({"diabetes": 2}, 0, 1),
        ({"age": None}, 0, 0),
        ({"bmi": float("nan")}, 0, 0),
        ({}, 1, 1),
    ],
)
def test_validity(spark, changes, strict, loose):
    df = typed_rows(spark, encounter(**changes))
    assert filters.keep_valid(df, spec.STRICT_VALIDITY).count() == strict
    assert filters.keep_valid(df, spec.LOOSE_VALIDITY).count() == loose
    counts = {r.rule_set: (r.rows_in, r.rows_kept, r.rows_dropped) for r in filters.dropped_rows(
        df, {"strict": spec.STRICT_VALIDITY, "loose": spec.LOOSE_VALIDITY}).collect()}
    assert counts == {"strict": (1, strict, 1 - strict), "loose": (1, loose, 1 - loose)}


def test_row_filters(spark):
    df = spark.createDataFrame([("a", " "), ("", "b"), (None, "c"), ("NaN", "d")], "x string, y string")
    assert df.where(filters.all_given(["x", "y"])).count() == 2
    assert filters.blank_free(df, ["x", "y"]).count() == 0
    assert {r.row_id for r in filters.with_row_id(df).collect()} == set(
        r.row_id for r in filters.with_row_id(df).collect()
    )
    assert filters.with_row_id(df, key="x").columns == ["row_id", "y"]


def test_clean_rows_without_some_columns(spark):
    df = spark.createDataFrame([(" nan ", "30", "1"), ("Utah ", "x", "0.0")], "location string, age string, diabetes string")
    got = [r.asDict() for r in clean_rows(df).coalesce(1).collect()]
    assert list(got[0]) == spec.CLEAN_COLUMNS
    assert [(r["location"], r["age_bucket"], r["race"], r["smoking_history"], r["year"]) for r in got] == [
        ("Unknown", "25-39", "Unknown", "Unknown", ""),
        ("Utah", "Unknown", "Unknown", "Unknown", ""),
    ]


def test_profile(spark):
    df = spark.createDataFrame(
        [("1", "0", "2019", "x"), ("1.0", "", "abc", ""), ("2", "1", "-5", None), ("", "1", "", "3")],
        "`race:A` string, `race:B` string, year string, diabetes string",
    )
    missing = {r.column_name: r.missing_rows for r in quality.missing_counts(df).collect()}
    assert missing == {"race:A": 1, "race:B": 1, "year": 1, "diabetes": 2}
    numeric = quality.numeric_profile(df).collect()
    assert [tuple(r) for r in numeric] == [("year", -5.0, 2019.0, 1)]
    flags = {(r.value, r.row_count, r.valid) for r in quality.binary_profile(df, ["race:A"]).collect()}
    assert flags == {("1", 2, True), ("2", 1, False)}
    assert [tuple(r) for r in quality.invalid_flag_counts(df, ["race:A", "race:B"]).collect()] == [("race:A", 1), ("race:B", 0)]
    one_hot = {r.check_name: r.row_count for r in quality.one_hot_consistency(df, ["race:A", "race:B"]).collect()}
    assert one_hot == {"exactly one flag": 1, "all flags zero": 0, "several flags": 0, "non-binary flag": 3}
    assert quality.one_hot_consistency(df, ["race:A", "absent"]).count() == 0
    labels = {r.label_class: (r.row_count, r.percent) for r in quality.label_distribution(df).collect()}
    assert labels == {"INVALID": (2, 50.0), "MISSING": (2, 50.0)}
    ranges = {r.check_name: r.row_count for r in quality.out_of_range_counts(df).collect()}
    assert ranges["year outside [1900, 2100]"] == 1 and ranges["age outside [0, 120]"] == 0
    report = quality.profile_report(df).collect()
    assert ("size", "table", "rows", "4") in [tuple(r) for r in report]


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "age string, diabetes string")
    assert [tuple(r) for r in quality.missing_counts(df).collect()] == [("age", 0), ("diabetes", 0)]
    assert [tuple(r) for r in quality.numeric_profile(df).collect()] == [("age", None, None, 0)]
    assert quality.label_distribution(df).count() == 0


def test_keys_and_categories(spark):
    df = spark.createDataFrame([(" a", "x "), ("a", ""), ("b", "y"), ("c", "x")], "id string, category string")
    assert [tuple(r) for r in quality.key_repeats(df, "id", 2).collect()] == [("a", 2), ("b", 1)]
    assert [r.category for r in quality.category_values(df, "category").collect()] == ["x", "y"]


def test_cohort_prevalence_counts_invalid_labels_in_size_only(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("a", "0.0"), ("b", "1.0")], "gender string, diabetes string")
    got = {tuple(r) for r in cohorts.cohort_prevalence(df, ["gender", "absent"]).collect()}
    assert got == {("gender", "a", 3, 1, 0.3333), ("gender", "b", 1, 1, 1.0)}


def test_rules(spark):
    df = spark.createDataFrame(
        [("70+", "Obese", "1.0", "0", "1"), ("0-24", "Obese", "0", "0", "0"), ("55-69", "Normal", "0", "0", "x")],
        "age_bucket string, bmi_bucket string, hypertension string, heart_disease string, diabetes string",
    )
    got = [tuple(r) for r in rules.screen_rules(df).collect()]
    assert got[0] == ("Hypertension", 1, 1, 1.0)
    assert [r[0] for r in got[1:3]] == ["Age 55+ AND Obese", "Hypertension AND Obese"]
    assert ("Age 55+", 2, 1, 0.5) in got and ("Heart Disease", 0, 0, 0.0) in got


def test_ranking_ties_and_labels(spark):
    summary = spark.createDataFrame(
        [
            ("gender", "Male", 600, 60, 0.1),
            ("race", "Asian", 600, 60, 0.1),
            ("hypertension", "1.0", 700, 70, 0.1),
            ("location", "Utah", 900, 450, 0.5),
            ("race", "Other", 499, 499, 1.0),
        ],
        "cohort_dimension string, cohort_value string, cohort_size long, diabetes_count long, prevalence_rate double",
    )
    got = [(r.rank, r.cohort_label) for r in ranking.rank_cohorts(summary).collect()]
    assert got == [(1, "Hypertension: Yes"), (2, "Race: Asian"), (3, "Gender: Male")]
    text = summary.select([F.col(c).cast("string") for c in summary.columns]).unionByName(
        spark.createDataFrame([("race", "Bad", "x", "1", "0.9")], summary.columns)
    )
    assert ranking.typed_summary(text).count() == 5


def test_ranked_locations_match_a_plain_sort(spark):
    rng = random.Random(7)
    rows = [("location", f"L{i:04d}", 500 + i, 1, round(rng.choice([0.0, 0.1, rng.random()]), 4)) for i in range(900)]
    summary = spark.createDataFrame(
        rows, "cohort_dimension string, cohort_value string, cohort_size long, diabetes_count long, prevalence_rate double"
    )
    expected = [name for _, name in sorted((-r[4], r[1]) for r in rows)]
    got = ranking.rank_locations(summary).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 901))
    assert [r.location for r in got] == expected


@pytest.mark.parametrize("parts", [2, 7, 64])
def test_running_totals_do_not_depend_on_cuts(spark, parts):
    rng = random.Random(3)
    rows = [(round(rng.random() ** 4, 3), rng.randrange(5)) for _ in range(2000)]
    table = spark.createDataFrame(rows, "k double, n long").groupBy("k").agg(F.sum("n").alias("n"))
    got = ordered.running_totals(table, "k", ["n"], descending=True, parts=parts).collect()
    sums: dict[float, int] = {}
    for k, n in rows:
        sums[k] = sums.get(k, 0) + n
    running, expected = 0, {}
    for k in sorted(sums, reverse=True):
        running += sums[k]
        expected[k] = running
    assert {r.k: r.cum_n for r in got} == expected
    assert {r.total_n for r in got} == {running}


def test_ordered_primitives_on_nothing(spark):
    empty = spark.createDataFrame([], "k double, n long")
    assert ordered.running_totals(empty, "k", ["n"]).count() == 0
    assert ordered.number_rows(empty, "k").count() == 0


def scored(spark, seed, n, digits):
    rng = np.random.default_rng(seed)
    p = rng.random(n) ** 2
    y = (rng.random(n) < p).astype(int)
    p = np.round(p, digits)
    return y, p, spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "diabetes int, score double")


def plain_areas(y, p):
    pairs = p[y == 1][:, None] - p[y == 0][None, :]
    auc = ((pairs > 0).sum() + 0.5 * (pairs == 0).sum()) / pairs.size
    ap, tp_before = 0.0, 0
    for t in np.unique(p)[::-1]:
        flagged = p >= t
        tp = int(y[flagged].sum())
        ap += (tp - tp_before) / y.sum() * tp / flagged.sum()
        tp_before = tp
    return auc, ap


@pytest.mark.parametrize("digits", [1, 2, 12])
def test_metrics_match_plain_computation(spark, digits):
    y, p, df = scored(spark, 5, 1500, digits)
    auc, ap = plain_areas(y, p)
    row = metrics.ranking_metrics(metrics.score_curve(df, parts=9)).first()
    assert row.auc_roc == pytest.approx(auc, abs=1e-12)
    assert row.auc_pr == pytest.approx(ap, abs=1e-12)
    assert metrics.brier_score(df).first().brier == pytest.approx(float(((p - y) ** 2).mean()), abs=1e-12)
    best = metrics.best_threshold(metrics.pr_curve(metrics.score_curve(df))).first()
    f2 = {}
    for t in np.unique(p):
        flagged = p >= t
        precision, recall = y[flagged].mean(), y[flagged].sum() / y.sum()
        f2[t] = 5 * (precision * recall) / (4 * precision + recall + 1e-9)
    assert f2[best.threshold] == pytest.approx(max(f2.values()), abs=1e-12)
    row = metrics.metrics_row(df, df, digits=10).first()
    cells = {n: row[n] for n in ("tp", "tn", "fp", "fn")}
    assert sum(cells.values()) == 1500
    assert row.accuracy == pytest.approx((row.tp + row.tn) / 1500, abs=1e-9)
    assert row.sensitivity == pytest.approx(row.tp / y.sum(), abs=1e-9)
    direct = metrics.confusion_metrics(df, best.threshold).first()
    assert {n: direct[n] for n in cells} == cells
    short = metrics.scores_row(df, digits=10).first()
    assert (short.auc_roc, short.brier) == (row.auc_roc, row.brier)


def test_best_threshold_takes_the_lowest_among_equals(spark):
    points = spark.createDataFrame([(0.3, 0.5), (0.1, 0.5), (0.9, 0.2)], "threshold double, f2 double")
    assert metrics.best_threshold(points).first().threshold == 0.1


def test_confusion_is_zero_safe(spark):
    df = spark.createDataFrame([(0, 0.1)], "diabetes int, score double")
    row = metrics.confusion_metrics(df, 0.5).first()
    assert (row.sensitivity, row.precision, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 1.0)
    shares = {r.cell: r.percent for r in metrics.confusion_shares(metrics.confusion_metrics(df, 0.5)).collect()}
    assert shares == {"tn": 100.0, "fp": 0.0, "fn": 0.0, "tp": 0.0}


def test_percentiles(spark):
    df = spark.createDataFrame([(v,) for v in (0.01, 0.2, 0.35, 0.4, 0.8, 0.05, 0.9)], "s double")
    row = metrics.percentiles(df, "s", [0.8, 0.9]).first()
    assert (row.p80, row.p90) == (pytest.approx(0.72), pytest.approx(0.84))
    skewed = np.concatenate([np.full(400, 0.25), np.random.default_rng(1).random(600)])
    many = spark.createDataFrame([(float(v),) for v in skewed], "s double")
    row = metrics.percentiles(many, "s", [0.0, 0.333, 0.5, 1.0]).first()
    assert list(row) == pytest.approx(list(np.percentile(skewed, [0, 33.3, 50, 100])))


def test_split_is_a_repeatable_partition(spark):
    df = spark.range(4000).select(F.col("id").alias("row_id"), (F.col("id") % 10 == 0).cast("int").alias("diabetes"))
    first = {r.row_id: r.split for r in splits.stratified_split(df).collect()}
    again = {r.row_id: r.split for r in splits.stratified_split(df.repartition(7)).collect()}
    assert first == again and len(first) == 4000
    shares = {part: sum(s == part for s in first.values()) / 4000 for part in spec.SPLIT_WEIGHTS}
    assert shares == pytest.approx(spec.SPLIT_WEIGHTS, abs=0.03)
    parts = splits.split_parts(splits.stratified_split(df))
    assert sum(p.count() for p in parts.values()) == 4000
    assert {r.diabetes for r in splits.split_counts(splits.stratified_split(df)).collect()} == {0, 1}


def test_group_tables(spark):
    df = spark.createDataFrame([(10.0, 1, 1, 1), (20.0, 0, 0, 0), (130.0, 1, 1, 0)], "age double, diabetes int, hypertension int, heart_disease int")
    from caseloom.functions.bands import bucketize

    band = bucketize(F.col("age"), spec.AGE_STAGE)
    table = [tuple(r) for r in cohorts.label_crosstab(df, band, spec.AGE_STAGE.labels).collect()]
    assert table == [(0, "children", 0, 1), (1, "youth", 1, 0), (2, "adult", None, None), (3, "senior", None, None)]
    rates = {r.bucket: (r.total, r.rate) for r in cohorts.group_rates(df, {"age": band}).collect()}
    assert rates == {"children": (1, 100.0), "youth": (1, 0.0)}
    assert cohorts.group_rates(df, {"age": band}).first().overall_rate == pytest.approx(200 / 3)
    tiers = [(r.bucket, r.total) for r in cohorts.comorbidity_tiers(df).collect()]
    assert tiers == [("no_comorbidity", 1), ("hypertension_only", 1), ("heart_disease_only", None), ("both_conditions", 1)]


def test_dimension_totals_agree(spark):
    rng = random.Random(11)
    rows = [
        encounter(age=rng.uniform(0, 90), bmi=rng.uniform(12, 50), hbA1c_level=rng.uniform(4, 9),
                  blood_glucose_level=rng.uniform(70, 270), hypertension=rng.randrange(2), diabetes=rng.randrange(2))
        for _ in range(500)
    ]
    df = typed_rows(spark, *rows).withColumn("score", F.col("age") / 100)
    totals = {
        r.dimension: (r.n, r.y, round(r.p, 6))
        for r in cohorts.risk_aggregation(df).groupBy("dimension").agg(
            F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("diabetic_rate"))).alias("y"),
            F.sum(F.col("n") * F.col("avg_prob")).alias("p")).collect()
    }
    assert len(totals) == 6 and len(set(totals.values())) == 1 and list(totals.values())[0][0] == 500


def test_models_learn_and_calibrate(spark):
    rng = np.random.default_rng(2)
    n = 3000
    x = rng.normal(size=(n, 6))
    p = 1 / (1 + np.exp(-(2.5 * x[:, 0] + 1.5 * x[:, 1] - 3)))
    y = (rng.random(n) < p).astype(int)
    names = spec.FEATURES
    df = spark.createDataFrame(
        [(i, *map(float, x[i]), int(y[i])) for i in range(n)], "row_id long, " + ", ".join(f"{c} double" for c in names) + ", diabetes int"
    )
    parts = splits.split_parts(splits.stratified_split(df))
    model = models.fit_logistic(parts["train"])
    assert 0 < models.convergence(model) <= 20
    platt = models.fit_platt(models.score_rows(model, parts["calibration"], ["diabetes"], "prob_diabetic_raw"))
    out = models.apply_calibration(model, platt, parts["test"], ["row_id"])
    check = metrics.calibration_check(out, "prob_diabetic_raw", "prob_diabetic").first()
    assert abs(check.post_avg - check.true_prev) < abs(check.pre_avg - check.true_prev)
    assert len(models.assemble(df).first()["features"]) == 6
    assert filters.with_label(df, 1).count() == int(y.sum())
    forest = models.fit_forest(parts["train"])
    ranked = models.feature_importance(forest, df).orderBy("rank").collect()
    assert [r.feature for r in ranked][:2] == names[:2]
    assert sum(r.importance for r in ranked) == pytest.approx(1.0, abs=1e-3)
    shown = models.shown_importance(models.feature_importance(forest, df)).collect()
    assert shown[-1].label == "HbA1c Level"
    rows = {"lr": metrics.scores_row(out, score="prob_diabetic"),
            "rf": metrics.scores_row(models.score_rows(forest, parts["test"], ["diabetes"]), score="prob_diabetic")}
    table = {r.metric: (r.lr, r.rf) for r in metrics.compare_models(rows).collect()}
    assert table["auc_roc"][0] > 0.85 and table["auc_roc"][1] > 0.85
    weights = models.class_weights(parts["train"]).first()
    assert weights.weight_positive + weights.weight_negative == pytest.approx(1.0)


def test_final_table_reports_lost_keys(spark):
    banded = spark.createDataFrame([(1, 0, 0.1, "Low"), (2, 1, 0.9, "High")], "row_id long, diabetes int, prob_diabetic double, risk_band string")
    other = spark.createDataFrame([(1, 0.2)], "row_id long, prob_diabetic double")
    measures = typed_rows(spark, encounter(), encounter()).withColumn("row_id", F.lit(1).cast("long")).limit(1)
    final = artifact.final_table(banded, other, measures)
    assert [(r.row_id, r.lr_prob_calibrated, r.rf_prob) for r in final.collect()] == [(1, 0.1, 0.2)]
    lost = {r.input: r.rows_lost for r in artifact.key_loss({"banded": banded, "other": other}, final).collect()}
    assert lost == {"banded": 1, "other": 0}


def test_means_do_not_depend_on_the_order_of_rows(spark):
    # 80 values with the exact mean 5.80625; as doubles their sum is 464.5 in some orders and less in others.
    values = [5.9] * 27 + [5.6] * 20 + [6.2] * 13 + [4.7] * 6 + [7.1] * 6 + [5.3] * 6 + [5.2, 4.8]
    assert len(values) == 80 and sum(round(10 * v) for v in values) == 4645
    rng, seen = random.Random(5), set()
    for _ in range(6):
        rng.shuffle(values)
        rows = [encounter(hbA1c_level=v, bmi=v, blood_glucose_level=v) for v in values]
        for width in (1, 7):
            seen |= {tuple(r) for r in cohorts.comorbidity_profile(typed_rows(spark, *rows).repartition(width)).collect()}
    assert len(seen) == 1 and {r[4] for r in seen} == {5.8063}
    odd = typed_rows(spark, encounter(bmi=1e300), encounter(bmi=3e300), encounter(bmi=float("inf"), heart_disease=1))
    assert [r.mean_bmi for r in cohorts.comorbidity_profile(odd).collect()] == [2e300, float("inf")]
