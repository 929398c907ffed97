"""Exact evaluation metrics of a (label, score) table, as distributed aggregates.

Scores are folded to one row per distinct value first, so a value shared by very many rows costs
nothing later on. The folded table is checkpointed: the scored input, often a model or a join, is
evaluated once, and all metrics of a curve read the stored rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.bands import predicted
from caseloom.operators.ordered import running_totals
from caseloom.operators.radix import code_double, codes_at, double_code
from caseloom.sources.scratch import Scratch
from caseloom.sources.writers import checkpointed

_TINY = 1e-9


def _labelled(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rows with a 0/1 label and a score that is a number."""
    rows = df.select(F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("score"))
    return rows.where(F.col("y").isin(0, 1) & F.col("score").isNotNull() & ~F.isnan("score"))


def usable_rows(df: DataFrame, label: str = spec.LABEL, score: str = "score") -> DataFrame:
    """How many rows the metrics read, and how many they leave out for their label or else their score."""
    good_label = F.coalesce(F.col(label).cast("int").isin(0, 1), F.lit(False))
    number = F.col(score).cast("double")
    good_score = number.isNotNull() & ~F.isnan(number)
    return df.agg(
        F.count("*").alias("rows_in"),
        F.count_if(good_label & good_score).alias("rows_used"),
        F.count_if(~good_label).alias("bad_label"),
        F.count_if(good_label & ~good_score).alias("bad_score"),
    )


def score_curve(df: DataFrame, label: str = spec.LABEL, score: str = "score", parts: int | None = None) -> DataFrame:
    """Per distinct score, highest first: positives and negatives there, from there up, and in all."""
    folded = (
        _labelled(df, label, score)
        .groupBy("score")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    )
    return running_totals(checkpointed(folded), "score", ["pos", "neg"], descending=True, parts=parts)


def _area_under_roc() -> Column:
    # Every negative is compared with the positives above it; equal scores count half.
    above = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / 2.0)
    return F.try_divide(F.sum(above), F.sum("pos").cast("double") * F.sum("neg"))


def _average_precision() -> Column:
    step = F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return F.try_divide(F.sum(step), F.sum("pos").cast("double"))


def auc_roc(curve: DataFrame) -> DataFrame:
    """Area under the ROC curve of a score curve."""
    return curve.agg(_area_under_roc().alias("auc_roc"))


def average_precision(curve: DataFrame) -> DataFrame:
    """Average precision as a step sum, not a trapezoid, of a score curve."""
    return curve.agg(_average_precision().alias("auc_pr"))


def ranking_metrics(curve: DataFrame) -> DataFrame:
    """Both areas from one pass over the curve."""
    return curve.agg(_area_under_roc().alias("auc_roc"), _average_precision().alias("auc_pr"))


def _brier() -> Column:
    s = F.col("score")
    gap = F.col("pos") * (s - 1.0) * (s - 1.0) + F.col("neg") * s * s
    return F.try_divide(F.sum(gap), F.sum(F.col("pos") + F.col("neg")).cast("double"))


def brier_score(df: DataFrame, label: str = spec.LABEL, score: str = "score") -> DataFrame:
    """Mean squared difference of score and label, straight from the rows."""
    gap = F.col("score") - F.col("y")
    return _labelled(df, label, score).agg(F.avg(gap * gap).alias("brier"))


def pr_curve(curve: DataFrame) -> DataFrame:
    """Precision, recall and F2 at every distinct threshold."""
    tp, flagged = F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")
    points = curve.select(
        F.col("score").alias("threshold"),
        (tp / flagged).alias("precision"),
        F.coalesce(F.try_divide(tp, F.col("total_pos")), F.lit(0.0)).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return points.withColumn("f2", 5.0 * (p * r) / (4.0 * p + r + _TINY))


def best_threshold(points: DataFrame, measure: str = "f2") -> DataFrame:
    """The threshold with the greatest measure; the lowest one among equals."""
    choice = F.max_by("threshold", F.struct(F.col(measure), -F.col("threshold")))
    return points.agg(choice.alias("threshold"), F.max(measure).alias(measure))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _with_ratios(cells: DataFrame) -> DataFrame:
    tp, tn, fp, fn = (F.col(name) for name in ("tp", "tn", "fp", "fn"))
    ratios = cells.withColumns(
        {
            "sensitivity": _ratio(tp, tp + fn),
            "specificity": _ratio(tn, tn + fp),
            "precision": _ratio(tp, tp + fp),
            "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        }
    )
    p, s = F.col("precision"), F.col("sensitivity")
    return ratios.withColumn("f1", 2.0 * p * s / (p + s + _TINY))


def confusion_metrics(
    df: DataFrame, threshold: Column | float, label: str = spec.LABEL, score: str = "score"
) -> DataFrame:
    """The four cells and their ratios at a threshold, a number or a one-row scalar; 0 for empty classes."""
    rows = _labelled(df, label, score).select("y", predicted(F.col("score"), threshold).alias("guess"))
    y, guess = F.col("y"), F.col("guess")
    return _with_ratios(
        rows.agg(
            F.count_if((guess == 1) & (y == 1)).alias("tp"),
            F.count_if((guess == 0) & (y == 0)).alias("tn"),
            F.count_if((guess == 1) & (y == 0)).alias("fp"),
            F.count_if((guess == 0) & (y == 1)).alias("fn"),
        )
    )


def confusion_shares(confusion: DataFrame) -> DataFrame:
    """The four cells as rows with their percent of all rows."""
    cells = ["tn", "fp", "fn", "tp"]
    whole = sum((F.col(name) for name in cells[1:]), F.col(cells[0]))
    rows = [
        F.struct(F.lit(name).alias("cell"), F.col(name).alias("n"), _ratio(F.col(name) * 100.0, whole).alias("percent"))
        for name in cells
    ]
    return confusion.select(F.inline(F.array(*rows)))


def percentiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """Exact percentiles with linear interpolation, as columns p<share*100> of one row.

    The built-in exact percentile keeps all distinct values of a group in one task; here the neighbours
    of each position are found by counting order-preserving codes. Infinite values are values; NULL and
    NaN are none. Without values every percentile is NULL.
    """
    with Scratch(df.sparkSession, "percentiles") as run:
        code = double_code(F.col(column).cast("double"))
        rows = run.keep(df.select(F.lit(0).alias("group"), code.alias("code")).where("code IS NOT NULL"), "codes")
        total = rows.agg(F.count("*").alias("total"))
        places = [(F.col("total") - 1) * F.lit(float(share)) for share in shares]
        ranks = [
            F.struct(F.lit(f"{side}_{i}").alias("name"), turn(place).alias("rank"))
            for i, place in enumerate(places)
            for side, turn in (("low", F.floor), ("high", F.ceil))
        ]
        wanted = run.keep(total.where("total > 0").select(F.lit(0).alias("group"), F.inline(F.array(*ranks))), "wanted")
        found = run.lasting(codes_at(rows, wanted, run), "found")
        total = run.lasting(total, "total")
    value = code_double(F.col("code"))
    sides = found.agg(*[F.max(F.when(F.col("name") == name, value)).alias(name) for name in _sides(len(shares))])
    named = []
    for i, share in enumerate(shares):
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        place = (total.scalar() - 1) * F.lit(float(share))
        between = low + (high - low) * (place - F.floor(place))
        # Equal neighbours are the value itself, also where both are infinite.
        named.append(F.when(low == high, low).otherwise(between).alias(f"p{share * 100:g}".replace(".", "_")))
    return sides.select(*named)


def _sides(n: int) -> list[str]:
    return [f"{side}_{i}" for i in range(n) for side in ("low", "high")]


def calibration_check(
    df: DataFrame, raw: str, calibrated: str, label: str = spec.LABEL
) -> DataFrame:
    """Mean raw score, mean calibrated score and prevalence."""
    return df.agg(
        F.avg(raw).alias("pre_avg"), F.avg(calibrated).alias("post_avg"), F.avg(label).alias("true_prev")
    )


def scores_row(df: DataFrame, label: str = spec.LABEL, score: str = "score", digits: int = 4) -> DataFrame:
    """One row of threshold-free metrics, rounded, all from one pass over the curve."""
    row = score_curve(df, label, score).agg(
        _average_precision().alias("auc_pr"), _area_under_roc().alias("auc_roc"), _brier().alias("brier")
    )
    return row.select(*[F.round(name, digits).alias(name) for name in row.columns])


METRIC_COLUMNS = [
    "accuracy",
    "auc_pr",
    "auc_roc",
    "brier",
    "f1",
    "fn",
    "fp",
    "precision",
    "sensitivity",
    "specificity",
    "threshold",
    "tn",
    "tp",
]


def metrics_row(
    df: DataFrame, tuning: DataFrame, label: str = spec.LABEL, score: str = "score", digits: int = 4
) -> DataFrame:
    """One row of all metrics on `df`, the threshold chosen for greatest F2 on `tuning`.

    Every metric is an aggregate of the folded curve, so the scored rows are read once.
    """
    threshold = best_threshold(pr_curve(score_curve(tuning, label, score))).select("threshold").scalar()
    flagged = predicted(F.col("score"), F.col("threshold")) == 1

    def cell(count: str, side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side, F.col(count))), F.lit(0))

    cells = (
        score_curve(df, label, score)
        .withColumn("threshold", threshold)
        .agg(
            cell("pos", flagged).alias("tp"),
            cell("neg", ~flagged).alias("tn"),
            cell("neg", flagged).alias("fp"),
            cell("pos", ~flagged).alias("fn"),
            _average_precision().alias("auc_pr"),
            _area_under_roc().alias("auc_roc"),
            _brier().alias("brier"),
            F.max("threshold").alias("threshold"),
        )
    )
    counts = ("tp", "tn", "fp", "fn")
    return _with_ratios(cells).select(
        *[F.col(name) if name in counts else F.round(name, digits).alias(name) for name in METRIC_COLUMNS]
    )


def compare_models(rows: dict[str, DataFrame], metrics: Sequence[str] = ("auc_roc", "auc_pr")) -> DataFrame:
    """One column per model and one row per metric, from one-row metric tables."""
    long = None
    for model, row in rows.items():
        one = row.select(F.lit(model).alias("model"), *metrics).unpivot(["model"], list(metrics), "metric", "value")
        long = one if long is None else long.unionByName(one)
    return long.groupBy("metric").pivot("model", list(rows)).agg(F.first("value"))
