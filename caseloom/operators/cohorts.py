"""Grouped summaries. Several dimensions are always summarised from a single scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.bands import bucketize, comorbidity_tier, lab_outlier, rate_tier
from caseloom.functions.text import lookup, parse_flag
from caseloom.operators.shape import melt, ordinal_of, reindex
from caseloom.sources.readers import present
from caseloom.sources.writers import checkpointed

PREVALENCE_COLUMNS = ["cohort_dimension", "cohort_value", "cohort_size", "diabetes_count", "prevalence_rate"]


def cohort_prevalence(
    df: DataFrame,
    dimensions: Sequence[str] | Mapping[str, Column] = tuple(spec.COHORT_DIMENSIONS),
    label: str = spec.LABEL,
) -> DataFrame:
    """Size, positives and rounded positive rate of every value of every dimension.

    Rows with an invalid label count in the size only. Absent dimensions are skipped.
    """
    if not isinstance(dimensions, Mapping):
        dimensions = {name: F.col(name) for name in present(df, dimensions)}
    positive = F.coalesce((parse_flag(F.col(label).cast("string")) == 1).cast("int"), F.lit(0))
    long = melt(df, dimensions, {"positive": positive}, "cohort_dimension", "cohort_value")
    return (
        long.groupBy("cohort_dimension", "cohort_value")
        .agg(F.count("*").alias("cohort_size"), F.sum("positive").alias("diabetes_count"))
        .withColumn("prevalence_rate", F.round(F.col("diabetes_count") / F.col("cohort_size"), 4))
    )


def in_dimension_order(summary: DataFrame, dimensions: Sequence[str] = tuple(spec.COHORT_DIMENSIONS)) -> DataFrame:
    """Sort a long summary by dimension as listed, then by value as text."""
    return summary.orderBy(ordinal_of(F.col("cohort_dimension"), dimensions), F.col("cohort_value"))


def value_frequencies(df: DataFrame, columns: Sequence[str] = tuple(spec.FREQUENCY_COLUMNS)) -> DataFrame:
    """Rows per value of each column."""
    long = melt(df, {name: F.col(name) for name in present(df, columns)}, {}, "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("row_count"))


def steady_mean(name: str) -> Column:
    """Mean of a column, the same whatever the order of the rows.

    A sum of doubles depends on its order, which shows where a mean lies on the edge of rounding. Here
    the values are added as decimals of ten places; only a column with a value that is none (infinite,
    NaN or from 1e12) is added as doubles.
    """
    exact = F.col(name).try_cast("decimal(22,10)")
    return F.when(F.count(exact) == F.count(name), F.avg(exact).cast("double")).otherwise(F.avg(name))


def bmi_bucket_summary(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """Per BMI band: rows, mean glucose/HbA1c ratio, positive rate and its tier; highest rate first.

    Rows with zero HbA1c are left out. A label other than 1 is no positive, as in the other summaries. The tier is taken from the unrounded rate.
    """
    rows = df.where(F.col("hbA1c_level") != 0).select(
        bucketize(F.col("bmi"), spec.BMI_COHORT).alias("bucket"),
        F.try_divide("blood_glucose_level", "hbA1c_level").alias("ratio"),
        (F.col(label) == 1).alias("y"),
    )
    stats = rows.groupBy("bucket").agg(
        F.count("*").alias("count"), steady_mean("ratio").alias("ratio"), (F.count_if("y") / F.count("*")).alias("rate")
    )
    return stats.select(
        "bucket",
        "count",
        F.round("ratio", 4).alias("avg_ratio"),
        F.round("rate", 4).alias("diabetes_rate"),
        rate_tier(F.col("rate")).alias("tier"),
    ).orderBy(F.desc("diabetes_rate"), "bucket")


def yearly_summary(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """Per year: rows, positive rate, mean BMI and mean glucose, over rows with all four values."""
    needed = ["year", "bmi", "blood_glucose_level", label]
    return (
        df.select(*needed)
        .na.drop()
        .groupBy("year")
        .agg(
            F.count("*").alias("count"),
            F.round(F.count_if(F.col(label) == 1) / F.count("*"), 4).alias("diabetes_rate"),
            F.round(steady_mean("bmi"), 4).alias("avg_bmi"),
            F.round(steady_mean("blood_glucose_level"), 4).alias("avg_blood_glucose"),
        )
        .orderBy("year")
    )


def comorbidity_profile(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """Per (hypertension, heart disease): rows, rate, mean/min/max of three measures, lab outliers."""
    measures = {"bmi": "bmi", "hba1c": "hbA1c_level", "glucose": "blood_glucose_level"}
    spread = [
        F.round(aggregate(column), 4).alias(f"{prefix}_{name}")
        for name, column in measures.items()
        for prefix, aggregate in (("mean", steady_mean), ("min", F.min), ("max", F.max))
    ]
    keys = ["hypertension", "heart_disease"]
    outlier = lab_outlier(F.col("hbA1c_level"), F.col("blood_glucose_level"))
    return (
        df.select(*keys, *measures.values(), label)
        .na.drop()
        .groupBy(*keys)
        .agg(
            F.count("*").alias("count"),
            F.round(F.count_if(F.col(label) == 1) / F.count("*"), 4).alias("diabetes_rate"),
            *spread,
            F.count_if(outlier).alias("outlier_count"),
        )
        .orderBy(*keys)
    )


RISK_DIMENSIONS: dict[str, spec.Bands] = {
    "hbA1c_level": spec.HBA1C_RANGE,
    "blood_glucose_level": spec.GLUCOSE_RANGE,
    "bmi": spec.BMI_RANGE,
    "age": spec.AGE_RANGE,
}
BINARY_RISK_DIMENSIONS = ("hypertension", "heart_disease")


def risk_aggregation(df: DataFrame, score: str = "score", label: str = spec.LABEL) -> DataFrame:
    """Rows, mean score and positive rate per band of six dimensions, long form."""
    dimensions = {name: bucketize(F.col(name), bands) for name, bands in RISK_DIMENSIONS.items()}
    dimensions |= {name: F.col(name) for name in BINARY_RISK_DIMENSIONS}
    long = melt(df, dimensions, {"p": F.col(score), "y": F.col(label)}, "dimension", "bucket")
    return long.groupBy("dimension", "bucket").agg(
        F.count("*").alias("n"), F.avg("p").alias("avg_prob"), F.avg("y").alias("diabetic_rate")
    )


def predicted_vs_actual(aggregated: DataFrame, dimension: str, order: Sequence[str] | None = None) -> DataFrame:
    """One dimension of the risk aggregation in band order, empty bands kept as NULL."""
    order = RISK_DIMENSIONS[dimension].labels if order is None else order
    one = aggregated.where(F.col("dimension") == dimension).drop("dimension")
    return reindex(one, "bucket", order).orderBy("ord")


def flag_risk(aggregated: DataFrame, dimension: str, titles: Mapping[int, str] | None = None) -> DataFrame:
    """A 0/1 dimension of the risk aggregation with display names, 0 first."""
    titles = spec.FLAG_TITLES[dimension] if titles is None else titles
    one = aggregated.where(F.col("dimension") == dimension).withColumn("bucket", F.col("bucket").try_cast("int"))
    return one.withColumn("label", lookup(F.col("bucket"), titles)).orderBy("bucket")


def risk_band_summary(df: DataFrame, band: str = "risk_band", score: str = "score", label: str = spec.LABEL) -> DataFrame:
    """Rows, mean score and positive rate per risk band, lowest mean score first."""
    return (
        df.groupBy(band)
        .agg(F.count("*").alias("n"), F.avg(score).alias("avg_prob"), F.avg(label).alias("diabetic_rate"))
        .orderBy("avg_prob")
    )


def class_counts(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count("*").alias("row_count"))


def data_card(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """One-row description: size, years, locations, class counts, shares and imbalance."""
    facts = df.agg(
        F.count("*").alias("records"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_distinct("location").alias("locations"),
        F.sum(label).alias("positives"),
    )
    positives, records = F.col("positives"), F.col("records")
    return facts.select(
        "records",
        F.lit(len(df.columns)).alias("features"),
        "first_year",
        "last_year",
        "locations",
        "positives",
        (records - positives).alias("negatives"),
        F.round(F.try_divide(positives * 100.0, records), 4).alias("positive_percent"),
        F.round(F.try_divide((records - positives) * 100.0, records), 4).alias("negative_percent"),
        F.round(F.try_divide((records - positives) * 1.0, positives), 4).alias("imbalance_ratio"),
    )


def rows_per_year(df: DataFrame) -> DataFrame:
    """Rows per year in year order."""
    return df.groupBy("year").agg(F.count("*").alias("row_count")).orderBy("year")


def bucket_shares(df: DataFrame, dimensions: Mapping[str, tuple[Column, Sequence[str]]]) -> DataFrame:
    """Percent of banded rows per band, in band order, for several dimensions from one scan.

    `dimensions` maps a name to its banded column and its full label order. Rows outside all bands do
    not count in the total; a band without rows is kept as NULL.
    """
    long = melt(df, {name: column for name, (column, _) in dimensions.items()}, {}, "dimension", "bucket")
    counts = long.where(F.col("bucket").isNotNull()).groupBy("dimension", "bucket").agg(F.count("*").alias("n"))
    fixed = df.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("dimension"), F.lit(i).alias("ord"), F.lit(label).alias("bucket"))
                    for name, (_, labels) in dimensions.items()
                    for i, label in enumerate(labels)
                ]
            )
        )
    )
    labels = {label for _, known in dimensions.values() for label in known}
    known = counts.where(F.col("bucket").isin(*labels))  # no longer than dimensions x labels
    total = F.sum("n").over(Window.partitionBy("dimension"))
    return (
        fixed.join(F.broadcast(known), ["dimension", "bucket"], "left")
        .withColumn("percent", F.try_divide(F.col("n") * 100.0, total))
        .select("dimension", "ord", "bucket", "n", "percent")
    )


def label_crosstab(
    df: DataFrame,
    bucket: Column,
    order: Sequence[str],
    label: str = spec.LABEL,
    titles: Mapping[int, str] | None = None,
) -> DataFrame:
    """Rows per band and class, zero where a combination has none, in band order."""
    titles = {0: "no_diabetes", 1: "diabetes"} if titles is None else titles
    grouped = df.select(bucket.alias("bucket"), F.col(label).alias("y")).where(F.col("bucket").isNotNull())
    wide = grouped.groupBy("bucket").pivot("y", list(titles)).agg(F.count(F.lit(1)))
    wide = wide.select("bucket", *[F.coalesce(F.col(f"`{code}`"), F.lit(0)).alias(name) for code, name in titles.items()])
    return reindex(wide, "bucket", order).orderBy("ord")


def group_rates(df: DataFrame, dimensions: Mapping[str, Column], label: str = spec.LABEL) -> DataFrame:
    """Labelled rows, positives and percent rate per group, next to the overall percent rate.

    All groups and the whole table, as one more dimension with a single value, come from one scan. The
    groups are stored, since they are read twice. Rows outside all bands count in the overall rate.
    """
    whole = "all rows"
    long = melt(df, {**dimensions, whole: F.lit(whole)}, {"y": F.col(label)}, "dimension", "bucket")
    stats = checkpointed(
        long.where(F.col("bucket").isNotNull())
        .groupBy("dimension", "bucket")
        .agg(F.count("y").alias("total"), F.sum("y").alias("diabetic"))
        .withColumn("rate", F.try_divide(F.col("diabetic"), F.col("total")) * 100)
    )
    overall = stats.where(F.col("dimension") == whole).select("rate").scalar()
    return stats.where(F.col("dimension") != whole).withColumn("overall_rate", overall)


def comorbidity_tiers(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """Rates of the four comorbidity tiers in order, each with its ratio to the first tier's rate."""
    tier = comorbidity_tier(F.col("hypertension"), F.col("heart_disease"))
    rates = group_rates(df, {"tier": tier}, label).drop("dimension")
    ordered = reindex(rates, "bucket", spec.COMORBIDITY_TIERS)
    # Four rows by now, so the window holds no more than that.
    first = F.first("rate").over(Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    return (
        ordered.withColumn("ratio_to_first", F.try_divide("rate", first))
        .withColumn("title", lookup(F.col("bucket"), spec.COMORBIDITY_TITLES))
        .orderBy("ord")
    )


def rate_ratios(rates: DataFrame, baseline: Mapping[str, str], rate: str = "rate") -> DataFrame:
    """Each group's rate over the rate of its dimension's baseline group.

    `rates` has one row per (dimension, bucket); it is stored, since it is read twice. A dimension
    without a baseline gets NULL.
    """
    rates = checkpointed(rates)
    dimension = F.col("dimension")
    found = [
        F.max(F.when((dimension == name) & (F.col("bucket") == bucket), F.col(rate))).alias(f"b{i}")
        for i, (name, bucket) in enumerate(baseline.items())
    ]
    bases = rates.agg(*found).select(F.struct(*[f"b{i}" for i in range(len(found))])).scalar()
    chosen = F.coalesce(*[F.when(dimension == name, bases.getField(f"b{i}")) for i, name in enumerate(baseline)])
    return rates.withColumn("rate_ratio", F.try_divide(F.col(rate), chosen))
