"""Small shared table shapes: one wide aggregate read as rows, fixed label lists, melted dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.text import lookup
from caseloom.sources.writers import checkpointed


def label_table(spark: SparkSession, labels: Sequence[str], name: str, ordinal: str = "ord") -> DataFrame:
    """A literal table of labels and their positions."""
    rows = [F.struct(F.lit(i).alias(ordinal), F.lit(label).alias(name)) for i, label in enumerate(labels)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def tally(df: DataFrame, key: str, counters: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Many named aggregates from one pass, as one output row per name.

    `counters` maps a row name to its aggregates; every row has the same aggregate names.
    """
    wide: list[Column] = []
    rows: list[Column] = []
    for i, (name, measures) in enumerate(counters.items()):
        fields = [F.lit(name).alias(key)]
        for j, (measure, aggregate) in enumerate(measures.items()):
            wide.append(aggregate.alias(f"m{i}_{j}"))
            fields.append(F.col(f"m{i}_{j}").alias(measure))
        rows.append(F.struct(*fields))
    return df.agg(*wide).select(F.inline(F.array(*rows)))


def melt(
    df: DataFrame,
    dimensions: Mapping[str, Column],
    measures: Mapping[str, Column],
    dimension: str = "dimension",
    value: str = "value",
) -> DataFrame:
    """One row per input row and dimension, with the dimension's value as text.

    Grouping the result by (dimension, value) yields every dimension from a single scan: the rows are
    multiplied inside the task and folded again by map-side combining before anything is shuffled.
    """
    wide = df.select(
        *[column.alias(name) for name, column in measures.items()],
        *[column.cast("string").alias(f"d_{name}") for name, column in dimensions.items()],
    )
    # Unpivot takes the dimension name from the column name, so rename in a second, free projection.
    wide = wide.select(
        *[F.col(f"`{name}`").alias(f"m_{name}") for name in measures],
        *[F.col(f"`d_{name}`").alias(name) for name in dimensions],
    )
    values = [F.col(f"`{name}`") for name in dimensions]
    long = wide.unpivot([f"m_{name}" for name in measures], values, dimension, value)
    return long.select(dimension, value, *[F.col(f"m_{name}").alias(name) for name in measures])


def ordinal_of(c: Column, names: Sequence[str]) -> Column:
    """Position of a name in a fixed list, for explicit tie-breaking; unlisted names come last."""
    return F.coalesce(lookup(c, {name: i for i, name in enumerate(names)}), F.lit(len(names)))


def reindex(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Keep exactly `labels`, in order; a label without a row gets NULLs.

    `df` has one row per label, so after the filter it is no longer than the label list.
    """
    fixed = label_table(df.sparkSession, labels, column)
    known = df.where(F.col(column).isin(*labels))
    return fixed.join(known, column, "left").select("ord", *df.columns)


def share_of_total(df: DataFrame, count: str, name: str, scale: float = 100.0) -> DataFrame:
    """Add each row's share of the table's total. The summary is stored, since it is read twice."""
    df = checkpointed(df)
    total = df.agg(F.sum(count)).scalar()
    return df.withColumn(name, F.try_divide(F.col(count) * scale, total))
