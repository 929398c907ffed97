"""Repeatable stratified splits: a row's part depends on its key and class, whatever the partitioning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.operators.radix import codes_at
from caseloom.sources.scratch import Scratch

_STEPS = 1_000_000


def hash_draw(*keys: Column | str, seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the keys and the seed, whatever the partitioning."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(_STEPS)) / _STEPS


def assign_split(
    df: DataFrame, draw: Column, weights: Mapping[str, float] | None = None, name: str = "split"
) -> DataFrame:
    """Name each row's part by comparing a draw in [0, 1) with the running weights."""
    weights = spec.SPLIT_WEIGHTS if weights is None else weights
    *first, last = weights
    bound, chain, whole = 0.0, None, sum(weights.values())
    for part in first:
        bound = round(bound + weights[part] / whole, 12)
        chain = (F if chain is None else chain).when(draw < bound, F.lit(part))
    return df.withColumn(name, F.lit(last) if chain is None else chain.otherwise(F.lit(last)))


def md5_draw(*keys: str, seed: int = 42) -> Column:
    """A whole number of 60 bits fixed by the keys and the seed: the first 15 hex digits of their md5."""
    text = F.concat_ws(":", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def stratified_split(
    df: DataFrame,
    key: str = "row_id",
    label: str = spec.LABEL,
    weights: Mapping[str, float] | None = None,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Split at random inside each class, in exact shares.

    Each row draws a number from its key and class. Per class, the draws at the ranks where one part
    ends and the next begins are found by counting (`radix.codes_at`), and rows are dealt by comparing
    with them: nothing is sorted, and a row's part does not depend on the partitioning. A part of a class
    of n rows ends at rank round(n * running weight), so it has its share to within one row; rows equal
    in key and class draw equal numbers and go together. `df` is read again for each pass of the counting
    only through its key and label, which are stored first; store `df` itself if it is costly to compute.
    """
    weights = spec.SPLIT_WEIGHTS if weights is None else weights
    *first, last = weights
    whole, bound, ends = sum(weights.values()), 0.0, []
    for part in first:
        bound = round(bound + weights[part] / whole, 12)
        ends.append(F.struct(F.lit(part).alias("name"), F.floor(F.col("n") * F.lit(bound) + 0.5).alias("rank")))
    draw = md5_draw(key, label, seed=seed)
    if not ends:
        return df.withColumn(name, F.lit(last))
    with Scratch(df.sparkSession, "split") as run:
        # A class of its own for rows without label.
        group = F.coalesce(F.col(f"`{label}`").cast("string"), F.lit(""))
        rows = run.keep(df.select(group.alias("group"), draw.alias("code")), "draws")
        sizes = rows.groupBy("group").agg(F.count("*").alias("n"))
        wanted = run.keep(sizes.select("group", F.inline(F.array(*ends))), "wanted")
        found = codes_at(rows, wanted, run, bits=60, step=15)
        # A part that ends with its class ends at no row.
        after = wanted.join(found.drop("smaller"), ["group", "name"], "left").withColumn("code", F.coalesce("code", F.lit(1 << 60)))
        table = run.lasting(after.groupBy("group").agg(*[F.max(F.when(F.col("name") == p, F.col("code"))).alias(p) for p in first]), "ends")
    bounds = table.select(F.col("group").alias("_split_group"), *[F.col(f"`{p}`").alias(f"_split_end_{i}") for i, p in enumerate(first)])
    chain = None
    for i, part in enumerate(first):
        chain = (F if chain is None else chain).when(F.col("_split_draw") < F.col(f"_split_end_{i}"), F.lit(part))
    dealt = df.withColumns({"_split_group": group, "_split_draw": draw}).join(bounds, "_split_group", "left")
    return dealt.withColumn(name, chain.otherwise(F.lit(last))).select(*[F.col(f"`{c}`") for c in df.columns if c != name], name)


def split_parts(df: DataFrame, weights: Mapping[str, float] | None = None, name: str = "split") -> dict[str, DataFrame]:
    """The parts of a split table, each without the split column."""
    weights = spec.SPLIT_WEIGHTS if weights is None else weights
    return {part: df.where(F.col(name) == part).drop(name) for part in weights}


def split_counts(df: DataFrame, label: str = spec.LABEL, name: str = "split") -> DataFrame:
    """Rows per part and class."""
    return df.groupBy(name, label).agg(F.count("*").alias("row_count"))
