"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import store

BITS, LEVELS, SALTS = 10, 4, 32


def mixing_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    source: str = "source",
) -> DataFrame:
    """One row per source: its size and its target.

    `sizes` has one row per source with column `source_size`. Weights repeat over the sources by code
    point, null last. Targets stop at `most` times the source size; what is over goes to the other
    sources by weight until none is above. That fixed point is target = min(cap, weight * level): with
    sources in order of cap / weight, the level that is left for a source and those after it rises as
    long as sources are filled and falls from then on, so its greatest value is the one.
    The windows run over one row per source, never over documents.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = (
        sizes.withColumn("_w", table[((F.row_number().over(by_name) - 1) % len(weights))])
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_fill", F.col("_cap") / F.col("_w"))
    )
    everything = Window.partitionBy()
    order = Window.orderBy("_fill", F.col(source).asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )
    rows = rows.withColumn("_level", level)
    rows = rows.withColumn("_level", F.max("_level").over(everything))
    target = F.least("_cap", F.col("_w") * F.col("_level"))
    return rows.select(source, "source_size", target.alias("target"))


def mix_sources(
    spark: SparkSession,
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """How often the mix takes each document: key, source, size, source_size, target, copies, taken.

    A source with target T and size S takes every document floor(T / S) times, and the rest of its
    target from the documents whose hash lies under a threshold. The threshold comes from histograms:
    words by source and hash bucket, then only the bucket that holds the boundary is split further, by
    the next bits. Whichever side of the last boundary lies nearer to the target is taken. No sort and
    no draw: reruns agree. Rows equal in key and text hash alike and go together.

    Null text has size 0; a null source is a source of its own; null keys are kept. An empty table
    gives no rows. Extra columns are ignored. Documents of size 0 take 0.
    """
    text_col = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(F.col(key), text_col, F.lit(seed)).alias("_hash"),
    )
    slim = store(spark, slim, "mix")
    targets = store(
        spark,
        mixing_targets(slim.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size")), weights, share, most),
        "mix-targets",
    )
    plan = targets.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("base"),
    ).withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
    bounds = plan.select("_source", "rest", F.lit(0.0).alias("below"))
    salted = slim.withColumn("_salt", F.pmod("_hash", F.lit(SALTS)))
    for depth in range(LEVELS):
        bounds = store(spark, _refine(salted, bounds, depth), "mix-bounds")
    joined = _with_source(salted, plan.join(bounds.drop("rest", "below"), F.expr("_source <=> _bs"), "left").drop("_bs"))
    extra = _under(depth=LEVELS)
    copies = (F.col("base") + F.when(extra, 1).otherwise(0)).cast("long")
    return joined.select(
        F.col("_key").alias(key),
        F.col("_source").alias(source),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _bucket(depth: int) -> Column:
    return F.shiftrightunsigned("_hash", 64 - BITS * (depth + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def _with_source(salted: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join on source and salt, so that a source with most rows is spread over many tasks."""
    right = per_source.withColumnRenamed("_source", "_rs").withColumn("_rsalt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    return salted.join(right, F.expr("_source <=> _rs AND _salt = _rsalt")).drop("_rs", "_rsalt")


def _refine(salted: DataFrame, bounds: DataFrame, depth: int) -> DataFrame:
    """Find, per source, the bucket at `depth` in which the running sum passes the rest."""
    rows = salted
    if depth:
        inside = reduce(lambda a, b: a & b, [_bucket(d) == F.col(f"b{d}") for d in range(depth)])
        rows = _with_source(salted, bounds.withColumnRenamed("_bs", "_source").drop("rest", "below")).where(inside)
    sums = rows.groupBy("_source", _bucket(depth).alias("_b")).agg(F.sum("size").alias("_n"))
    named = bounds.withColumnRenamed("_bs", "_source") if depth else bounds
    running = Window.partitionBy("_source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    left = named.withColumnRenamed("_source", "_bs")
    hit = left.join(sums, F.expr("_bs <=> _source")).where(
        (F.col("below") + F.col("_before") <= F.col("rest")) & (F.col("below") + F.col("_before") + F.col("_n") > F.col("rest"))
    )
    below = F.col("below") + F.col("_before")
    near = (F.col("rest") - below) > (below + F.col("_n") - F.col("rest"))
    old = [f"b{d}" for d in range(depth)]
    return hit.select("_bs", "rest", below.alias("below"), *old, F.col("_b").alias(f"b{depth}"), near.alias("near"))


def _under(depth: int) -> Column:
    """True where the hash lies under its source's threshold, or in the last bucket if that is nearer."""
    found = F.col("near")
    for d in reversed(range(depth)):
        found = F.when(_bucket(d) < F.col(f"b{d}"), True).when(_bucket(d) > F.col(f"b{d}"), False).otherwise(found)
    return F.coalesce(found, F.lit(False))
