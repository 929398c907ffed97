"""Exact order statistics by counting: histograms of leading bits, refined only where a wanted rank lies.

Nothing is sorted and no row moves: a pass folds rows to one count per bucket inside each task. The
number of passes depends on the width of the codes, not on the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.sources.scratch import Scratch

_BEFORE = (Window.unboundedPreceding, -1)


def double_code(value: Column) -> Column:
    """A whole number that orders as the double does: its bits, negated for negative values.

    Infinities are the outermost codes, both zeros are 0, subnormal numbers are covered; NULL and NaN
    give NULL. Powers of two are exact, so sign, exponent and fraction are read off without loss.
    """
    size = F.abs(value)
    guess = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(size)).cast("double")))
    power = lambda e: F.pow(F.lit(2.0), e)
    exponent = F.when(size < power(guess), guess - 1).when(size / 2 >= power(guess), guess + 1).otherwise(guess)
    step = float(1 << 52)
    normal = ((exponent + 1023).cast("long") * (1 << 52)) + ((size / power(exponent) - 1) * step).cast("long")
    small = (size * 2.0**537 * 2.0**537).cast("long")
    bits = F.when(size == float("inf"), F.lit(2047 << 52)).when(size < 2.0**-1022, small).otherwise(normal)
    return F.when(value.isNull() | F.isnan(value), None).when(value < 0, -bits).otherwise(bits)


def code_double(code: Column) -> Column:
    """The double of a `double_code`."""
    bits = F.abs(code)
    exponent = (F.shiftright(bits, 52) - 1023).cast("double")
    fraction = bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / float(1 << 52)
    small = fraction * 2.0**-1022
    size = (
        F.when(bits == 2047 << 52, F.lit(float("inf")))
        .when(bits < 1 << 52, small)
        .otherwise((1 + fraction) * F.pow(F.lit(2.0), exponent))
    )
    return F.when(code < 0, -size).otherwise(size)


def codes_at(
    rows: DataFrame, wanted: DataFrame, run: Scratch, group: str = "group", code: str = "code", bits: int = 64, step: int = 16
) -> DataFrame:
    """The code at each wanted rank of its group, and how many rows of the group have a smaller one.

    `rows` has a group and a whole-number code of `bits` bits (signed if 64) and should be stored: each
    pass reads these two columns. `wanted` has group, name and rank, counted from 0; a rank the group
    does not have is left out. Returns group, name, code, smaller. The first pass counts rows by group
    and the `step` leading bits; each further one only rows in the buckets that hold a wanted rank, by
    the next bits. A group is folded inside the tasks, so one that holds most rows is no hot spot.
    """
    if bits % step:
        raise ValueError("bits must be a multiple of step")
    bounds = wanted.select(group, "name", F.col("rank").cast("long").alias("left"), F.lit(0).cast("long").alias("smaller"))
    for shift in range(bits - step, -1, -step):
        bucket = F.shiftright(code, shift).alias("bucket")
        if shift == bits - step:
            counted, keys = rows.groupBy(group, bucket).agg(F.count("*").alias("n")), [group]
        else:
            inside = rows.withColumn("prefix", F.shiftright(code, shift + step))
            open_ = bounds.select(group, "prefix").distinct()
            keys = [group, "prefix"]
            counted = inside.join(open_, keys, "left_semi").groupBy(*keys, bucket).agg(F.count("*").alias("n"))
        order = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(*_BEFORE)
        running = counted.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
        hit = bounds.join(running, keys).where("before <= left AND left < before + n")
        old, bounds = bounds, run.keep(
            hit.select(
                group,
                "name",
                (F.col("left") - F.col("before")).alias("left"),
                (F.col("smaller") + F.col("before")).alias("smaller"),
                F.col("bucket").alias("prefix"),
            ),
            "ranks",
        )
        if shift != bits - step:
            run.drop(old)
    return bounds.select(group, "name", F.col("prefix").alias("code"), "smaller")
