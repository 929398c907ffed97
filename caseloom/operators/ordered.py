"""Exact global order without a global window.

A window over a whole table sorts it in one task. Here the rows are first cut into ordered parts; a
window runs inside each part, and the sums of the parts before it (one row per part, so a bounded
broadcast) are added. Results do not depend on where the cuts fall.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import shuffle_width
from caseloom.sources.writers import checkpointed

_BEFORE = (Window.unboundedPreceding, -1)
_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def number_rows(df: DataFrame, *order: Column | str, name: str = "rank", parts: int | None = None) -> DataFrame:
    """Number all rows 1, 2, … in a total order, whatever the number of rows.

    `order` must not tie. The range-partitioned rows are stored, so the part sizes and the
    numbered rows come from the same cut even if an executor is lost.
    """
    parts = parts or shuffle_width(df.sparkSession)
    placed = checkpointed(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                # The low 33 bits of the id are the position inside the partition.
                "_position": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_position") + 1).alias(name), *df.columns
    )


def cut_points(df: DataFrame, key: str, parts: int) -> list[float]:
    """At most parts - 1 approximate quantiles of a number column."""
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(df.approxQuantile(key, shares, 0.5 / parts)))


def running_totals(
    table: DataFrame, key: str, measures: Sequence[str], descending: bool = False, parts: int | None = None
) -> DataFrame:
    """Add `cum_<m>` (running sum up to and with the row, in key order) and `total_<m>` per measure.

    `table` has one row per key value; a value held by very many rows must have been folded before.
    """
    parts = parts or shuffle_width(table.sparkSession)
    cuts = cut_points(table, key, parts)
    if cuts:
        # Infinite values belong to the outer parts; as cuts they would repeat an edge.
        infinite = (float("-inf"), float("inf"))
        edges = [infinite[0], *(c for c in cuts if c not in infinite), infinite[1]]
        cut = Bucketizer(splits=edges, inputCol=key, outputCol="_part").transform(table)
        cut = cut.withColumn("_part", F.col("_part").cast("int"))
    else:
        cut = table.withColumn("_part", F.lit(0))

    direction = F.desc if descending else F.asc
    sums = cut.groupBy("_part").agg(*[F.sum(m).alias(m) for m in measures])
    part_order = Window.orderBy(direction("_part"))
    offsets = sums.select(
        "_part",
        *[F.coalesce(F.sum(m).over(part_order.rowsBetween(*_BEFORE)), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(m).over(part_order.rowsBetween(*_WHOLE)).alias(f"total_{m}") for m in measures],
    )
    inside = Window.partitionBy("_part").orderBy(direction(key)).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({f"_local_{m}": F.sum(m).over(inside) for m in measures})
    return local.join(F.broadcast(offsets), "_part").select(
        *table.columns,
        *[(F.col(f"_local_{m}") + F.col(f"_before_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"total_{m}") for m in measures],
    )
