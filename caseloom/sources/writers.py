"""Table, report, model and manifest sinks."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.text import four_places
from caseloom.sources.scratch import session_scratch


def write_table(df: DataFrame, path: str) -> str:
    """Write Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_counted(df: DataFrame, path: str, counts: Mapping[str, Column], partition_by: Sequence[str] = ()) -> dict[str, int]:
    """Write Parquet, and return aggregates of the rows taken by the same job.

    The counts ride on the tasks that write, so no second pass reads or parses the source. A retried
    task counts once, as its output does.
    """
    taken = Observation()
    measured = df.observe(taken, *[value.alias(name) for name, value in counts.items()])
    writer = measured.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return dict(taken.get)


def _table_name(path: str) -> str:
    return f"stored_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write Parquet dealt and sorted by a key, so that tables of the same key join without a shuffle.

    One shuffle here puts each bucket into one task, hence one file per bucket and partition value.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(*partition_by) if partition_by else writer).option("path", path).saveAsTable(_table_name(path))
    return read_bucketed(spark, path, key, buckets)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A table of `write_bucketed`; a later session, which does not know it yet, learns its layout first."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        kept = spark.read.parquet(path)
        inside = {c for c in kept.columns for f in kept.inputFiles()[:1] if f"/{c}=" in f}
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
        parted = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in inside)}) " if inside else ""
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {parted}"
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        if inside:
            spark.catalog.recoverPartitions(name)
    return spark.table(name)


def write_delimited(df: DataFrame, path: str, columns: Sequence[str] | None = None, sep: str = ",") -> str:
    """Write delimited text with a header in a fixed column order; any size, one file per task."""
    out = df.select(*[F.col(f"`{name}`") for name in columns]) if columns else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("emptyValue", "").csv(path)
    return path


def write_report(
    df: DataFrame,
    path: str,
    order: Sequence[str | Column] = (),
    columns: Sequence[str] | None = None,
    sep: str = ",",
    four_decimals: bool = False,
) -> str:
    """Write an aggregated report as one sorted file, fractions as fixed four-decimal text if asked.

    Only finished rows move to the single writer; the aggregation above it stays spread out.
    """
    one = df.repartition(1)
    if order:
        one = one.sortWithinPartitions(*order)
    if four_decimals:
        one = one.withColumns({name: four_places(F.col(name)) for name, kind in df.dtypes if kind == "double"})
    return write_delimited(one, path, columns, sep)


def write_lines(df: DataFrame, path: str, column: str = "value") -> str:
    """Write one text column as lines."""
    df.select(column).write.mode("overwrite").text(path)
    return path


def save_model(model, path: str) -> str:
    """Save a fitted model, replacing what is there."""
    model.write().overwrite().save(path)
    return path


def checkpointed(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Store the rows as a Parquet table in the shared scratch folder and go on from there.

    A filter on a column of `partition_by` then reads only the files of the wanted values.

    A later plan starts at a pruned file scan. The table stays until the application ends, because the
    plan returned to the caller reads it; steps with an end of their own use a `Scratch` and drop theirs.
    """
    return session_scratch(df.sparkSession).keep(df, "stored", partition_by)


OUTPUT_STATUS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def check_outputs(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Row count of each written CSV table, or MISSING with the error. Run it after the last writer."""
    found = []
    for name, path in paths.items():
        try:
            count = spark.read.option("header", True).csv(path).count()
            found.append((name, path, count, "OK", None))
        except AnalysisException as error:
            found.append((name, path, None, "MISSING", str(error)))
    return spark.createDataFrame(found, OUTPUT_STATUS)


def write_manifest(final_path: str, final_rows: int, outputs: DataFrame, path: str) -> str:
    """Write one JSON document naming the final table and every checked output.

    `outputs` has one row per named output of a run.
    """
    entry = F.struct(
        "path",
        "row_count",
        F.when(F.col("status") != "OK", F.col("status")).alias("status"),
        "error",
    )
    by_name = F.map_from_entries(F.collect_list(F.struct("name", entry)))
    final = F.struct(F.lit(final_path).alias("path"), F.lit(final_rows).cast("bigint").alias("row_count"))
    document = outputs.agg(by_name.alias("evaluation")).select(final.alias("final_dataset"), "evaluation")
    document.coalesce(1).write.mode("overwrite").json(path)
    return path
