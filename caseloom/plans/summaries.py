"""Normalise raw text, keep valid rows, write three grouped summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.operators.cohorts import bmi_bucket_summary, comorbidity_profile, yearly_summary
from caseloom.operators.filters import dropped_report, keep_valid, kept_counts, typed
from caseloom.sources.readers import file_headers, normalized_lines, read_file_lines, read_table, table_from_files
from caseloom.sources.scratch import Scratch
from caseloom.sources.writers import write_counted, write_lines, write_report, write_table


def run_summaries(spark: SparkSession, source: str, out: str) -> dict[str, str]:
    """From a raw comma-separated file or folder to the summaries under `out`; returns their paths."""
    lines = read_file_lines(spark, source)
    tidy = normalized_lines(lines)
    paths = {
        "before_sample": write_lines(lines.limit(20), f"{out}/before_sample"),
        "after_sample": write_lines(tidy.limit(20), f"{out}/after_sample"),
    }
    rules = {"loose": spec.LOOSE_VALIDITY}
    with Scratch(spark, "summaries") as run:
        headers = run.keep(file_headers(tidy), "headers")
        seen = Observation()
        table = typed(table_from_files(tidy, headers, taken=seen))
        # The text is parsed once; lines of each kind and valid rows are counted by the job that writes.
        counts = write_counted(table, f"{out}/typed", kept_counts(rules))
    paths["typed"] = f"{out}/typed"
    lines_seen = spark.createDataFrame(list(seen.get.items()), "kind string, line_count long")
    paths["line_counts"] = write_report(lines_seen, f"{out}/line_counts", ["kind"], sep="\t")
    paths["dropped_rows"] = write_report(dropped_report(spark, counts, rules), f"{out}/dropped_rows", sep="\t")
    rows = read_table(spark, paths["typed"])
    paths["filtered"] = write_table(keep_valid(rows, spec.LOOSE_VALIDITY), f"{out}/filtered")
    kept = read_table(spark, paths["filtered"])
    reports: dict[str, tuple[DataFrame, list]] = {
        "bmi_bucket_summary": (bmi_bucket_summary(kept), [F.desc("diabetes_rate"), "bucket"]),
        "yearly_summary": (yearly_summary(kept), ["year"]),
        "numeric_signals": (comorbidity_profile(kept), ["hypertension", "heart_disease"]),
    }
    for name, (table, order) in reports.items():
        paths[name] = write_report(table, f"{out}/{name}", order, sep="\t", four_decimals=True)
    return paths
