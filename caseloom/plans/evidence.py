"""Profile, clean, summarise cohorts, rank, screen rules and check keys."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from caseloom.operators.cleaning import clean_rows
from caseloom.operators.cohorts import PREVALENCE_COLUMNS, cohort_prevalence, in_dimension_order, value_frequencies
from caseloom.operators.quality import category_values, derived_field_checks, key_repeats, profile_report
from caseloom.operators.ranking import rank_cohorts, rank_locations, typed_summary
from caseloom.operators.rules import screen_rules
from caseloom.sources.quarantine import read_checked
from caseloom.sources.readers import has_header, key_and_category, read_delimited, read_result, read_table
from caseloom.sources.writers import write_delimited, write_report, write_table
from caseloom import spec


def run_evidence(
    spark: SparkSession, source: str, out: str, sep: str = ",", min_size: int = spec.MIN_COHORT_SIZE, multi_line: bool = True
) -> dict[str, str]:
    """From a raw delimited file or folder to the evidence tables under `out`; returns their paths."""
    # The text is split into columns once; the steps below read the stored columns they need. Short and
    # long records take part as a lenient reader has them, and stand with their text under `rejected`.
    checked = read_checked(spark, source, f"{out}/raw", sep, multi_line=multi_line)
    paths = {"raw": f"{out}/raw", "rejected": write_table(checked.bad, f"{out}/rejected")}
    found = spark.createDataFrame(list(checked.counts.items()), "records string, row_count long")
    paths["record_counts"] = write_report(found, f"{out}/record_counts", ["records"])
    raw = checked.every
    report = profile_report(raw).orderBy("section", "column_name", "metric")
    paths["data_quality"] = write_delimited(report, f"{out}/data_quality")

    paths["cleaned"] = write_table(clean_rows(raw), f"{out}/cleaned")
    cleaned = read_table(spark, paths["cleaned"])
    size = spark.createDataFrame([(cleaned.count(), len(spec.CLEAN_COLUMNS))], "row_count long, column_count int")
    paths["cleaned_size"] = write_report(size, f"{out}/cleaned_size")
    paths["cleaned_csv"] = write_delimited(cleaned, f"{out}/cleaned_csv", spec.CLEAN_COLUMNS)
    paths["value_frequencies"] = write_delimited(value_frequencies(cleaned).orderBy("column_name", "value"), f"{out}/value_frequencies")
    paths["derived_field_checks"] = write_report(derived_field_checks(cleaned), f"{out}/derived_field_checks")

    paths["cohorts"] = write_delimited(in_dimension_order(cohort_prevalence(cleaned)), f"{out}/cohorts", PREVALENCE_COLUMNS)
    summary = typed_summary(read_result(spark, paths["cohorts"]))
    paths["ranked_profiles"] = write_report(rank_cohorts(summary, min_size=min_size), f"{out}/ranked_profiles", ["rank"])
    paths["ranked_locations"] = write_delimited(rank_locations(summary, min_size).orderBy("rank"), f"{out}/ranked_locations")

    paths["rules"] = write_report(screen_rules(cleaned), f"{out}/rules", [F.desc("prevalence_rate"), "rule_name"])

    keyed = raw if has_header(spark, source, sep) else read_delimited(spark, source, sep, header=False)
    key, category = key_and_category(keyed)
    paths["key_repeats"] = write_report(key_repeats(keyed, key), f"{out}/key_repeats", [F.desc("row_count"), "key"])
    paths["category_values"] = write_report(category_values(keyed, category), f"{out}/category_values", ["category"])
    return paths
