"""Registered queries against their SQL, and the shape of their plans."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from compare import connect, differences

import __spark_entry__ as entry_points
from caseloom.catalog import oracle, queries
from caseloom.operators import cohorts, metrics, ranking
from caseloom.operators.cleaning import clean_rows
from caseloom.operators.shape import share_of_total
from caseloom.sources.encounters import encounters, raw_encounters
from caseloom.sources.readers import read_table
from caseloom.sources.writers import write_table

CATALOG, SQL = queries.registered(), oracle.sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, con, name):
    assert differences(CATALOG[name](spark, folder), con, SQL[name]) == []


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 20 and [r["rank"] for r in rows] == list(range(1, 21))
    assert entry_points.queries().keys() >= CATALOG.keys() and entry_points.oracle_sql().items() >= SQL.items()
    assert set(SQL) < set(CATALOG)


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    write_table(raw_encounters(spark, folder), f"{path}/raw")
    write_table(encounters(spark, folder), f"{path}/typed")
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, operator):
    return len(re.findall(rf"\b{operator}\b", text))


def test_all_dimensions_come_from_one_scan_and_one_shuffle(spark, stored):
    raw = read_table(spark, f"{stored}/raw")
    text = plan(cohorts.cohort_prevalence(clean_rows(raw)))
    assert (count(text, "FileScan"), count(text, "Exchange"), count(text, "Expand")) == (1, 1, 1)
    text = plan(cohorts.risk_aggregation(read_table(spark, f"{stored}/typed")))
    assert (count(text, "FileScan"), count(text, "Exchange")) == (1, 1)


def test_summaries_read_twice_are_stored_once(spark, stored):
    typed = read_table(spark, f"{stored}/typed")
    rates = cohorts.group_rates(typed, {"location": typed.location})
    ratios = cohorts.rate_ratios(rates, {"location": "NATION_0"})
    for df in (rates, ratios, share_of_total(cohorts.rows_per_year(typed), "row_count", "percent")):
        text = plan(df)
        assert stored not in text and "/scratch-" in text


def test_scans_are_pruned_and_filters_pushed(spark, stored):
    from caseloom import spec
    from caseloom.operators.filters import keep_valid

    typed = read_table(spark, f"{stored}/typed")
    text = plan(keep_valid(typed, spec.STRICT_VALIDITY).select("row_id"))
    assert "GreaterThanOrEqual(bmi,10.0)" in text and "In(diabetes, [0,1])" in text
    text = plan(cohorts.rows_per_year(typed))
    assert re.search(r"ReadSchema: struct<year:int>", text)


def test_unused_joins_are_left_out(spark, folder):
    text = plan(cohorts.rows_per_year(encounters(spark, folder, ["year"])))
    assert "Join" not in text and "lineitem" not in text


def test_a_customer_with_a_third_of_all_orders_is_split(spark, tmp_path):
    source = "/root/testdata/sf0.01"
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("o_custkey"))
    orders = spark.read.parquet(f"{source}/orders.parquet").withColumn("o_custkey", hot)
    orders.repartition(8).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("customer", "nation"):
        write_table(spark.read.parquet(f"{source}/{name}.parquet"), f"{tmp_path}/{name}.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = encounters(spark, str(tmp_path), ["row_id", "smoking_history"])
        rows = df.collect()
        text = plan(df)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len({r.row_id for r in rows}) == len(rows) == 15000
    assert "SortMergeJoin(skew=true)" in text


def test_no_cross_joins_or_python_workers(spark, folder, stored):
    typed = read_table(spark, f"{stored}/typed")
    for df in (
        metrics.metrics_row(typed, typed),
        cohorts.group_rates(typed, {"location": typed.location}),
        ranking.rank_locations(cohorts.cohort_prevalence(typed, ["location"]), 10),
    ):
        text = plan(df)
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
            assert operator not in text


def test_library_keeps_data_off_the_driver():
    package = Path(queries.__file__).parents[1]
    for path in package.rglob("*.py"):
        if "llm" in path.relative_to(package).parts:
            continue  # that subpackage has a rule of its own, beside its tests
        text = path.read_text()
        for word in ("toPandas", ".collect()", "localCheckpoint", "crossJoin", "applyInPandas", "@udf", ".rdd"):
            assert word not in text, f"{word} in {path.name}"


@pytest.mark.parametrize("name", ["comorbidity_profile", "yearly_summary", "bmi_bucket_summary", "validity_filter_strict", "dropped_rows"])
def test_filtered_columns_are_parsed_once(spark, folder, name):
    text = plan(CATALOG[name](spark, folder))
    assert "regexp_extract" not in text and "/scratch-" in text


def test_raw_columns_bring_only_their_joins(spark, folder):
    some = raw_encounters(spark, folder, ["bmi", "race:Other"])
    assert some.columns == ["row_id", "bmi", "race:Other"] and count(plan(some), "FileScan") == 2
    whole = raw_encounters(spark, folder).select("row_id", "bmi", F.col("`race:Other`"))
    assert some.exceptAll(whole).count() == whole.exceptAll(some).count() == 0
    assert raw_encounters(spark, folder, ["location"]).exceptAll(raw_encounters(spark, folder).select("row_id", "location")).count() == 0


def test_model_parts_are_stored_apart(spark, folder):
    parts = queries._model_parts(spark, folder)
    text = plan(parts["train"])
    assert "md5" not in text and "Join" not in text and re.search(r"PartitionFilters: \[[^\]]*split", text)
    assert sum(p.count() for p in parts.values()) == queries._model_rows(spark, folder).count()
