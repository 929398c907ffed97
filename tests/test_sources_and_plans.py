"""Readers, writers, and the three end-to-end runs on text files."""

from __future__ import annotations

import functools
import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.plans import scoring
from caseloom.plans.evidence import run_evidence
from caseloom.plans.scoring import joined_final, prepare, run_scoring
from caseloom.plans.overview import run_overview
from caseloom.plans.results import run_results
from caseloom.plans.summaries import run_summaries
from caseloom.sources import readers, writers
from caseloom.sources.encounters import raw_encounters


@pytest.fixture(scope="module")
def raw_csv(spark, folder, tmp_path_factory):
    """The dirty encounters as a folder of comma-separated files, each with a header."""
    path = str(tmp_path_factory.mktemp("raw") / "encounters")
    rows = raw_encounters(spark, folder).drop("row_id").repartition(3)
    rows.write.option("header", True).option("emptyValue", "").csv(path)
    return path


def lines_of(path):
    return [line for part in sorted(Path(path).glob("part-*")) for line in part.read_text().splitlines()]


def test_delimited_reader(spark, tmp_path):
    source = tmp_path / "a.csv"
    source.write_text('id, name \n1,"x ""y"", z"\n2\n')
    df = readers.read_delimited(spark, str(source))
    assert df.columns == ["id", "name"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", 'x "y", z'), ("2", None)]
    with pytest.raises(ValueError):
        readers.read_delimited(spark, str(source), sep="||")
    with pytest.raises(ValueError):
        readers.require_columns(df, ["id", "absent"])
    named = readers.read_delimited(spark, str(source), names=["k", "v"])
    assert named.columns == ["k", "v"] and named.count() == 2


def test_empty_input_is_an_error(spark, tmp_path):
    source = tmp_path / "empty.csv"
    source.write_text("")
    with pytest.raises(ValueError):
        readers.read_delimited(spark, str(source))
    with pytest.raises(ValueError):
        readers.read_with_detected_header(spark, str(source))
    with pytest.raises(ValueError):
        readers.table_from_lines(readers.read_lines(spark, str(source)))


def test_header_detection(spark, tmp_path):
    (tmp_path / "with.csv").write_text("Patient_ID,x,Race\n1,2,a\n")
    (tmp_path / "without.csv").write_text("1,2\n3,4\n")
    with_header = readers.read_with_detected_header(spark, str(tmp_path / "with.csv"))
    assert with_header.count() == 1 and readers.key_and_category(with_header) == ("Patient_ID", "Race")
    without = readers.read_with_detected_header(spark, str(tmp_path / "without.csv"))
    assert without.count() == 2 and readers.key_and_category(without) == ("_c0", "_c1")


def test_lines_become_a_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "1.csv").write_text(" a , b \r\n1 , No Info\r\n")
    (tmp_path / "t" / "2.csv").write_text("a,b\n2\n")
    tidy = readers.normalized_lines(readers.read_lines(spark, str(tmp_path / "t")))
    table = readers.table_from_lines(tidy)
    assert sorted(tuple(r) for r in table.collect()) == [("1", "no_info"), ("2", None)]
    assert readers.clean_header(table.toDF(" A ", "B"), lower=True).columns == ["a", "b"]


def test_reports_are_one_sorted_file(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "n int, t string").repartition(3)
    path = writers.write_report(df, str(tmp_path / "r"), [F.desc("n")], ["t", "n"], sep="\t")
    assert lines_of(path) == ["t\tn", "\t3", "b\t2", "a\t1"]
    assert readers.single_row(readers.read_delimited(spark, path, "\t")).asDict() == {"t": None, "n": "3"}
    writers.write_report(df.limit(1), path)
    assert len(lines_of(path)) == 2


def test_checkpoint_uses_the_session_folder(spark):
    df = writers.checkpointed(spark.range(5))
    assert df.count() == 5
    assert all(spark.conf.get("spark.checkpoint.dir") in path for path in df.inputFiles())
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_output_check_and_manifest(spark, tmp_path):
    there = writers.write_report(spark.range(3), str(tmp_path / "there"))
    status = writers.check_outputs(spark, {"there": there, "gone": str(tmp_path / "gone")})
    assert {r.name: (r.status, r.row_count) for r in status.collect()} == {"there": ("OK", 3), "gone": ("MISSING", None)}
    path = writers.write_manifest("final", 7, status, str(tmp_path / "manifest"))
    manifest = json.loads(lines_of(path)[0])
    assert manifest["final_dataset"] == {"path": "final", "row_count": 7}
    assert manifest["evaluation"]["there"] == {"path": there, "row_count": 3}
    assert manifest["evaluation"]["gone"]["status"] == "MISSING" and "error" in manifest["evaluation"]["gone"]


def test_summaries_run(spark, raw_csv, tmp_path):
    paths = run_summaries(spark, raw_csv, str(tmp_path))
    dropped = lines_of(paths["dropped_rows"])[1].split("\t")
    assert dropped[0] == "loose" and int(dropped[1]) == 1500 == int(dropped[2]) + int(dropped[3])
    kept = int(dropped[2])
    counted = dict(line.split("\t") for line in lines_of(paths["line_counts"])[1:])
    assert int(counted["lines"]) == sum(int(counted[k]) for k in readers.LINE_KINDS) and counted["row"] == "1500"
    bmi = [line.split("\t") for line in lines_of(paths["bmi_bucket_summary"])]
    assert bmi[0] == ["bucket", "count", "avg_ratio", "diabetes_rate", "tier"]
    assert sum(int(r[1]) for r in bmi[1:]) == kept
    assert all(len(r[3].split(".")[1]) == 4 for r in bmi[1:])
    rates = [float(r[3]) for r in bmi[1:]]
    assert rates == sorted(rates, reverse=True)
    years = [line.split("\t") for line in lines_of(paths["yearly_summary"])]
    assert sum(int(r[1]) for r in years[1:]) == kept and years[1:] == sorted(years[1:])
    assert len(lines_of(paths["numeric_signals"])[0].split("\t")) == 14
    assert len(lines_of(paths["before_sample"])) == 20
    assert "\t" in lines_of(paths["after_sample"])[0]


def test_evidence_run(spark, raw_csv, tmp_path):
    paths = run_evidence(spark, raw_csv, str(tmp_path), min_size=50)
    cleaned = readers.read_delimited(spark, paths["cleaned_csv"])
    assert cleaned.columns == spec.CLEAN_COLUMNS and cleaned.count() == 1500
    summary = readers.read_delimited(spark, paths["cohorts"])
    sizes = summary.groupBy("cohort_dimension").agg(F.sum(F.col("cohort_size").cast("int")).alias("n")).collect()
    assert len(sizes) == 8 and {r.n for r in sizes} == {1500}
    ranked = [r for r in lines_of(paths["ranked_profiles"])[1:]]
    assert len(ranked) == 20 and ranked[0].startswith("1,")
    locations = lines_of(paths["ranked_locations"])
    assert locations[0].startswith("rank,location") or locations[0].startswith("rank")
    assert len(lines_of(paths["rules"])) == 7
    assert len(lines_of(paths["key_repeats"])) == 8
    assert any(line.startswith("size,table,rows,1500") for line in lines_of(paths["data_quality"]))


def test_plans_account_for_malformed_records(spark, raw_csv, tmp_path):
    """A quoted line break is one record, a short and a long record are set aside, in all flows."""
    source = tmp_path / "in"
    source.mkdir()
    for part in Path(raw_csv).glob("part-*"):
        (source / part.name).write_text(part.read_text())
    header = lines_of(raw_csv)[0]
    fields = ["2015", "Female", "40.0", '"NATION\n1"', "0", "0", "1", "0", "0", "0", "0", "never", "25.0", "5.5", "120.0", "0"]
    rows = [",".join(fields), "2015,Female,40.0", ",".join([*fields, "more"])]
    (source / "part-zz.csv").write_text("\n".join([header, *rows]) + "\n")
    assert len(header.split(",")) == len(fields)

    paths = run_evidence(spark, str(source), str(tmp_path / "evidence"), min_size=50)
    counts = dict(line.split(",") for line in lines_of(paths["record_counts"])[1:])
    assert counts == {"rows_in": "1503", "rows_good": "1501", "rows_bad": "2"}
    assert sorted(r.record for r in readers.read_table(spark, paths["rejected"]).collect()) == sorted(rows[1:])
    assert readers.read_table(spark, paths["cleaned"]).count() == 1503
    assert lines_of(paths["cleaned_size"])[1] == f"1503,{len(spec.CLEAN_COLUMNS)}"
    assert readers.read_table(spark, paths["cleaned"]).where("location LIKE '%\n%'").count() == 2

    prepare(spark, str(source), str(tmp_path / "scoring"))
    dropped = lines_of(tmp_path / "scoring/evaluation/dropped_rows")[1].split(",")
    assert dropped[1] == "1503" and int(dropped[2]) + int(dropped[3]) == 1503
    assert readers.read_table(spark, str(tmp_path / "scoring/processed")).count() == int(dropped[2])
    assert readers.read_table(spark, str(tmp_path / "scoring/rejected")).count() == 2
    with pytest.raises(ValueError):
        (source / "part-00.csv").write_text("a,b\n1,2\n")
        prepare(spark, str(source / "part-00.csv"), str(tmp_path / "other"))


def test_a_bucketed_table_joins_without_a_shuffle_in_any_session(spark, tmp_path):
    left = writers.write_bucketed(spark.range(100).selectExpr("id AS row_id", "id % 3 AS part"), f"{tmp_path}/l", "row_id", 4, ["part"])
    right = writers.write_bucketed(spark.range(50).selectExpr("id AS row_id", "id * 2 AS v"), f"{tmp_path}/r", "row_id", 4)
    assert len(list(Path(f"{tmp_path}/r").glob("part-*"))) == 4
    for _ in range(2):
        joined = left.where("part = 1").hint("merge").join(right.hint("merge"), "row_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "PartitionFilters: [isnotnull(part" in plan
        assert joined.count() == 17
        for name in ("l", "r"):  # as a later session would find them: files, but no table
            spark.sql(f"DROP TABLE {writers._table_name(f'{tmp_path}/{name}')}")
        left, right = (writers.read_bucketed(spark, f"{tmp_path}/{name}", "row_id", 4) for name in ("l", "r"))


def test_overview_run(spark, raw_csv, tmp_path):
    paths = run_overview(spark, raw_csv, str(tmp_path))
    shown = {name: readers.read_result(spark, path).collect() for name, path in paths.items() if name not in ("raw", "typed")}
    (card,) = shown["data_card"]
    assert card.records == "1500" and sum(int(r.row_count) for r in shown["rows_per_year"]) == 1500
    for name, n in (("crosstab_age", 4), ("crosstab_bmi", 4), ("comorbidity_tiers", 4), ("top_locations", 15), ("top_profiles", 5)):
        assert len(shown[name]) == n, name
    missing = spark.read.parquet(paths["raw"]).where("age IS NULL OR trim(age) = ''").count()
    assert {r.column_name: int(r.missing_rows) for r in shown["missing_counts"]}["age"] == missing > 0
    rates = [float(r.rate) for r in shown["top_locations"]]
    assert rates == sorted(rates, reverse=True)


def test_scoring_run(spark, raw_csv, tmp_path, monkeypatch):
    out = str(tmp_path)
    status = run_scoring(spark, raw_csv, out)
    assert {r.status for r in status.collect()} == {"OK"} and status.count() == 5
    final = readers.read_table(spark, f"{out}/predictions/final_dataset")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in joined_final(spark, out)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 0 < int(readers.read_result(spark, f"{out}/evaluation/training_lr").first().iterations) <= 25
    used = readers.read_result(spark, f"{out}/evaluation/usable_rows_lr").first()
    assert used.rows_in == used.rows_used and used.bad_label == used.bad_score == "0"
    assert readers.read_result(spark, f"{out}/evaluation/calibration_check_tuning").count() == 1
    seconds = {p.name: p.stat().st_mtime for p in Path(out, "models").iterdir()}
    # Lost after the models: what is there is kept, and what comes after is made again.
    shutil.rmtree(f"{out}/predictions/final_dataset")
    ran = []
    for name in ("prepare", "split", "logistic", "forest", "assemble_final", "aggregate_risk"):
        step = getattr(scoring, name)
        monkeypatch.setattr(scoring, name, functools.wraps(step)(lambda *a, s=step: (ran.append(s.__name__), s(*a))))
    run_scoring(spark, raw_csv, out)
    assert ran == ["assemble_final", "aggregate_risk"]
    assert seconds == {p.name: p.stat().st_mtime for p in Path(out, "models").iterdir()}
    run_scoring(spark, raw_csv, out)
    assert len(ran) == 2
    final = readers.read_table(spark, f"{out}/predictions/final_dataset")
    results = run_results(spark, out)
    shown = {name: readers.read_result(spark, path).collect() for name, path in results.items()}
    assert sum(float(r.percent) for r in shown["confusion_shares"]) == pytest.approx(100, abs=1e-6)
    assert sum(float(r.percent) for r in shown["band_shares"]) == pytest.approx(100, abs=1e-6)
    assert {r.metric for r in shown["model_comparison"]} == {"auc_roc", "auc_pr"}
    assert all(float(r.lr) > 0.8 and float(r.rf) > 0.8 for r in shown["model_comparison"] if r.metric == "auc_roc")
    assert [len(shown[f"predicted_vs_actual_{n}"]) for n in ("bmi", "hbA1c_level")] == [4, 3]
    assert [r.label for r in shown["flag_risk_heart_disease"]] == ["No Heart Disease", "Heart Disease"]
    lost = readers.read_result(spark, f"{out}/evaluation/key_loss").collect()
    assert len(lost) == 3 and {r.rows_lost for r in lost} == {"0"}
    parts = {r.split: r["count"] for r in readers.read_table(spark, f"{out}/features").groupBy("split").count().collect()}
    test_rows = parts["test"]
    assert abs(parts["train"] - 0.7 * sum(parts.values())) <= 2
    assert final.count() == test_rows > 200

    row = readers.single_row(readers.read_result(spark, f"{out}/evaluation/metrics_lr"))
    assert list(row.asDict()) == sorted(row.asDict())
    tp, tn, fp, fn = (int(row[name]) for name in ("tp", "tn", "fp", "fn"))
    assert tp + tn + fp + fn == test_rows
    assert float(row.accuracy) == pytest.approx((tp + tn) / test_rows, abs=1e-4)
    assert float(row.auc_roc) > 0.8

    aggregated = readers.read_result(spark, f"{out}/evaluation/risk_aggregation_lr").select(
        "dimension", *[F.col(c).cast("double").alias(c) for c in ("n", "avg_prob", "diabetic_rate")]
    )
    totals = aggregated.groupBy("dimension").agg(
        F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("diabetic_rate"))).alias("y"),
        F.round(F.sum(F.col("n") * F.col("avg_prob")), 6).alias("p")).collect()
    assert len(totals) == 6 and len({(r.n, r.y, r.p) for r in totals}) == 1
    bands = readers.read_result(spark, f"{out}/evaluation/risk_summary_lr")
    assert sum(int(r.n) for r in bands.collect()) == test_rows
    importance = readers.read_result(spark, f"{out}/evaluation/feature_importance_rf").collect()
    assert sum(float(r.importance) for r in importance) == pytest.approx(1.0, abs=1e-3)
    manifest = json.loads(lines_of(f"{out}/manifest")[0])
    assert manifest["final_dataset"]["row_count"] == test_rows and len(manifest["evaluation"]) == 5
