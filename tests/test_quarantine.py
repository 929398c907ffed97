"""Every record and every line accounted for: quarantine, headers per file, counts taken while writing."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from caseloom.sources import readers
from caseloom.sources.quarantine import read_checked
from caseloom.sources.scratch import Scratch
from caseloom.sources.writers import write_counted


def files(folder, **texts):
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_records_in_are_good_and_bad(spark, tmp_path):
    source = files(
        tmp_path / "in",
        one='id, name ,note\n1,a,"two\nlines"\n2,b\n\n3,c,d,e\n4,"say ""x""",\n',
        two="id, name ,note\n5,e,f\n6\n",
    )
    checked = read_checked(spark, source, str(tmp_path / "out"))
    assert checked.counts == {"rows_in": 6, "rows_good": 3, "rows_bad": 3}
    assert sorted(tuple(r) for r in checked.good.collect()) == [("1", "a", "two\nlines"), ("4", 'say "x"', None), ("5", "e", "f")]
    assert checked.good.columns == ["id", "name", "note"]
    bad = {(r.record, r.file.rsplit("/", 1)[1]) for r in checked.bad.collect()}
    assert bad == {("2,b", "one.csv"), ("3,c,d,e", "one.csv"), ("6", "two.csv")}
    every = {r.id: (r.name, r.note) for r in checked.every.collect()}
    assert len(every) == 6 and every["2"] == ("b", None) and every["3"] == ("c", "d")
    plan = checked.good.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan and "PartitionFilters" in plan


def test_two_orders_of_one_header_are_an_error(spark, tmp_path):
    source = files(tmp_path / "in", one="a,b\n1,2\n", two="b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_checked(spark, source, str(tmp_path / "out"))
    with pytest.raises(ValueError):
        read_checked(spark, source, str(tmp_path / "out"), sep="||")
    with pytest.raises(ValueError):
        read_checked(spark, files(tmp_path / "empty", one=""), str(tmp_path / "out"))


def test_views_are_parsed_in_the_same_job(spark, tmp_path):
    source = files(tmp_path / "in", one="a,b\n1,2\nx,3\n4\n")
    view = lambda df: df.withColumn("a", F.expr("try_cast(a AS INT)")).drop("b")
    checked = read_checked(spark, source, str(tmp_path / "out"), view=view, counts={"numbers": F.count("a")})
    assert checked.counts == {"rows_in": 3, "rows_good": 2, "rows_bad": 1, "numbers": 2}
    assert sorted(str(r.a) for r in checked.every.collect()) == ["1", "4", "None"] and checked.good.columns == ["a"]
    with pytest.raises(ValueError):
        read_checked(spark, source, str(tmp_path / "out2"), view=lambda df: df.select("a"))


def test_counts_come_with_the_write(spark, tmp_path):
    rows = spark.range(100).repartition(7)
    counts = {"rows": F.count("*"), "even": F.count_if(F.col("id") % 2 == 0)}
    assert write_counted(rows, str(tmp_path / "t"), counts) == {"rows": 100, "even": 50}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    source = files(
        tmp_path / "in", one=" a , b \n1,2\n\n3\na,b\n", two="b,a,c\n4,5,6,7\nb,a,c\n", three="c\n8\n"
    )
    lines = readers.normalized_lines(readers.read_file_lines(spark, source))
    taken = Observation()
    with Scratch(spark, "lines") as run:
        headers = run.keep(readers.file_headers(lines), "headers")
        table = readers.table_from_files(lines, headers, taken=taken)
        assert table.columns == ["a", "b", "c"]
        got = [tuple(r) for r in table.collect()]
    assert sorted(got, key=str) == sorted([("1", "2", None), ("3", None, None), ("5", "4", "6"), (None, None, "8")], key=str)
    assert taken.get == {"lines": 10, "header": 5, "blank": 1, "row": 4}


def test_a_folder_without_lines_has_no_header(spark, tmp_path):
    lines = readers.read_file_lines(spark, files(tmp_path / "in", one=""))
    with pytest.raises(ValueError):
        readers.table_from_files(lines, readers.file_headers(lines))
