"""Delimited text in which every record is accounted for: parsed rows, and a stored table of the rest."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.sources.readers import clean_header, read_delimited, string_schema
from caseloom.sources.writers import write_counted

RECORD, FILE, MALFORMED = "_record", "_file", "_malformed"


@dataclass(frozen=True)
class Checked:
    """A stored delimited table: its records by whether they have the header's number of fields."""

    stored: DataFrame
    counts: Mapping[str, int]

    @property
    def good(self) -> DataFrame:
        """The well-formed rows; a pruned scan of their folder."""
        return self.stored.where(~F.col(MALFORMED)).drop(RECORD, FILE, MALFORMED)

    @property
    def bad(self) -> DataFrame:
        """The malformed records as they stand in the text, with their file."""
        return self.stored.where(F.col(MALFORMED)).select(F.col(RECORD).alias("record"), F.col(FILE).alias("file"))

    @property
    def every(self) -> DataFrame:
        """All rows, malformed ones as a lenient reader takes them: short ones filled up with NULL, long ones cut."""
        return self.stored.drop(RECORD, FILE, MALFORMED)


def read_checked(
    spark: SparkSession,
    path: str,
    out: str,
    sep: str = ",",
    names: Sequence[str] | None = None,
    multi_line: bool = True,
    view: Callable[[DataFrame], DataFrame] | None = None,
    counts: Mapping[str, Column] | None = None,
) -> Checked:
    """Read delimited files that share one header, store every record under `out`, and count them.

    Each field is a string. The reader is permissive: a record with too few or too many fields is kept
    with its text and its file, in a folder of its own. Each file's header is compared with the first
    one's (or with `names`) where the file is read; another order or another name is an error, as its
    cells would land in wrong columns. `multi_line` takes a quoted line break as part of its field; each
    file is then one task, so give a large table as many files, or turn it off where no field has one.

    `view` turns the string columns into those to be stored (a projection, or typed columns), so text
    is read and parsed once. `counts` are further aggregates over the stored columns. The counts
    `rows_in`, `rows_good` and `rows_bad` and these are taken by the job that writes; the first is the
    sum of the other two. Blank lines are no records. An empty file or a missing header is an error.
    """
    if names is None:
        # Names as they stand, spaces included: the header check compares them with each file's.
        names = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).csv(path).columns
    read_delimited(spark, path, sep, names)  # its checks of delimiter and header
    if not names:
        raise ValueError(f"{path}: empty file or missing header")
    reader = spark.read.options(sep=sep, header=True, escape='"', encoding="UTF-8", mode="PERMISSIVE")
    reader = reader.options(multiLine=multi_line, enforceSchema=False, columnNameOfCorruptRecord=RECORD)
    records = reader.schema(string_schema([*names, RECORD])).csv(path)
    own = {RECORD: F.col(RECORD), FILE: F.col("_metadata.file_path"), MALFORMED: F.col(RECORD).isNotNull()}
    marked = records.withColumns(own)
    fields = clean_header(marked.select(*[F.col(f"`{n}`") for n in names], *own))
    kept = fields if view is None else _viewed(fields, view, list(own))
    taken = {"rows_in": F.count("*"), "rows_good": F.count_if(~F.col(MALFORMED)), "rows_bad": F.count_if(F.col(MALFORMED))}
    found = write_counted(kept, out, {**taken, **(counts or {})}, [MALFORMED])
    return Checked(spark.read.schema(kept.schema).parquet(out), found)


def _viewed(fields: DataFrame, view: Callable[[DataFrame], DataFrame], own: Sequence[str]) -> DataFrame:
    """The view's columns beside the reader's own ones; the view sees, and returns, rows one to one."""
    shown = view(fields)
    if not set(own) <= set(shown.columns):
        raise ValueError(f"the view must keep the columns {', '.join(own)}")
    return shown
