"""Table and line sources. Delimited text is read as strings; parsing is the caller's choice."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import spec
from caseloom.functions.text import normalize_line


def _check_delimiter(sep: str) -> None:
    if len(sep) != 1:
        raise ValueError("delimiter must be a single character")


def string_schema(names: Iterable[str]) -> T.StructType:
    """An all-string schema, so that dirty values never change a column's type."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def clean_header(df: DataFrame, lower: bool = False) -> DataFrame:
    """Strip white space around column names, lower-casing them if asked."""
    names = [name.strip() for name in df.columns]
    return df.toDF(*[name.lower() if lower else name for name in names])


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    names: Sequence[str] | None = None,
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Read delimited text with every field a string.

    With `names` no pass over the files is needed to find the header. `multi_line` accepts quoted
    line breaks but makes each file a single task, so it is off by default.
    """
    _check_delimiter(sep)
    reader = (
        spark.read.option("sep", sep)
        .option("header", header)
        .option("inferSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("encoding", "UTF-8")
    )
    if names is not None:
        reader = reader.schema(string_schema(names)).option("enforceSchema", True)
    df = reader.csv(path)
    if not df.columns:
        raise ValueError(f"{path}: empty file or missing header")
    return clean_header(df) if header else df


def has_header(spark: SparkSession, path: str, sep: str = ",") -> bool:
    """True if any cell of the first row is not all digits."""
    _check_delimiter(sep)
    first = spark.read.option("sep", sep).option("inferSchema", False).csv(path).first()
    if first is None:
        raise ValueError(f"{path}: empty file")
    return any(not (cell or "").isdigit() for cell in first)


def read_with_detected_header(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Read delimited text, taking the first row as header if it looks like one."""
    return read_delimited(spark, path, sep, header=has_header(spark, path, sep))


def key_and_category(df: DataFrame) -> tuple[str, str]:
    """Names of the key and category columns: the first known name, else the first and second column."""

    def pick(candidates: Sequence[str], fallback: int) -> str:
        known = {name.strip().lower(): name for name in reversed(df.columns)}
        found = [known[name] for name in candidates if name in known]
        return found[0] if found else df.columns[min(fallback, len(df.columns) - 1)]

    return pick(spec.KEY_NAMES, 0), pick(spec.CATEGORY_NAMES, 1)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail at plan time if a needed column is absent."""
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of `columns` the table has, in the order given."""
    return [name for name in columns if name in df.columns]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines as one `value` column."""
    return spark.read.text(path)


def table_from_lines(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """Split normalised lines into string columns named by the first line.

    Only the header line comes to the driver. Every repeat of it is left out, so a folder of files
    that each start with a header reads as one table.
    """
    first = lines.first()
    if first is None or not first[0]:
        raise ValueError("empty input or missing header")
    header = first[0]
    names = [name.strip() for name in header.split(sep)]
    fields = F.split(F.col("value"), f"\\{sep}" if sep in "|.^$*+?" else sep)
    body = lines.where((F.col("value") != header) & (F.col("value") != ""))
    return body.select(*[F.get(fields, i).alias(name) for i, name in enumerate(names)])


def read_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines with the file and the block they stand in: `value`, `file`, `block`."""
    place = {"file": "_metadata.file_path", "block": "_metadata.file_block_start"}
    return spark.read.text(path).select("value", *[F.col(c).alias(name) for name, c in place.items()])


def file_headers(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """One row per file: its first line and the trimmed names in it.

    `lines` is as from `read_file_lines`, normalised or not. A file's first line is the one of the
    lowest block and place inside it; each task keeps one line per file.
    """
    numbered = lines.withColumn("line", F.monotonically_increasing_id())
    first = numbered.groupBy("file").agg(F.min_by("value", F.struct("block", "line")).alias("header"))
    names = F.transform(F.split("header", f"\\{sep}" if sep in "|.^$*+?" else sep), F.trim)
    return first.withColumn("names", names)


#: What a line of a file is; all but rows are left out of the table, and all are counted.
LINE_KINDS = ("header", "blank", "row")


def table_from_files(lines: DataFrame, headers: DataFrame, sep: str = "\t", taken: Observation | None = None) -> DataFrame:
    """Split lines into string columns, each file by its own header; `headers` is a stored `file_headers`.

    The columns are those of all headers, in the order in which files by name first have them; a file
    without one of them gives NULL there, as does a line that is too short. Cells beyond a file's header
    are left out. `taken` receives the number of lines of each kind: blank lines, lines equal to the
    file's header (one a file, and any repeat of it), and rows, which add up to all lines read. Headers
    are one row per file, and the join is left to Spark; names come to the driver, lines do not.
    """
    distinct = headers.groupBy("names").agg(F.min("file").alias("file"))
    found = distinct.agg(F.sort_array(F.collect_list(F.struct("file", "names"))).alias("all")).first()["all"]
    names = [name for name in dict.fromkeys(n for row in found for n in row["names"]) if name]
    if not names:
        raise ValueError("empty input or missing header")
    value = F.col("value")
    kind = F.when(F.trim(value) == "", "blank").when(value == F.col("header"), "header").otherwise("row")
    marked = lines.select("file", "value").join(headers, "file").withColumn("kind", kind)
    if taken is not None:
        counts = [F.count_if(F.col("kind") == k).alias(k) for k in LINE_KINDS]
        marked = marked.observe(taken, F.count("*").alias("lines"), *counts)
    cells = F.split(value, f"\\{sep}" if sep in "|.^$*+?" else sep)
    at = {name: F.array_position("names", name).cast("int") for name in names}
    return marked.where("kind = 'row'").select(
        *[F.when(position > 0, F.get(cells, position - 1)).alias(name) for name, position in at.items()]
    )


def normalized_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Apply the line normaliser to one text column."""
    return lines.withColumn(column, normalize_line(F.col(column)))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read Parquet, projected to `columns`."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{name}`") for name in columns]) if columns else df


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """Read a result table written as CSV files with a header."""
    return read_delimited(spark, path)


def single_row(df: DataFrame) -> Row:
    """The row of a one-row result table."""
    row = df.first()
    if row is None:
        raise ValueError("result table is empty")
    return row
