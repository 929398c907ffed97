"""Row filters, validity rules and row identity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.text import is_missing, parse_double, parse_whole, plain_whole
from caseloom.operators.shape import tally


def typed(df: DataFrame) -> DataFrame:
    """Typed view of raw string encounters: numbers, 0/1 flags and stripped text; bad values are NULL."""
    def column(name: str) -> Column:
        source = F.col(f"`{name}`")
        if name == "year":
            return plain_whole(source).cast("int")
        if name in spec.NUMERIC_COLUMNS:
            return parse_double(source)
        if name in spec.BINARY_COLUMNS:
            # Any whole number, so that values out of the 0/1 domain stay visible to the rules.
            return plain_whole(source)
        return source

    return df.select(*[column(name).alias(name) for name in df.columns])


def within(column: str, limits: spec.Limits) -> Column:
    """Inside the interval; the lower end is left out if open."""
    c = F.col(column)
    above = c > float(limits.low) if limits.open_low else c >= float(limits.low)
    return above & (c <= float(limits.high))


def is_valid(rules: spec.Validity) -> Column:
    """One predicate for a whole rule set; NULL or NaN in a checked column fails it."""
    checked = {*rules.binary, *rules.ranges}
    parts = [F.col(name).isin(0, 1) for name in rules.binary]
    parts += [within(name, limits) for name, limits in rules.ranges.items()]
    # A domain or interval test already fails NULL and NaN (NaN sorts above every limit).
    parts += [F.col(name).isNotNull() & ~F.isnan(name) for name in rules.required if name not in checked]
    return reduce(lambda left, right: left & right, parts)


def keep_valid(df: DataFrame, rules: spec.Validity) -> DataFrame:
    """Rows passing a rule set.

    Store `typed` rows first: the tests then reach the scan as pushed filters. Over unstored rows the
    filter moves below the parsing, and each of its conditions parses its column again.
    """
    return df.where(is_valid(rules))


def dropped_rows(df: DataFrame, rule_sets: Mapping[str, spec.Validity]) -> DataFrame:
    """Rows read, kept and dropped for each rule set, all from one pass."""
    return tally(
        df,
        "rule_set",
        {
            name: {
                "rows_in": F.count("*"),
                "rows_kept": F.count_if(is_valid(rules)),
                "rows_dropped": F.count("*") - F.count_if(is_valid(rules)),
            }
            for name, rules in rule_sets.items()
        },
    )


def kept_counts(rule_sets: Mapping[str, spec.Validity]) -> dict[str, Column]:
    """Aggregates to take along with a write: the rows written and the rows each rule set would keep."""
    return {"rows": F.count("*"), **{f"{name}_kept": F.count_if(is_valid(rules)) for name, rules in rule_sets.items()}}


def dropped_report(spark: SparkSession, counts: Mapping[str, int], rule_sets: Mapping[str, spec.Validity]) -> DataFrame:
    """The table of `dropped_rows` from counts taken during a write."""
    rows = [(name, counts["rows"], kept := counts[f"{name}_kept"], counts["rows"] - kept) for name in rule_sets]
    return spark.createDataFrame(rows, "rule_set string, rows_in long, rows_kept long, rows_dropped long")


def all_given(columns: Sequence[str]) -> Column:
    """True where every named column holds a value other than the empty string."""
    given = [F.coalesce(F.col(f"`{name}`").cast("string") != "", F.lit(False)) for name in columns]
    return reduce(lambda left, right: left & right, given)


def parsed_only(df: DataFrame, numbers: Mapping[str, str]) -> DataFrame:
    """Parse text columns ('whole' or 'double') and drop rows where any of them does not parse."""
    parse = {"whole": parse_whole, "double": parse_double}
    out = df.withColumns({name: parse[kind](F.col(name).cast("string")) for name, kind in numbers.items()})
    return out.na.drop(subset=list(numbers))


def with_row_id(df: DataFrame, key: str | None = None, name: str = "row_id") -> DataFrame:
    """Give rows an identity: the natural key if there is one, else their position.

    Positions follow the input's partitions, so write the result once and read it back before use.
    """
    identity = F.col(key) if key else F.monotonically_increasing_id()
    return df.select(identity.alias(name), *[F.col(f"`{c}`") for c in df.columns if c not in (name, key)])


def with_label(df: DataFrame, value: int, label: str = spec.LABEL) -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(label) == value)


def blank_free(df: DataFrame, columns: Sequence[str], blanks: Sequence[str] = spec.CLEANING_BLANKS) -> DataFrame:
    """Rows with none of the text columns missing."""
    given = [~is_missing(F.col(f"`{name}`"), blanks) for name in columns]
    return df.where(reduce(lambda left, right: left & right, given))
