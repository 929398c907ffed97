"""Data profile.

Columns are profiled as rows: one scan turns each record into (column, value) pairs that are folded
map-side, so the plan stays small and fast to compile however many columns there are. Flag columns
are folded per spelling first and parsed afterwards, when each spelling is left once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.text import flag_state, is_missing, lookup, parse_double, parse_flag, strip, two_place_percent
from caseloom.operators.shape import melt, reindex, tally
from caseloom.sources.readers import present
from caseloom.sources.scratch import Scratch

_BLANKS = spec.PROFILE_BLANKS
_ONE_HOT_CHECKS = ("exactly one flag", "all flags zero", "several flags", "non-binary flag")


def _c(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def _pairs(df: DataFrame, columns: Sequence[str], value: str = "value") -> DataFrame:
    return melt(df, {name: _c(name) for name in columns}, {}, "column_name", value)


def _every(df: DataFrame, key: str, names: Sequence[str], count: str) -> DataFrame:
    """One row per name in order, counting 0 where the table had nothing."""
    return reindex(df, key, names).orderBy("ord").withColumn(count, F.coalesce(count, F.lit(0))).drop("ord")


def _column_facts(
    df: DataFrame, columns: Sequence[str], limits: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Per column: missing values, number bounds, values that are no numbers, numbers out of limits.

    Facts a caller does not select are pruned from the plan, parsing included.
    """
    name, value = F.col("column_name"), F.col("value")
    parsed = _pairs(df, columns).select(
        "column_name", is_missing(value, _BLANKS).alias("missing"), parse_double(value).alias("number")
    )
    number = F.col("number")
    facts = [
        F.count("*").alias("rows"),
        F.count_if("missing").alias("missing_rows"),
        F.min("number").alias("min_value"),
        F.max("number").alias("max_value"),
        F.count_if(number.isNull() & ~F.col("missing")).alias("non_numeric_rows"),
    ]
    if limits:
        parsed = parsed.withColumns({f"limit_{i}": lookup(name, {c: v[i] for c, v in limits.items()}) for i in (0, 1)})
        facts.append(F.count_if((number < F.col("limit_0")) | (number > F.col("limit_1"))).alias("outside_rows"))
    return parsed.groupBy("column_name").agg(*facts)


def _limits(checks: Mapping[str, tuple]) -> dict[str, tuple[float, float]]:
    return {
        column: (float(low), float("inf") if high is None else float(high)) for column, low, high in checks.values()
    }


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column."""
    names = present(df, columns) if columns else df.columns
    facts = _column_facts(df, names).select("column_name", "missing_rows")
    return _every(facts, "column_name", names, "missing_rows")


def numeric_profile(df: DataFrame, columns: Sequence[str] = spec.NUMERIC_COLUMNS) -> DataFrame:
    """Least and greatest number per column and the values that are not numbers; NULL if there are none."""
    names = present(df, columns)
    facts = _column_facts(df, names).select("column_name", "min_value", "max_value", "non_numeric_rows")
    return _every(facts, "column_name", names, "non_numeric_rows")


def _spellings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and spelling."""
    return _pairs(df, columns, "raw").groupBy("column_name", "raw").agg(F.count("*").alias("row_count"))


def _flag_values(spellings: DataFrame) -> DataFrame:
    shown = F.coalesce(parse_flag(F.col("raw")).cast("string"), strip(F.col("raw")))
    return (
        spellings.where(~is_missing(F.col("raw"), _BLANKS))
        .groupBy("column_name", shown.alias("value"))
        .agg(F.sum("row_count").alias("row_count"))
        .withColumn("valid", F.col("value").isin("0", "1"))
    )


def binary_profile(df: DataFrame, columns: Sequence[str] = spec.BINARY_COLUMNS) -> DataFrame:
    """Distinct non-missing values of 0/1 columns with their row counts.

    One output row per distinct value rather than a list per column, so a column full of stray
    values stays a distributed table.
    """
    return _flag_values(_spellings(df, present(df, columns)))


def invalid_flag_counts(df: DataFrame, columns: Sequence[str] = spec.BINARY_COLUMNS) -> DataFrame:
    """Non-missing values outside 0/1 per column."""
    names = present(df, columns)
    invalid = F.coalesce(flag_state(F.col("raw")) == "INVALID", F.lit(False))
    counts = _spellings(df, names).groupBy("column_name").agg(
        F.sum(F.when(invalid, F.col("row_count")).otherwise(0)).alias("invalid_rows")
    )
    return _every(counts, "column_name", names, "invalid_rows")


def label_distribution(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """Rows per label class, with MISSING and INVALID as classes, and their percent of all rows."""
    state = F.coalesce(flag_state(_c(label)), F.lit("MISSING"))
    counts = df.select(state.alias("label_class")).groupBy("label_class").agg(F.count("*").alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn("percent", two_place_percent(F.col("row_count"), total))


def _one_hot_state(flags: Sequence[str]) -> Column:
    # A missing or invalid flag makes the sum NULL.
    numbers = [parse_flag(_c(name)) for name in flags]
    codes = {0: _ONE_HOT_CHECKS[1], 1: _ONE_HOT_CHECKS[0]} | {n: _ONE_HOT_CHECKS[2] for n in range(2, len(flags) + 1)}
    return lookup(sum(numbers[1:], numbers[0]), codes, _ONE_HOT_CHECKS[3])


def one_hot_consistency(df: DataFrame, flags: Sequence[str] = spec.RACE_FLAGS) -> DataFrame:
    """Rows by state of a one-hot group; no rows if a flag column is absent."""
    complete = present(df, flags) == list(flags)
    state = _one_hot_state(flags) if complete else F.lit(_ONE_HOT_CHECKS[3])
    counts = df.select(state.alias("check_name")).groupBy("check_name").agg(F.count("*").alias("row_count"))
    return _every(counts, "check_name", _ONE_HOT_CHECKS, "row_count").where(F.lit(complete))


def out_of_range_counts(df: DataFrame, checks: Mapping[str, tuple] = spec.RANGE_CHECKS) -> DataFrame:
    """Rows failing each range check (one per column); values that are not numbers do not count."""
    limits = _limits(checks)
    facts = _column_facts(df, present(df, limits), limits)
    names = {column: check for check, (column, _, _) in checks.items()}
    counts = facts.select(lookup(F.col("column_name"), names).alias("check_name"), F.col("outside_rows").alias("row_count"))
    return _every(counts, "check_name", list(checks), "row_count")


def _entry(section: str, column: Column, metric: Column | str, value: Column) -> Column:
    metric = F.lit(metric) if isinstance(metric, str) else metric
    return F.struct(
        F.lit(section).alias("section"), column.alias("column_name"), metric.alias("metric"), value.alias("value")
    )


def profile_report(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """The whole profile as (section, column_name, metric, value) text rows.

    Two passes over the table: facts per column, and spellings per flag column with the one-hot state
    as one more flag. Everything else works on those folded rows.
    """
    name = F.col("column_name")
    numeric = present(df, spec.NUMERIC_COLUMNS)
    binary = present(df, spec.BINARY_COLUMNS)
    checks = {check: entry for check, entry in spec.RANGE_CHECKS.items() if entry[0] in df.columns}
    text = {fact: F.col(fact).cast("string") for fact in ("rows", "missing_rows", "min_value", "max_value")}
    text |= {fact: F.col(fact).cast("string") for fact in ("non_numeric_rows", "outside_rows")}

    first, table = name == df.columns[0], F.lit("table")
    facts = [
        F.when(first, _entry("size", table, "rows", text["rows"])),
        F.when(first, _entry("size", table, "columns", F.lit(str(len(df.columns))))),
        _entry("missing", name, "missing_rows", text["missing_rows"]),
        *[
            F.when(name.isin(*numeric), _entry("numeric", name, fact, text[fact]))
            for fact in ("min_value", "max_value", "non_numeric_rows")
        ],
        F.when(
            name.isin(*[column for column, _, _ in checks.values()]),
            _entry("range", name, lookup(name, {c: check for check, (c, _, _) in checks.items()}), text["outside_rows"]),
        ),
    ]
    by_column = _column_facts(df, df.columns, _limits(checks)).select(F.inline(F.array_compact(F.array(*facts))))

    one_hot = "one_hot" if present(df, spec.RACE_FLAGS) == spec.RACE_FLAGS else None
    dimensions = {column: _c(column) for column in binary}
    if one_hot:
        dimensions[one_hot] = _one_hot_state(spec.RACE_FLAGS)
    raw, n = F.col("raw"), F.col("row_count")
    state = F.coalesce(flag_state(raw), F.lit("MISSING"))
    is_flag = name != "one_hot"

    def counted(condition: Column) -> Column:
        return F.when(condition, n).otherwise(F.lit(0))

    shown = F.coalesce(parse_flag(raw).cast("string"), strip(raw))
    spellings = melt(df, dimensions, {}, "column_name", "raw").groupBy("column_name", "raw").agg(F.count("*").alias("row_count"))
    entries = [
        F.when(is_flag, _entry("binary", name, "invalid_rows", counted(state == "INVALID"))),
        F.when(is_flag & (state != "MISSING"), _entry("binary values", name, shown, n)),
        *[
            F.when(name == label, _entry("label", name, one, counted(state == one)))
            for one in ("0", "1", "INVALID", "MISSING")
        ],
        *[F.when(~is_flag, _entry("one_hot", name, one, counted(raw == one))) for one in _ONE_HOT_CHECKS],
    ]
    by_value = (
        spellings.select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("section", "column_name", "metric")
        .agg(F.sum("value").cast("string").alias("value"))
    )
    return by_column.unionByName(by_value)


def table_size(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def key_repeats(df: DataFrame, key: str, top: int | None = 20, buckets: int = 1 << 16) -> DataFrame:
    """Occurrences per stripped key, most frequent first; all keys without `top`.

    With `top` no pass brings all keys together. Rows are counted by a hash bucket of the key, which
    folds to `buckets` numbers a task; a bucket's count bounds that of each key in it. The keys of the
    heaviest buckets are counted exactly, and the `top`-th count among them is one that a key must reach.
    If no other bucket reaches it, the result is proven; else the buckets that do are counted too, up to
    all of them where counts are flat. Nothing is estimated.
    """
    shown = df.select(strip(_c(key)).alias("key"))

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.count("*").alias("row_count"))

    order = [F.desc("row_count"), "key"]
    if top is None:
        return counted(shown).orderBy(*order)
    placed = shown.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    with Scratch(df.sparkSession, "keys") as run:
        totals = run.keep(placed.groupBy("bucket").agg(F.count("*").alias("n")), "buckets")
        heavy = run.keep(totals.orderBy(F.desc("n"), "bucket").limit(4 * top), "heavy")

        def inside(chosen: DataFrame) -> DataFrame:
            return counted(placed.join(chosen, "bucket", "left_semi"))

        first = run.lasting(inside(heavy).orderBy(*order).limit(top), "first")
        least = first.agg(F.when(F.count("*") >= top, F.min("row_count")).otherwise(0).alias("least")).first()["least"]
        open_ = run.keep(totals.join(heavy, "bucket", "left_anti").where(F.col("n") >= least), "open")
        if open_.isEmpty():
            return first.orderBy(*order)
        second = run.lasting(inside(open_).orderBy(*order).limit(top), "second")
    return first.unionByName(second).orderBy(*order).limit(top)


def category_values(df: DataFrame, category: str, top: int | None = 100) -> DataFrame:
    """Distinct non-blank stripped values in text order."""
    values = df.select(strip(_c(category)).alias("category")).where(F.col("category") != "").distinct()
    ordered = values.orderBy("category")
    return ordered if top is None else ordered.limit(top)


def derived_field_checks(cleaned: DataFrame) -> DataFrame:
    """Unknown and Multiple counts in the derived columns of the analysis table."""
    checks = {
        "unknown race": ("race", "Unknown"),
        "multiple race": ("race", "Multiple"),
        "unknown age bucket": ("age_bucket", "Unknown"),
        "unknown bmi bucket": ("bmi_bucket", "Unknown"),
    }
    return tally(
        cleaned,
        "check_name",
        {name: {"row_count": F.count_if(F.col(column) == value)} for name, (column, value) in checks.items()},
    )
