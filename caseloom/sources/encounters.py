"""Encounter tables derived from the order tables: one row per order.

All joins are left joins on unique keys, so a join whose columns nobody asked for can be left out
without changing the rows. Line items are folded per order with min and max only, which map-side
combining handles whatever the key skew, and which do not depend on summation order. A customer with
very many orders makes the order side of that join skewed; it is the left side of a left join, the
side adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.text import lookup

# Fixed values of the derivation.
_GENDERS = {0: "Female", 1: "Male", 2: "Other"}
_SMOKING = {
    "AUTOMOBILE": "never",
    "BUILDING": "former",
    "FURNITURE": "current",
    "HOUSEHOLD": "not current",
    "MACHINERY": "No Info",
}
_RACES = {
    "1-URGENT": "AfricanAmerican",
    "2-HIGH": "Asian",
    "3-MEDIUM": "Caucasian",
    "4-NOT SPECIFIED": "Hispanic",
    "5-LOW": "Other",
}

# Only the columns read here; naming them saves a pass over the file footers.
_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_quantity DOUBLE, l_discount DOUBLE, l_tax DOUBLE",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
}

_LAB = {"bmi", "hbA1c_level", "blood_glucose_level", "risk", "diabetes", "score"}
_PERSON = {"smoking_history", "location"}

ENCOUNTER_COLUMNS = [
    "row_id",
    "year",
    "gender",
    "location",
    "smoking_history",
    "race",
    "age",
    "bmi",
    "hbA1c_level",
    "blood_glucose_level",
    "hypertension",
    "heart_disease",
    "noise",
    "risk",
    "diabetes",
    "score",
]


def key_draw(key: str = "row_id", factor: int = 104729, modulus: int = 1000) -> Column:
    """(key * factor) % modulus, multiplied on the remainders so that no key overflows."""
    return ((F.col(key) % modulus) * (factor % modulus)) % modulus


def encounters(spark: SparkSession, folder: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The typed encounter table, with only the joins that `columns` need."""
    wanted = list(columns) if columns is not None else ENCOUNTER_COLUMNS

    def table(name: str) -> DataFrame:
        return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    df = table("orders")
    if _LAB & set(wanted):
        middle = lambda c: ((F.min(c) + F.max(c)) / 2.0).alias(f"mid_{c}")
        lines = table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
        df = df.join(lines.agg(middle("l_quantity"), middle("l_tax"), middle("l_discount")), "o_orderkey", "left")
        df = df.withColumns(
            {
                "bmi": 12.0 + 0.8 * F.col("mid_l_quantity"),
                "hbA1c_level": 3.5 + F.col("mid_l_tax") * 60.0,
                "blood_glucose_level": 70.0 + F.col("mid_l_discount") * 2000.0,
            }
        )
    if _PERSON & set(wanted):
        people = table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
        if "location" in wanted:
            # Named on the side of the customers, so that the orders are joined once.
            nations = table("nation").select(
                F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("location")
            )
            people = people.join(nations, "c_nationkey", "left")
        df = df.join(people, "o_custkey", "left")
        df = df.withColumn("smoking_history", lookup(F.col("c_mktsegment"), _SMOKING))

    df = df.withColumns(
        {
            "row_id": F.col("o_orderkey"),
            "year": F.year("o_orderdate"),
            "gender": lookup((F.col("o_custkey") % 3).cast("int"), _GENDERS),
            "race": lookup(F.col("o_orderpriority"), _RACES),
            "age": F.col("o_totalprice") / 5000.0,
            "hypertension": (F.col("o_orderstatus") == "P").cast("int"),
            "heart_disease": (F.col("o_custkey") % 10 == 0).cast("int"),
            "noise": key_draw("o_orderkey", 7919) / 1000.0,
        }
    )
    if {"risk", "diabetes", "score"} & set(wanted):
        df = df.withColumn(
            "risk",
            (F.col("hbA1c_level") - 3.5) / 4.8
            + (F.col("blood_glucose_level") - 70.0) / 200.0
            + F.col("age") / 100.0 * 0.6
            + F.col("hypertension") * 0.15
            + F.col("heart_disease") * 0.1,
        ).withColumns(
            {
                "diabetes": F.when(F.col("risk") + F.col("noise") * 0.5 > 2.05, 1).otherwise(0),
                "score": F.col("risk") / 2.85,
            }
        )
    return df.select(*wanted)


def _hundredths(c: Column) -> Column:
    """Fixed-point text with two decimals."""
    return (F.floor(c * 100.0 + 0.5) / 100.0).cast("decimal(18,2)").cast("string")


def _every(step: int) -> Column:
    return F.col("row_id") % step == 0


def raw_encounters(spark: SparkSession, folder: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The same rows as strings, with dirt placed by key arithmetic: `row_id` and the 16 raw columns.

    With `columns`, only `row_id` and these, in this order, and only the joins that they need.
    """
    wanted = None if columns is None else ["row_id", *dict.fromkeys(c for c in columns if c != "row_id")]
    if wanted and not _PERSON & set(wanted):
        # The customers' columns are not asked for; NULL stands for them until the last line drops them.
        df = encounters(spark, folder, [c for c in ENCOUNTER_COLUMNS if c not in _PERSON])
        df = df.withColumns({name: F.lit(None).cast("string") for name in _PERSON})
    else:
        df = encounters(spark, folder)
    both = {"Asian", "Other"}

    def race_flag(label: str) -> Column:
        flag = F.when(_every(61), "0")
        if label in both:
            flag = flag.when(_every(67), "1")
        if label == "Caucasian":
            flag = flag.when(_every(71), "")
        return flag.otherwise((F.col("race") == label).cast("int").cast("string"))

    def binary(name: str) -> Column:
        return F.col(name).cast("string")

    raw = df.select(
        "row_id",
        F.col("year").cast("string").alias("year"),
        F.when(_every(47), "unknown").otherwise(F.col("gender")).alias("gender"),
        F.when(_every(41), "")
        .when(_every(79), "-5")
        .when(_every(83), "130")
        .otherwise(_hundredths(F.col("age")))
        .alias("age"),
        F.when(_every(73), F.concat(F.lit("\t"), "location", F.lit("  "))).otherwise(F.col("location")).alias("location"),
        *[race_flag(label).alias(name) for name, label in spec.RACE_LABELS.items()],
        F.when(_every(3), F.concat(binary("hypertension"), F.lit(".0"))).otherwise(binary("hypertension")).alias("hypertension"),
        F.when(_every(59), "2").otherwise(binary("heart_disease")).alias("heart_disease"),
        "smoking_history",
        F.when(_every(43), " N/A ").otherwise(_hundredths(F.col("bmi"))).alias("bmi"),
        F.when(_every(53), "abc").otherwise(_hundredths(F.col("hbA1c_level"))).alias("hbA1c_level"),
        _hundredths(F.col("blood_glucose_level")).alias("blood_glucose_level"),
        F.when(_every(59), "2").otherwise(binary("diabetes")).alias("diabetes"),
    )
    return raw if wanted is None else raw.select(*[F.col(f"`{name}`") for name in wanted])


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows as untidy text lines ending in a carriage return."""
    df = raw_encounters(spark, folder)
    fields = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in spec.RAW_COLUMNS]
    return df.select("row_id", F.concat(F.concat_ws(" , ", *fields), F.lit("\r")).alias("value"))
