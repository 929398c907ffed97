"""Rule-based screening: named predicates counted together in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.text import parse_flag
from caseloom.operators.shape import ordinal_of, tally


def older_adult(c: str = "age_bucket") -> Column:
    """In one of the two oldest age bands."""
    return F.col(c).isin(*spec.AGE_COHORT.labels[-2:])


def obese(c: str = "bmi_bucket") -> Column:
    """In the highest BMI band."""
    return F.col(c) == spec.BMI_COHORT.labels[-1]


def condition(c: str) -> Column:
    """A 0/1 text column that reads 1."""
    return parse_flag(F.col(c)) == 1


def default_rules() -> dict[str, Column]:
    """The standard screening rules, in definition order."""
    hypertension, heart = condition("hypertension"), condition("heart_disease")
    return {
        "Age 55+": older_adult(),
        "BMI Obese": obese(),
        "Hypertension": hypertension,
        "Heart Disease": heart,
        "Age 55+ AND Obese": older_adult() & obese(),
        "Hypertension AND Obese": hypertension & obese(),
    }


def screen_rules(
    df: DataFrame, rules: Mapping[str, Column] | None = None, label: str = spec.LABEL
) -> DataFrame:
    """Matches, positives and positive rate per rule, highest rounded rate first, then definition order.

    A rule without matches has rate 0. Any Column predicate can be a rule.
    """
    rules = default_rules() if rules is None else rules
    # Each rule is evaluated once per row; the counters read the results.
    flags = df.select(
        (parse_flag(F.col(label).cast("string")) == 1).alias("positive"),
        *[rule.alias(f"rule_{i}") for i, rule in enumerate(rules.values())],
    )
    counts = tally(
        flags,
        "rule_name",
        {
            name: {
                "matched_rows": F.count_if(F.col(f"rule_{i}")),
                "diabetes_count": F.count_if(F.col(f"rule_{i}") & F.col("positive")),
            }
            for i, name in enumerate(rules)
        },
    )
    rate = F.coalesce(F.try_divide(F.col("diabetes_count"), F.col("matched_rows")), F.lit(0.0))
    return counts.withColumn("prevalence_rate", F.round(rate, 4)).orderBy(
        F.desc("prevalence_rate"), ordinal_of(F.col("rule_name"), list(rules))
    )
