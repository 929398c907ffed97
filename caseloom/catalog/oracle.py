"""Independent DuckDB SQL for the registered queries: plain grouped queries and unions per dimension."""

from __future__ import annotations

_ENCOUNTERS = """
li AS (
  SELECT l_orderkey,
         (min(l_quantity) + max(l_quantity)) / 2 AS q,
         (min(l_tax) + max(l_tax)) / 2 AS t,
         (min(l_discount) + max(l_discount)) / 2 AS d
  FROM lineitem GROUP BY l_orderkey
),
base AS (
  SELECT o_orderkey AS row_id,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE o_custkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'Other' END AS gender,
         n_name AS location,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'never' WHEN 'BUILDING' THEN 'former'
              WHEN 'FURNITURE' THEN 'current' WHEN 'HOUSEHOLD' THEN 'not current'
              WHEN 'MACHINERY' THEN 'No Info' END AS smoking_history,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'AfricanAmerican' WHEN '2-HIGH' THEN 'Asian'
              WHEN '3-MEDIUM' THEN 'Caucasian' WHEN '4-NOT SPECIFIED' THEN 'Hispanic'
              WHEN '5-LOW' THEN 'Other' END AS race,
         o_totalprice / 5000.0::DOUBLE AS age,
         12.0::DOUBLE + 0.8::DOUBLE * q AS bmi,
         3.5::DOUBLE + t * 60.0::DOUBLE AS "hbA1c_level",
         70.0::DOUBLE + d * 2000.0::DOUBLE AS blood_glucose_level,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS hypertension,
         CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE 0 END AS heart_disease,
         ((o_orderkey * 7919) % 1000) / 1000.0::DOUBLE AS noise
  FROM orders
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN li ON l_orderkey = o_orderkey
),
risky AS (
  SELECT *, ("hbA1c_level" - 3.5::DOUBLE) / 4.8::DOUBLE + (blood_glucose_level - 70.0::DOUBLE) / 200.0::DOUBLE
            + age / 100.0::DOUBLE * 0.6::DOUBLE + hypertension * 0.15::DOUBLE + heart_disease * 0.1::DOUBLE AS risk
  FROM base
),
encounters AS (
  SELECT *, CASE WHEN risk + noise * 0.5::DOUBLE > 2.05::DOUBLE THEN 1 ELSE 0 END AS diabetes,
         risk / 2.85::DOUBLE AS score
  FROM risky
)
"""


def _cents(c: str) -> str:
    units = f"CAST(floor({c} * 100.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)"
    return f"(CAST({units} // 100 AS VARCHAR) || '.' || lpad(CAST({units} % 100 AS VARCHAR), 2, '0'))"


def _race(label: str) -> str:
    extra = "WHEN row_id % 67 = 0 THEN '1'" if label in ("Asian", "Other") else ""
    blank = "WHEN row_id % 71 = 0 THEN ''" if label == "Caucasian" else ""
    return (
        f"CASE WHEN row_id % 61 = 0 THEN '0' {extra} {blank} "
        f"WHEN race = '{label}' THEN '1' WHEN race IS NOT NULL THEN '0' END AS \"race:{label}\""
    )


_RACES = ["AfricanAmerican", "Asian", "Caucasian", "Hispanic", "Other"]
_RAW_COLUMNS = [
    "year", "gender", "age", "location", *[f"race:{r}" for r in _RACES], "hypertension", "heart_disease",
    "smoking_history", "bmi", "hbA1c_level", "blood_glucose_level", "diabetes",
]

_RAW = f"""
raw AS (
  SELECT row_id,
         CAST(year AS VARCHAR) AS year,
         CASE WHEN row_id % 47 = 0 THEN 'unknown' ELSE gender END AS gender,
         CASE WHEN row_id % 41 = 0 THEN '' WHEN row_id % 79 = 0 THEN '-5' WHEN row_id % 83 = 0 THEN '130'
              ELSE {_cents("age")} END AS age,
         CASE WHEN row_id % 73 = 0 THEN chr(9) || location || '  ' ELSE location END AS location,
         {", ".join(_race(label) for label in _RACES)},
         CAST(hypertension AS VARCHAR) || CASE WHEN row_id % 3 = 0 THEN '.0' ELSE '' END AS hypertension,
         CASE WHEN row_id % 59 = 0 THEN '2' ELSE CAST(heart_disease AS VARCHAR) END AS heart_disease,
         smoking_history,
         CASE WHEN row_id % 43 = 0 THEN ' N/A ' ELSE {_cents("bmi")} END AS bmi,
         CASE WHEN row_id % 53 = 0 THEN 'abc' ELSE {_cents('"hbA1c_level"')} END AS "hbA1c_level",
         {_cents("blood_glucose_level")} AS blood_glucose_level,
         CASE WHEN row_id % 59 = 0 THEN '2' ELSE CAST(diabetes AS VARCHAR) END AS diabetes
  FROM encounters
)
"""

_TYPED = """
typed AS (
  SELECT row_id, TRY_CAST(year AS INTEGER) AS year,
         TRY_CAST(age AS DOUBLE) AS age, TRY_CAST(bmi AS DOUBLE) AS bmi,
         TRY_CAST("hbA1c_level" AS DOUBLE) AS "hbA1c_level",
         TRY_CAST(blood_glucose_level AS DOUBLE) AS blood_glucose_level,
         CAST(TRY_CAST(hypertension AS DOUBLE) AS BIGINT) AS hypertension,
         CAST(TRY_CAST(heart_disease AS DOUBLE) AS BIGINT) AS heart_disease,
         CAST(TRY_CAST(diabetes AS DOUBLE) AS BIGINT) AS diabetes
  FROM raw
),
loose AS (
  SELECT * FROM typed
  WHERE age > 0 AND age <= 120 AND bmi > 0 AND bmi <= 50
    AND "hbA1c_level" >= 3 AND "hbA1c_level" <= 15 AND blood_glucose_level >= 50 AND blood_glucose_level <= 400
),
strict AS (
  SELECT * FROM typed
  WHERE diabetes IN (0, 1) AND hypertension IN (0, 1) AND heart_disease IN (0, 1)
    AND bmi BETWEEN 10 AND 80 AND age BETWEEN 0 AND 120
    AND "hbA1c_level" BETWEEN 3.5 AND 15 AND blood_glucose_level BETWEEN 20 AND 600
)
"""

_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _strip(c: str) -> str:
    return f"trim({c}, {_WS})"


def _blank(c: str, profile: bool) -> str:
    tokens = "'', 'na', 'n/a', 'null', 'none', 'nan'" + (", 'unknown'" if profile else "")
    return f"({c} IS NULL OR lower({_strip(c)}) IN ({tokens}))"


def _flag(c: str) -> str:
    return f"CASE WHEN {_strip(c)} IN ('1', '1.0') THEN 1 WHEN {_strip(c)} IN ('0', '0.0') THEN 0 END"


_FLAG_COUNT = " + ".join(f"coalesce({_flag(f'\"race:{r}\"')}, 0)" for r in _RACES)
_RACE_NAME = " ".join(f"WHEN ({_flag(f'\"race:{r}\"')}) = 1 THEN '{r}'" for r in _RACES)


def _bands(c: str, edges: list[float], labels: list[str], missing: str = "NULL", low=None, top=None) -> str:
    parts = [f"WHEN {c} IS NULL THEN {missing}"]
    if low is not None:
        parts.append(f"WHEN {c} < {low} THEN NULL")
    if top is not None:
        parts.append(f"WHEN {c} >= {top} THEN NULL")
    for edge, label in reversed(list(zip(edges, labels[1:]))):
        parts.append(f"WHEN {c} >= {edge} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{labels[0]}' END"


_AGE_COHORT = ([25, 40, 55, 70], ["0-24", "25-39", "40-54", "55-69", "70+"])
_BMI_COHORT = ([18.5, 25, 30], ["Underweight", "Normal", "Overweight", "Obese"])
_HBA1C = ([5.7, 6.5], ["Normal (<5.7)", "Prediabetes (5.7-6.4)", "Diabetic (>=6.5)"])
_GLUCOSE = ([100, 126], ["Normal (<100)", "Prediabetes (100-125)", "High (>=126)"])
_BMI = ([18.5, 25, 30], ["Underweight (<18.5)", "Normal (18.5-24.9)", "Overweight (25-29.9)", "Obese (>=30)"])
_AGE = ([18, 35, 55], ["Children (<18)", "Young (18-34)", "Middle (35-54)", "Senior (>=55)"])
_AGE_STAGE = ([18, 35, 55], ["children", "youth", "adult", "senior"])
_BMI_STAGE = ([18.5, 25, 30], ["underweight", "healthy", "overweight", "obese"])

_CLEAN = f"""
clean AS (
  SELECT row_id,
         {_strip("year")} AS year,
         CASE WHEN {_blank("gender", False)} THEN 'Unknown' ELSE {_strip("gender")} END AS gender,
         CASE WHEN {_blank("location", False)} THEN 'Unknown' ELSE {_strip("location")} END AS location,
         CASE {_FLAG_COUNT} WHEN 0 THEN 'Unknown' WHEN 1 THEN CASE {_RACE_NAME} END ELSE 'Multiple' END AS race,
         {_strip("hypertension")} AS hypertension,
         {_strip("heart_disease")} AS heart_disease,
         CASE lower({_strip("smoking_history")}) WHEN 'never' THEN 'Never' WHEN 'former' THEN 'Former'
              WHEN 'ever' THEN 'Former' WHEN 'not current' THEN 'Former' WHEN 'current' THEN 'Current'
              ELSE 'Unknown' END AS smoking_history,
         {_strip("diabetes")} AS diabetes,
         {_bands("TRY_CAST(age AS DOUBLE)", *_AGE_COHORT, missing="'Unknown'")} AS age_bucket,
         {_bands("TRY_CAST(bmi AS DOUBLE)", *_BMI_COHORT, missing="'Unknown'")} AS bmi_bucket
  FROM raw
)
"""

_MODEL = """
scored AS (
  SELECT row_id, "hbA1c_level", blood_glucose_level, bmi, age, hypertension, heart_disease, diabetes, score,
         (row_id * 104729) % 1000 AS k
  FROM encounters
  WHERE diabetes IN (0, 1) AND hypertension IN (0, 1) AND heart_disease IN (0, 1)
    AND bmi BETWEEN 10 AND 80 AND age BETWEEN 0 AND 120
    AND "hbA1c_level" BETWEEN 3.5 AND 15 AND blood_glucose_level BETWEEN 20 AND 600
)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_E = _with(_ENCOUNTERS)
_R = _with(_ENCOUNTERS, _RAW)
_T = _with(_ENCOUNTERS, _RAW, _TYPED)
_C = _with(_ENCOUNTERS, _RAW, _CLEAN)
_M = _with(_ENCOUNTERS, _MODEL)

_FEATURES = ['"hbA1c_level"', "blood_glucose_level", "bmi", "age", "hypertension", "heart_disease"]
_MODEL_COLUMNS = "row_id, " + ", ".join(_FEATURES) + ", diabetes"
_COHORTS = [
    "age_bucket", "race", "gender", "bmi_bucket", "hypertension", "heart_disease", "smoking_history", "location",
]
_NUMERIC = ["year", "age", "bmi", "hbA1c_level", "blood_glucose_level"]
_BINARY = ["hypertension", "heart_disease", "diabetes", *[f"race:{r}" for r in _RACES]]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_PREVALENCE = _union(
    [
        f"""SELECT '{d}' AS cohort_dimension, {i} AS ord, {d} AS cohort_value, count(*) AS cohort_size,
                   count(*) FILTER (WHERE diabetes IN ('1', '1.0')) AS diabetes_count,
                   round(count(*) FILTER (WHERE diabetes IN ('1', '1.0')) / count(*)::DOUBLE, 4) AS prevalence_rate
            FROM clean GROUP BY {d}"""
        for i, d in enumerate(_COHORTS)
    ]
)

_TITLES = """CASE cohort_dimension WHEN 'age_bucket' THEN 'Age group: ' || cohort_value
  WHEN 'bmi_bucket' THEN 'BMI category: ' || cohort_value
  WHEN 'smoking_history' THEN 'Smoking status: ' || cohort_value
  WHEN 'hypertension' THEN 'Hypertension: ' || CASE WHEN cohort_value IN ('1', '1.0') THEN 'Yes' ELSE 'No' END
  WHEN 'heart_disease' THEN 'Heart disease: ' || CASE WHEN cohort_value IN ('1', '1.0') THEN 'Yes' ELSE 'No' END
  WHEN 'race' THEN 'Race: ' || cohort_value WHEN 'gender' THEN 'Gender: ' || cohort_value
  WHEN 'hba1c_bucket' THEN 'HbA1c: ' || cohort_value WHEN 'glucose_bucket' THEN 'Blood Glucose: ' || cohort_value
  ELSE cohort_dimension || ': ' || cohort_value END"""


def _numeric_text(c: str) -> str:
    return f"TRY_CAST(\"{c}\" AS DOUBLE)"


def _profile_missing() -> list[tuple[str, str]]:
    return [(c, f"count(*) FILTER (WHERE {_blank(f'\"{c}\"', True)})") for c in _RAW_COLUMNS]


def _profile_non_numeric() -> list[tuple[str, str]]:
    return [
        (c, f"count(*) FILTER (WHERE NOT {_blank(f'\"{c}\"', True)} AND {_numeric_text(c)} IS NULL)") for c in _NUMERIC
    ]


def _profile_invalid() -> list[tuple[str, str]]:
    return [
        (c, f"count(*) FILTER (WHERE NOT {_blank(f'\"{c}\"', True)} AND ({_flag(f'\"{c}\"')}) IS NULL)") for c in _BINARY
    ]


_LABEL_CLASS = f"CASE WHEN {_blank('diabetes', True)} THEN 'MISSING' ELSE coalesce(CAST({_flag('diabetes')} AS VARCHAR), 'INVALID') END"
_ALL_BINARY = " AND ".join(f"({_flag(f'\"race:{r}\"')}) IS NOT NULL" for r in _RACES)
_ONE_HOT = [
    ("exactly one flag", f"({_ALL_BINARY}) AND ({_FLAG_COUNT}) = 1"),
    ("all flags zero", f"({_ALL_BINARY}) AND ({_FLAG_COUNT}) = 0"),
    ("several flags", f"({_ALL_BINARY}) AND ({_FLAG_COUNT}) > 1"),
    ("non-binary flag", f"NOT ({_ALL_BINARY})"),
]
_RANGES = [
    ("age outside [0, 120]", "TRY_CAST(age AS DOUBLE) < 0 OR TRY_CAST(age AS DOUBLE) > 120"),
    ("negative bmi values", "TRY_CAST(bmi AS DOUBLE) < 0"),
    ("year outside [1900, 2100]", "TRY_CAST(year AS DOUBLE) < 1900 OR TRY_CAST(year AS DOUBLE) > 2100"),
    ("negative hbA1c_level values", 'TRY_CAST("hbA1c_level" AS DOUBLE) < 0'),
    ("negative blood_glucose_level values", "TRY_CAST(blood_glucose_level AS DOUBLE) < 0"),
]


def _binary_values() -> str:
    return _union(
        [
            f"""SELECT '{c}' AS column_name, v AS value, count(*) AS row_count, v IN ('0', '1') AS valid FROM (
                  SELECT coalesce(CAST({_flag(f'"{c}"')} AS VARCHAR), {_strip(f'"{c}"')}) AS v FROM raw
                  WHERE NOT {_blank(f'"{c}"', True)}) GROUP BY v"""
            for c in _BINARY
        ]
    )


def _report() -> str:
    def row(section: str, column: str, metric: str, aggregate: str) -> str:
        return (
            f"SELECT '{section}' AS section, '{column}' AS column_name, '{metric}' AS metric, "
            f"CAST({aggregate} AS VARCHAR) AS value FROM raw"
        )

    parts = [row("size", "table", "rows", "count(*)"), row("size", "table", "columns", f"max({len(_RAW_COLUMNS)})")]
    parts += [row("missing", c, "missing_rows", a) for c, a in _profile_missing()]
    parts += [row("numeric", c, "non_numeric_rows", a) for c, a in _profile_non_numeric()]
    parts += [row("numeric", c, f"{f}_value", f"{f}({_numeric_text(c)})") for c in _NUMERIC for f in ("min", "max")]
    parts += [row("binary", c, "invalid_rows", a) for c, a in _profile_invalid()]
    columns = ("age", "bmi", "year", "hbA1c_level", "blood_glucose_level")
    parts += [row("range", c, name, f"count(*) FILTER (WHERE {p})") for c, (name, p) in zip(columns, _RANGES)]
    parts += [row("one_hot", "one_hot", c, f"count(*) FILTER (WHERE {p})") for c, p in _ONE_HOT]
    parts += [
        row("label", "diabetes", v, f"count(*) FILTER (WHERE ({_LABEL_CLASS}) = '{v}')")
        for v in ("0", "1", "INVALID", "MISSING")
    ]
    parts.append(
        "SELECT 'binary values' AS section, column_name, value AS metric, CAST(row_count AS VARCHAR) AS value "
        f"FROM ({_binary_values()})"
    )
    return _union(parts)


# Row numbers by draw within the class, and the parts of the exact split.
_PARTS = """placed AS (
      SELECT *, count(*) OVER (PARTITION BY diabetes) AS class_rows, row_number() OVER (
        PARTITION BY diabetes ORDER BY ('0x' || substr(md5(row_id || ':' || diabetes || ':42'), 1, 15))::BIGINT) - 1 AS place
      FROM scored),
    parts AS (SELECT *, CASE WHEN place < floor(class_rows * 0.7::DOUBLE + 0.5) THEN 'train'
        WHEN place < floor(class_rows * 0.8::DOUBLE + 0.5) THEN 'calibration' ELSE 'test' END AS split FROM placed)"""


def _platt(steps: int = 14) -> str:
    """Newton's method on slope and shift, one pair of tables a step."""
    chain = ["t0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for k in range(steps):
        chain.append(
            f"""g{k} AS (SELECT sum((y - p) * x) AS ga, sum(y - p) AS gb, sum(p * (1 - p) * x * x) AS haa,
                  sum(p * (1 - p) * x) AS hab, sum(p * (1 - p)) AS hbb
                FROM (SELECT x, y, 1 / (1 + exp(-(a * x + b))) AS p FROM pairs, t{k}))"""
        )
        chain.append(
            f"""t{k + 1} AS (SELECT a + (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
                  b + (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM t{k}, g{k})"""
        )
    return f"""{_M}, {_PARTS}, pairs AS (SELECT score AS x, diabetes AS y FROM parts WHERE split = 'calibration'), {", ".join(chain)}
        SELECT row_id, diabetes, round(score, 6) AS score, round(1 / (1 + exp(-(a * score + b))), 6) AS prob_diabetic
        FROM parts, t{steps} WHERE split = 'test'"""


def _risk_dimension(name: str, bucket: str) -> str:
    return f"""SELECT '{name}' AS dimension, bucket, count(*) AS n, avg(score) AS avg_prob,
                      avg(diabetes) AS diabetic_rate
               FROM (SELECT {bucket} AS bucket, score, diabetes FROM scored) GROUP BY bucket"""


_RISK = _union(
    [
        _risk_dimension("hbA1c_level", _bands('"hbA1c_level"', *_HBA1C)),
        _risk_dimension("blood_glucose_level", _bands("blood_glucose_level", *_GLUCOSE)),
        _risk_dimension("bmi", _bands("bmi", *_BMI)),
        _risk_dimension("age", _bands("age", *_AGE)),
        _risk_dimension("hypertension", "CAST(hypertension AS VARCHAR)"),
        _risk_dimension("heart_disease", "CAST(heart_disease AS VARCHAR)"),
    ]
)

_HBA1C_STAGE = _bands('"hbA1c_level"', *_HBA1C, low=0)
_GLUCOSE_STAGE = _bands("blood_glucose_level", *_GLUCOSE, low=0)
_AGE_STAGE_SQL = _bands("age", *_AGE_STAGE, low=0, top=120)
_BMI_STAGE_SQL = _bands("bmi", *_BMI_STAGE, low=0, top=200)
_TIER = """CASE hypertension * 2 + heart_disease WHEN 3 THEN 'both_conditions' WHEN 2 THEN 'hypertension_only'
           WHEN 1 THEN 'heart_disease_only' ELSE 'no_comorbidity' END"""


def _values(rows: list[tuple], names: str) -> str:
    shown = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return f"(VALUES {shown}) AS fixed({names})"


def _ordered(labels: list[str]) -> str:
    return _values(list(enumerate(labels)), "ord, bucket")


def _share(name: str, bucket: str, labels: list[str]) -> str:
    return f"""SELECT '{name}' AS dimension, CAST(ord AS INTEGER) AS ord, bucket, n,
                      round(n * 100.0::DOUBLE / total, 6) AS percent
               FROM {_ordered(labels)} LEFT JOIN (
                 SELECT {bucket} AS bucket, count(*) AS n, sum(count(*)) OVER () AS total
                 FROM encounters WHERE {bucket} IS NOT NULL GROUP BY 1) USING (bucket)"""


def _rates(name: str, bucket: str) -> str:
    return f"""SELECT '{name}' AS dimension, {bucket} AS bucket, count(diabetes) AS total,
                      CAST(sum(diabetes) AS BIGINT) AS diabetic,
                      CAST(sum(diabetes) AS BIGINT) / count(diabetes)::DOUBLE * 100 AS rate,
                      (SELECT avg(diabetes) * 100 FROM encounters) AS overall_rate
               FROM encounters WHERE {bucket} IS NOT NULL GROUP BY 2"""


def _curve(source: str, name: str = "curve") -> str:
    return f"""
{name} AS (
  SELECT score, pos, neg,
         CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS cum_pos,
         CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS cum_neg,
         CAST(sum(pos) OVER () AS BIGINT) AS total_pos, CAST(sum(neg) OVER () AS BIGINT) AS total_neg
  FROM (SELECT score, count(*) FILTER (WHERE diabetes = 1) AS pos, count(*) FILTER (WHERE diabetes = 0) AS neg
        FROM {source} GROUP BY score)
)"""


def _points(name: str = "points", curve: str = "curve") -> str:
    return f"""
{name} AS (
  SELECT threshold, p AS precision, r AS recall, 5.0::DOUBLE * (p * r) / (4.0::DOUBLE * p + r + 1e-9::DOUBLE) AS f2
  FROM (SELECT score AS threshold, cum_pos / (cum_pos + cum_neg)::DOUBLE AS p, cum_pos / total_pos::DOUBLE AS r
        FROM {curve})
)"""


_BEST = "best AS (SELECT threshold, f2 FROM points ORDER BY f2 DESC, threshold LIMIT 1)"

# Pairs of ranks rather than running sums: mean rank of the positives (Mann-Whitney).
_AUC = """
  SELECT (sum(CASE WHEN diabetes = 1 THEN mid_rank END)
          - count(*) FILTER (WHERE diabetes = 1) * (count(*) FILTER (WHERE diabetes = 1) + 1.0::DOUBLE) / 2)
         / (count(*) FILTER (WHERE diabetes = 1)::DOUBLE * count(*) FILTER (WHERE diabetes = 0)) AS auc_roc
  FROM (SELECT diabetes, rank() OVER (ORDER BY score)
               + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS mid_rank FROM {source})
"""
_AP = "SELECT sum(pos * (cum_pos / (cum_pos + cum_neg)::DOUBLE)) / max(total_pos) AS auc_pr FROM {curve}"

_CELLS = """
  SELECT count(*) FILTER (WHERE score >= {t} AND diabetes = 1) AS tp,
         count(*) FILTER (WHERE score < {t} AND diabetes = 0) AS tn,
         count(*) FILTER (WHERE score >= {t} AND diabetes = 0) AS fp,
         count(*) FILTER (WHERE score < {t} AND diabetes = 1) AS fn
  FROM {source}
"""
_RATIOS = """
  SELECT *, 2.0::DOUBLE * precision * sensitivity / (precision + sensitivity + 1e-9::DOUBLE) AS f1 FROM (
    SELECT *, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS sensitivity,
           coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS specificity,
           coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision,
           coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0)::DOUBLE, 0) AS accuracy
    FROM ({cells}))
"""


def _round(digits: int, *names: str) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names)


def sql() -> dict[str, str]:
    """SQL by query name. Fitted models have none."""
    best = _with(_ENCOUNTERS, _MODEL, "cal AS (SELECT * FROM scored WHERE k >= 700 AND k < 800)",
                 "tst AS (SELECT * FROM scored WHERE k >= 800)", _curve("cal"), _points(), _BEST)
    cells = _RATIOS.format(cells=_CELLS.format(t="0.6::DOUBLE", source="scored"))
    return {
        "encounter_rows": f"{_E} SELECT * FROM encounters",
        "validity_filter_strict": f"{_T} SELECT {_MODEL_COLUMNS} FROM strict",
        "validity_filter_loose": f"{_T} SELECT {_MODEL_COLUMNS} FROM loose",
        "dropped_rows": f"""{_T} SELECT rule_set, rows_in, rows_kept, rows_in - rows_kept AS rows_dropped FROM (
            SELECT 'strict' AS rule_set, (SELECT count(*) FROM raw) AS rows_in, (SELECT count(*) FROM strict) AS rows_kept
            UNION ALL SELECT 'loose', (SELECT count(*) FROM raw), (SELECT count(*) FROM loose))""",
        "parsed_values": f"""{_R} SELECT row_id, gender = 'unknown' AS gender_missing_profile,
            FALSE AS gender_missing_cleaning, TRY_CAST("hbA1c_level" AS DOUBLE) AS hba1c,
            CASE WHEN TRY_CAST(age AS DOUBLE) = floor(TRY_CAST(age AS DOUBLE)) THEN CAST(TRY_CAST(age AS DOUBLE) AS BIGINT) END AS whole_age,
            {_flag("hypertension")} AS hypertension_flag, {_flag("heart_disease")} AS heart_flag,
            CASE WHEN "race:Caucasian" <> '' THEN "race:Caucasian" END AS flag_state,
            printf('%.4f', TRY_CAST(age AS DOUBLE)) AS age_text FROM raw""",
        "clean_table": f"{_C} SELECT * FROM clean",
        "normalize_lines": f"""{_R} SELECT row_id, concat_ws(chr(9), {", ".join(
            f"replace(coalesce({_strip(f'\"{c}\"')}, ''), 'No Info', 'no_info')" for c in _RAW_COLUMNS)}) AS value FROM raw""",
        "band_labels": f"""{_E} SELECT row_id, {_bands('"hbA1c_level"', *_HBA1C)} AS hba1c_range,
            {_bands("blood_glucose_level", *_GLUCOSE)} AS glucose_range, {_bands("bmi", *_BMI)} AS bmi_range,
            {_bands("age", *_AGE)} AS age_range, {_AGE_STAGE_SQL} AS age_stage, {_BMI_STAGE_SQL} AS bmi_stage,
            {_bands("age", *_AGE_COHORT, missing="'Unknown'")} AS age_cohort,
            {_bands("bmi", *_BMI_COHORT, missing="'Unknown'")} AS bmi_cohort,
            hypertension * heart_disease AS comorbidity, {_TIER} AS tier,
            CASE WHEN score >= 0.5 THEN 1 WHEN score < 0.5 THEN 0 END AS guess,
            CASE WHEN score >= 0.6 THEN 'High' WHEN score >= 0.5 THEN 'Medium' ELSE 'Low' END AS band
            FROM encounters""",
        "bmi_bucket_summary": f"""{_T} SELECT bucket, n AS count, round(r, 4) AS avg_ratio, round(d, 4) AS diabetes_rate,
            CASE WHEN d > 0.20 THEN 'HI' WHEN d >= 0.08 THEN 'MID' ELSE 'LO' END AS tier FROM (
              SELECT {_bands("bmi", *_BMI_COHORT)} AS bucket, count(*) AS n,
                     avg(blood_glucose_level / "hbA1c_level") AS r, count(*) FILTER (WHERE diabetes = 1) / count(*)::DOUBLE AS d
              FROM loose WHERE "hbA1c_level" <> 0 GROUP BY 1)""",
        "yearly_summary": f"""{_T} SELECT year, count(*) AS count,
            round(count(*) FILTER (WHERE diabetes = 1) / count(*)::DOUBLE, 4) AS diabetes_rate,
            round(avg(bmi), 4) AS avg_bmi, round(avg(blood_glucose_level), 4) AS avg_blood_glucose
            FROM loose WHERE year IS NOT NULL AND diabetes IS NOT NULL GROUP BY year""",
        "comorbidity_profile": f"""{_T} SELECT hypertension, heart_disease, count(*) AS count,
            round(count(*) FILTER (WHERE diabetes = 1) / count(*)::DOUBLE, 4) AS diabetes_rate,
            {", ".join(f'round({f}("{c}"), 4) AS {p}_{s}' for s, c in (("bmi", "bmi"), ("hba1c", "hbA1c_level"), ("glucose", "blood_glucose_level")) for p, f in (("mean", "avg"), ("min", "min"), ("max", "max")))},
            count(*) FILTER (WHERE "hbA1c_level" > 8 OR blood_glucose_level > 200) AS outlier_count
            FROM loose WHERE hypertension IS NOT NULL AND heart_disease IS NOT NULL AND diabetes IS NOT NULL
            GROUP BY hypertension, heart_disease""",
        "cohort_prevalence": f"{_C} SELECT cohort_dimension, cohort_value, cohort_size, diabetes_count, prevalence_rate FROM ({_PREVALENCE})",
        "value_frequencies": f"{_C} "
        + _union(
            [
                f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM clean GROUP BY {c}"
                for c in ("race", "age_bucket", "bmi_bucket", "gender", "smoking_history", "location")
            ]
        ),
        "risk_aggregation": f"{_M} SELECT dimension, bucket, n, {_round(6, 'avg_prob', 'diabetic_rate')} FROM ({_RISK})",
        "predicted_vs_actual": f"""{_M} SELECT CAST(ord AS INTEGER) AS ord, bucket, n, {_round(6, 'avg_prob', 'diabetic_rate')}
            FROM {_ordered(_AGE[1])} LEFT JOIN (SELECT * FROM ({_RISK}) WHERE dimension = 'age') USING (bucket)""",
        "predicted_vs_actual_bmi": f"""{_M} SELECT CAST(ord AS INTEGER) AS ord, bucket, n, {_round(6, 'avg_prob', 'diabetic_rate')}
            FROM {_ordered(_BMI[1])} LEFT JOIN (SELECT * FROM ({_RISK}) WHERE dimension = 'bmi') USING (bucket)""",
        "predicted_vs_actual_hba1c": f"""{_M} SELECT CAST(ord AS INTEGER) AS ord, bucket, n, {_round(6, 'avg_prob', 'diabetic_rate')}
            FROM {_ordered(_HBA1C[1])} LEFT JOIN (SELECT * FROM ({_RISK}) WHERE dimension = 'hbA1c_level') USING (bucket)""",
        "predicted_vs_actual_glucose": f"""{_M} SELECT CAST(ord AS INTEGER) AS ord, bucket, n, {_round(6, 'avg_prob', 'diabetic_rate')}
            FROM {_ordered(_GLUCOSE[1])} LEFT JOIN (SELECT * FROM ({_RISK}) WHERE dimension = 'blood_glucose_level') USING (bucket)""",
        "flag_risk_heart_disease": f"""{_M} SELECT dimension, CAST(bucket AS INTEGER) AS bucket, n,
            {_round(6, 'avg_prob', 'diabetic_rate')}, CASE bucket WHEN '0' THEN 'No Heart Disease' WHEN '1' THEN 'Heart Disease' END AS label
            FROM ({_RISK}) WHERE dimension = 'heart_disease'""",
        "label_crosstab_bmi": f"""{_E} SELECT CAST(ord AS INTEGER) AS ord, bucket, no_diabetes, diabetes
            FROM {_ordered(_BMI_STAGE[1])} LEFT JOIN (
              SELECT {_BMI_STAGE_SQL} AS bucket, count(*) FILTER (WHERE e.diabetes = 0) AS no_diabetes,
                     count(*) FILTER (WHERE e.diabetes = 1) AS diabetes FROM encounters e GROUP BY 1) USING (bucket)""",
        "usable_rows": f"""{_E} SELECT count(*) AS rows_in,
            count(*) FILTER (WHERE row_id % 7 <> 0 AND score IS NOT NULL AND row_id % 11 <> 0) AS rows_used,
            count(*) FILTER (WHERE row_id % 11 = 0) AS bad_label,
            count(*) FILTER (WHERE row_id % 11 <> 0 AND (row_id % 7 = 0 OR score IS NULL)) AS bad_score FROM encounters""",
        "platt_newton": _platt(),
        "flag_risk": f"""{_M} SELECT dimension, CAST(bucket AS INTEGER) AS bucket, n, {_round(6, 'avg_prob', 'diabetic_rate')},
            CASE bucket WHEN '0' THEN 'No HTN' WHEN '1' THEN 'With HTN' END AS label
            FROM ({_RISK}) WHERE dimension = 'hypertension'""",
        "rate_ratios": f"""{_M}, agg AS ({_RISK}) SELECT a.dimension, a.bucket, a.n, round(a.diabetic_rate, 6) AS diabetic_rate,
            round(a.diabetic_rate / nullif(b.diabetic_rate, 0), 6) AS rate_ratio FROM agg a
            LEFT JOIN agg b ON a.dimension = b.dimension AND (b.dimension, b.bucket) IN (
              ('age', 'Young (18-34)'), ('bmi', 'Normal (18.5-24.9)'), ('hypertension', '0'), ('heart_disease', '0'))""",
        "data_card": f"""{_E} SELECT count(*) AS records, 16 AS features, min(year) AS first_year, max(year) AS last_year,
            count(DISTINCT location) AS locations, CAST(sum(diabetes) AS BIGINT) AS positives,
            CAST(sum(1 - diabetes) AS BIGINT) AS negatives, round(avg(diabetes) * 100, 4) AS positive_percent,
            round(avg(1 - diabetes) * 100, 4) AS negative_percent,
            round(sum(1 - diabetes) / sum(diabetes)::DOUBLE, 4) AS imbalance_ratio FROM encounters""",
        "rows_per_year": f"{_E} SELECT year, count(*) AS row_count FROM encounters GROUP BY year",
        "bucket_share": f"{_E} {_share('hba1c', _HBA1C_STAGE, _HBA1C[1])} UNION ALL {_share('glucose', _GLUCOSE_STAGE, _GLUCOSE[1])}",
        "label_crosstab": f"""{_E} SELECT CAST(ord AS INTEGER) AS ord, bucket, no_diabetes, diabetes
            FROM {_ordered(_AGE_STAGE[1])} LEFT JOIN (
              SELECT {_AGE_STAGE_SQL} AS bucket, count(*) FILTER (WHERE e.diabetes = 0) AS no_diabetes,
                     count(*) FILTER (WHERE e.diabetes = 1) AS diabetes FROM encounters e GROUP BY 1) USING (bucket)""",
        "group_rates": f"""{_E} SELECT dimension, bucket, total, diabetic, {_round(6, 'rate', 'overall_rate')} FROM (
            {_rates('age', _AGE_STAGE_SQL)} UNION ALL {_rates('bmi', _BMI_STAGE_SQL)} UNION ALL {_rates('location', 'location')})""",
        "comorbidity_tiers": f"""{_E}, r AS ({_rates('tier', _TIER)}) SELECT CAST(ord AS INTEGER) AS ord, bucket, total, diabetic,
            {_round(6, 'rate', 'overall_rate')},
            round(rate / (SELECT rate FROM r WHERE bucket = 'no_comorbidity'), 6) AS ratio_to_first, title
            FROM {_values([(0, 'no_comorbidity', 'No Comorbidity'), (1, 'hypertension_only', 'Hypertension Only'),
                           (2, 'heart_disease_only', 'Heart Disease Only'), (3, 'both_conditions', 'Both Conditions')],
                          'ord, bucket, title')} LEFT JOIN r USING (bucket)""",
        "top_locations": f"""{_E} SELECT dimension, bucket, total, diabetic, {_round(6, 'rate', 'overall_rate')} FROM (
            SELECT * FROM ({_rates('location', 'location')}) ORDER BY rate DESC, bucket LIMIT 15)""",
        "top5_profiles": f"""{_E}, c AS (""" + _union(
            [
                f"""SELECT '{name}' AS cohort_dimension, {i} AS ord, CAST({column} AS VARCHAR) AS cohort_value,
                    count(*) AS size, CAST(sum(diabetes) AS BIGINT) AS diabetic FROM encounters
                    WHERE {column} IS NOT NULL GROUP BY 3"""
                for i, (name, column) in enumerate(
                    [
                        ("hba1c_bucket", _HBA1C_STAGE), ("glucose_bucket", _GLUCOSE_STAGE),
                        ("age_bucket", _AGE_STAGE_SQL), ("bmi_bucket", _BMI_STAGE_SQL),
                        ("hypertension", "hypertension"), ("heart_disease", "heart_disease"),
                        ("smoking_history", "smoking_history"), ("gender", "gender"),
                    ]
                )
            ]
        ) + f"""), o AS (SELECT *, diabetic / size::DOUBLE * 100 AS rate FROM c WHERE size >= 500)
            SELECT CAST(row_number() OVER (ORDER BY rate DESC, size DESC, ord, cohort_value) AS INTEGER) AS rank,
                   {_TITLES} AS label, size, diabetic, round(rate, 6) AS rate FROM o
            ORDER BY o.rate DESC, size DESC, ord, cohort_value LIMIT 5""",
        "table_size": f"{_R} SELECT count(*) AS row_count, 16 AS column_count FROM raw",
        "missing_counts": f"{_R} "
        + _union([f"SELECT '{c}' AS column_name, {a} AS missing_rows FROM raw" for c, a in _profile_missing()]),
        "numeric_profile": f"{_R} "
        + _union(
            [
                f"""SELECT '{c}' AS column_name, min({_numeric_text(c)}) AS min_value, max({_numeric_text(c)}) AS max_value,
                    {a} AS non_numeric_rows FROM raw"""
                for c, a in _profile_non_numeric()
            ]
        ),
        "binary_profile": f"{_R} {_binary_values()}",
        "invalid_flag_counts": f"{_R} "
        + _union([f"SELECT '{c}' AS column_name, {a} AS invalid_rows FROM raw" for c, a in _profile_invalid()]),
        "label_distribution": f"""{_R} SELECT {_LABEL_CLASS} AS label_class, count(*) AS row_count,
            round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM raw), 2) AS percent FROM raw GROUP BY 1""",
        "one_hot_consistency": f"{_R} "
        + _union([f"SELECT '{c}' AS check_name, count(*) FILTER (WHERE {p}) AS row_count FROM raw" for c, p in _ONE_HOT]),
        "out_of_range_counts": f"{_R} "
        + _union([f"SELECT '{c}' AS check_name, count(*) FILTER (WHERE {p}) AS row_count FROM raw" for c, p in _RANGES]),
        "profile_report": f"{_R} {_report()}",
        "derived_field_checks": f"""{_C} SELECT 'unknown race' AS check_name, count(*) AS row_count FROM clean WHERE race = 'Unknown'
            UNION ALL SELECT 'multiple race', count(*) FROM clean WHERE race = 'Multiple'
            UNION ALL SELECT 'unknown age bucket', count(*) FROM clean WHERE age_bucket = 'Unknown'
            UNION ALL SELECT 'unknown bmi bucket', count(*) FROM clean WHERE bmi_bucket = 'Unknown'""",
        "key_repeats": """SELECT trim(CAST(user_id AS VARCHAR)) AS key, count(*) AS row_count FROM events
            GROUP BY 1 ORDER BY row_count DESC, key LIMIT 20""",
        "category_sample": """SELECT DISTINCT trim(event_type) AS category FROM events WHERE trim(event_type) <> ''
            ORDER BY 1 LIMIT 100""",
        "ranked_profiles": f"""{_C}, p AS ({_PREVALENCE}), o AS (
              SELECT *, row_number() OVER (ORDER BY prevalence_rate DESC, cohort_size DESC, ord, cohort_value) AS rn
              FROM p WHERE cohort_dimension <> 'location' AND cohort_size >= 500)
            SELECT CAST(rn AS INTEGER) AS rank, {_TITLES} AS cohort_label, cohort_size, diabetes_count, prevalence_rate
            FROM o WHERE rn <= 20""",
        "ranked_locations": f"""{_C}, p AS ({_PREVALENCE})
            SELECT row_number() OVER (ORDER BY prevalence_rate DESC, cohort_value) AS rank, cohort_value AS location,
                   cohort_size, diabetes_count, prevalence_rate
            FROM p WHERE cohort_dimension = 'location' AND cohort_size >= 500""",
        "rule_screening": f"{_C} SELECT rule_name, matched_rows, diabetes_count, round(coalesce(diabetes_count / nullif(matched_rows, 0)::DOUBLE, 0), 4) AS prevalence_rate FROM ("
        + _union(
            [
                f"""SELECT '{name}' AS rule_name, count(*) AS matched_rows,
                    count(*) FILTER (WHERE diabetes IN ('1', '1.0')) AS diabetes_count FROM clean WHERE {p}"""
                for name, p in (
                    ("Age 55+", "age_bucket IN ('55-69', '70+')"),
                    ("BMI Obese", "bmi_bucket = 'Obese'"),
                    ("Hypertension", "hypertension IN ('1', '1.0')"),
                    ("Heart Disease", "heart_disease IN ('1', '1.0')"),
                    ("Age 55+ AND Obese", "age_bucket IN ('55-69', '70+') AND bmi_bucket = 'Obese'"),
                    ("Hypertension AND Obese", "hypertension IN ('1', '1.0') AND bmi_bucket = 'Obese'"),
                )
            ]
        )
        + ")",
        "stratified_split_counts": f"{_M}, {_PARTS} SELECT split, diabetes, count(*) AS row_count FROM parts GROUP BY 1, 2",
        "class_counts": f"{_M} SELECT diabetes, count(*) AS row_count FROM scored GROUP BY 1",
        "class_weights": f"""{_M} SELECT count(*) FILTER (WHERE diabetes = 1) AS positives,
            count(*) FILTER (WHERE diabetes = 0) AS negatives, count(*) AS rows,
            round(avg(1 - diabetes), 9) AS weight_positive, round(avg(diabetes), 9) AS weight_negative FROM scored""",
        "standardized_features": f"""{_M} SELECT row_id, {", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 4) + 0.0::DOUBLE AS {c}" for c in _FEATURES)} FROM scored""",
        "auc_roc": f"{_M} SELECT round(auc_roc, 8) AS auc_roc FROM ({_AUC.format(source='scored')})",
        "average_precision": f"{_M}, {_curve('scored')} SELECT round(auc_pr, 8) AS auc_pr FROM ({_AP.format(curve='curve')})",
        "tied_score_metrics": f"""{_M}, tied AS (SELECT diabetes, floor(score * 100.0::DOUBLE) / 100.0::DOUBLE AS score FROM scored),
            {_curve('tied')} SELECT round((SELECT auc_roc FROM ({_AUC.format(source='tied')})), 8) AS auc_roc,
            round((SELECT auc_pr FROM ({_AP.format(curve='curve')})), 8) AS auc_pr""",
        "brier_score": f"{_M} SELECT round(avg((score - diabetes) * (score - diabetes)), 8) AS brier FROM scored",
        "pr_curve": f"{_M}, {_curve('scored')}, {_points()} SELECT {_round(8, 'threshold', 'precision', 'recall', 'f2')} FROM points",
        "f2_threshold": f"{best} SELECT {_round(8, 'threshold', 'f2')} FROM best",
        "confusion_metrics": f"{_M} SELECT tp, tn, fp, fn, {_round(8, 'sensitivity', 'specificity', 'precision', 'accuracy', 'f1')} FROM ({cells})",
        "confusion_shares": f"""{_M}, c AS ({_CELLS.format(t='0.6::DOUBLE', source='scored')})
            SELECT cell, n, round(n * 100.0::DOUBLE / (SELECT count(*) FROM scored), 6) AS percent
            FROM (UNPIVOT c ON tp, tn, fp, fn INTO NAME cell VALUE n)""",
        "metrics_row": f"""{best}, {_curve('tst', 'test_curve')} SELECT tp, tn, fp, fn,
            {_round(8, 'sensitivity', 'specificity', 'precision', 'accuracy', 'f1')},
            round((SELECT auc_roc FROM ({_AUC.format(source='tst')})), 8) AS auc_roc,
            round((SELECT auc_pr FROM ({_AP.format(curve='test_curve')})), 8) AS auc_pr,
            round((SELECT avg((score - diabetes) * (score - diabetes)) FROM tst), 8) AS brier,
            round((SELECT threshold FROM best), 8) AS threshold
            FROM ({_RATIOS.format(cells=_CELLS.format(t='(SELECT threshold FROM best)', source='tst'))})""",
        "percentile_cutoffs": f"""{_M} SELECT round(quantile_cont(score, 0.5), 8) AS p50,
            round(quantile_cont(score, 0.8), 8) AS p80, round(quantile_cont(score, 0.9), 8) AS p90 FROM scored""",
        "risk_band_summary": f"""{_M}, cut AS (SELECT quantile_cont(score, 0.8) AS low, quantile_cont(score, 0.9) AS high
              FROM scored WHERE k >= 700 AND k < 800)
            SELECT risk_band, count(*) AS n, round(avg(score), 6) AS avg_prob, round(avg(diabetes), 6) AS diabetic_rate,
                   round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent
            FROM (SELECT CASE WHEN score >= (SELECT high FROM cut) THEN 'High'
                              WHEN score >= (SELECT low FROM cut) THEN 'Medium' ELSE 'Low' END AS risk_band, score, diabetes
                  FROM scored WHERE k >= 800) GROUP BY risk_band""",
        "calibration_check": f"""{_M} SELECT round(avg(score), 8) AS pre_avg, round(avg(score * score), 8) AS post_avg,
            round(avg(diabetes), 8) AS true_prev FROM scored""",
        "final_artifact": f"""{_M} SELECT s.row_id, s.diabetes, s.score AS lr_prob_calibrated,
            CASE WHEN s.score >= 0.6 THEN 'High' WHEN s.score >= 0.5 THEN 'Medium' ELSE 'Low' END AS risk_band,
            s.score * s.score AS rf_prob, e."hbA1c_level", e.blood_glucose_level, e.bmi, e.age, e.hypertension, e.heart_disease
            FROM scored s JOIN encounters e ON e.row_id = s.row_id""",
        "key_loss": f"""{_M}, n AS (SELECT (SELECT count(*) FROM scored) AS s, (SELECT count(*) FROM encounters) AS e)
            SELECT 'first' AS input, s AS rows_in, s AS rows_out, 0::BIGINT AS rows_lost FROM n
            UNION ALL SELECT 'second', s, s, 0 FROM n UNION ALL SELECT 'measures', e, s, e - s FROM n""",
    }
