"""Closed-form rule scores over the panel.

Each score is a set of column expressions (one span of generated code, no
shuffle); the summaries aggregate them map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Pay group and pay factor per position, factors per education and work model.
SALARY_GROUP = {
    "Office Clerk": "E5",
    "Specialist": "E6",
    "Office Manager": "E8",
    "Headquarters Manager": "E10",
    "Department Head": "E12",
    "Assistant Department Head": "E10",
}
POSITION_FACTOR = {
    "Office Clerk": 1.0,
    "Specialist": 1.2,
    "Office Manager": 1.5,
    "Assistant Department Head": 1.8,
    "Department Head": 2.0,
    "Headquarters Manager": 2.5,
}
EDUCATION_FACTOR = {
    "Vocational Training": 1.0,
    "Bachelor Degree": 1.1,
    "Master Degree": 1.2,
    "Doctoral Candidate": 1.3,
}
WORK_MODEL_FACTOR = {"Part-time": 0.7, "Homeoffice": 0.9}
LEADERSHIP = ["Office Manager", "Headquarters Manager", "Department Head", "Assistant Department Head"]
TEAM_LEADS = ["Department Head", "Assistant Department Head", "Office Manager"]
JOB_LEVEL_RANK = {"Entry Level": 1, "Mid Level": 2, "Senior Level": 3, "Executive Level": 4}
PROGRESSION_RANK = {"Leave and Rejoin": 2, "No Change": 4, "Lateral Move": 5, "Promotion": 8}  # on the scale of the digits, 0 to 10
RETIREMENT_AGE = 67
BASE_SALARY = 30000.0

# Age bands (from, to) per position.
AGE_BANDS = {
    "Office Clerk": [(20, 29), (30, 39), (40, 49), (50, 65)],
    "Specialist": [(25, 34), (35, 44), (45, 54), (55, 65)],
    "Office Manager": [(30, 39), (40, 49), (50, 59), (60, 65)],
    "Headquarters Manager": [(35, 44), (45, 54), (55, 60), (61, 65)],
    "Department Head": [(30, 39), (40, 49), (50, 59), (60, 65)],
    "Assistant Department Head": [(30, 39), (40, 49), (50, 59), (60, 65)],
    "Standard": [(25, 34), (35, 44), (45, 54), (55, 65)],
}

ZERO = 0.0


def _factor(key: str, values: dict[str, float], default: float = 1.0) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(key)), F.lit(default))


def _clip(col: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col))


def _dbl(name: str) -> Column:
    return F.col(name).cast("double")


def age_tenure_retirement(df: DataFrame) -> DataFrame:
    """Age on the first of the month, tenure in calendar years, years until retirement."""
    today = F.struct(F.col("month"), F.lit(1).alias("day"))
    birthday = F.struct(F.month("birthdate").alias("month"), F.dayofmonth("birthdate").alias("day"))
    age = F.col("year") - F.year("birthdate") - (today < birthday).cast("int")
    return df.withColumns(
        {
            "age_years": age,
            "tenure_years": F.col("year") - F.year("hiring_date"),
            "until_retirement": F.greatest(F.lit(0), RETIREMENT_AGE - age),
        }
    )


def expected_salary(df: DataFrame) -> DataFrame:
    """Expected pay from position, age steps of five years, education and work model."""
    steps = F.floor(F.greatest(F.col("age") - 25, F.lit(0)) / 5).cast("double")
    pay = (
        F.lit(BASE_SALARY)
        * _factor("position", POSITION_FACTOR)
        * (1 + steps * 0.05)
        * _factor("education_level", EDUCATION_FACTOR)
        * _factor("work_model", WORK_MODEL_FACTOR)
    )
    return df.withColumn("expected_salary", pay)


def inflation_adjusted_salary(df: DataFrame, rate: float = 0.02) -> DataFrame:
    years = F.greatest(F.col("year") - F.year("hiring_date"), F.lit(0)).cast("double")
    return df.withColumn("adjusted_salary", F.col("salary") * F.pow(F.lit(1 + rate), years))


def satisfaction_score(df: DataFrame) -> DataFrame:
    """Satisfaction from flexibility, overtime, pay, benefits, illness and age, within 1 to 10."""
    pay, expected = F.col("salary"), F.col("expected_salary")
    shortfall = F.when(expected > pay, (expected - pay) / 1000 * 0.05).otherwise(ZERO)
    score = (
        F.lit(7.0)
        + (_dbl("workplace_flexibility") - 5) * 0.5
        - F.pow(F.greatest(_dbl("overtime") - 5, F.lit(ZERO)), F.lit(1.2)) * 0.5
        + pay / 1000 * 0.2
        - shortfall
        + (_dbl("benefits") - 5) * 0.5
        - F.pow(_dbl("absence_days"), F.lit(1.1)) * 0.2
        + F.when(F.col("age") > 60, -0.3).when(F.col("age") < 30, 0.2).otherwise(0.0)
    )
    return df.withColumn("satisfaction_score", _clip(score, 1.0, 10.0))


def illness_days_base(df: DataFrame) -> DataFrame:
    """Expected illness days in a month; at most 3 in the first 90 days of work."""
    age = F.col("age")
    days = (
        (5 + F.floor(age / 8).cast("double")) / 12
        + F.pow(10 - _dbl("satisfaction"), F.lit(2.0)) * 0.5
        + F.when(F.col("work_model") == "Part-time", -3.0).otherwise(0.0)
        + F.when(age > 55, 4.0).when(age < 25, -2.0).otherwise(0.0)
        + F.when(F.col("position").isin(LEADERSHIP), 5.0).otherwise(0.0)
    )
    whole = _clip(days, 0.0, 40.0).cast("int")
    new = F.datediff(F.make_date("year", "month", F.lit(1)), "hiring_date") <= 90
    return df.withColumn("illness_days", F.when(new, F.least(whole, F.lit(3))).otherwise(whole))


def switching_readiness_score(df: DataFrame) -> DataFrame:
    """Readiness to switch, 0 to 1 in steps of 0.01; missing emotional factors count as 5."""
    sat, over, flex = _dbl("satisfaction"), _dbl("overtime"), _dbl("workplace_flexibility")
    pay, expected, ill = F.col("salary"), F.col("expected_salary"), _dbl("absence_days")

    def mood(name: str, weight: float) -> Column:
        return (F.coalesce(_dbl(name), F.lit(5.0)) - 5) * weight

    terms = [
        F.lit(0.3),
        F.when(sat <= 4, (5 - sat) * 0.08).otherwise(ZERO),
        F.when(over > 10, (over - 10) * 0.005).otherwise(ZERO),
        F.when(pay < expected * 0.8, 0.15).when(pay >= expected * 1.2, -0.12).otherwise(ZERO),
        F.when(flex >= 7, (flex - 6) * -0.06).when(flex <= 3, (4 - flex) * 0.03).otherwise(ZERO),
        F.when(ill > 10, (ill - 10) * 0.005).otherwise(ZERO),
        mood("stress", 0.03),
        mood("recognition", -0.05),
        mood("work_environment", -0.04),
        mood("future_opportunities", -0.05),
        mood("team_conflicts", 0.04),
        mood("boredom", 0.02),
    ]
    raw = _clip(reduce(lambda a, b: a + b, terms), 0.0, 1.0)
    return df.withColumn("readiness_score", F.rint(raw * 100) / 100)


def _mixed_rank(col: str, ranks: dict[str, int]) -> Column:
    words = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    text = F.col(col).cast("string")
    return F.coalesce(text.try_cast("int"), F.try_element_at(words, text))


def job_level_rank(col: str = "job_level") -> Column:
    """Mixed job level as a number: digits as they are, words by rank."""
    return _mixed_rank(col, JOB_LEVEL_RANK)


def progression_rank(col: str = "job_role_progression") -> Column:
    """Mixed job role progression as a number: digits as they are, words by rank."""
    return _mixed_rank(col, PROGRESSION_RANK)


RISK_COMPONENTS = [
    "risk_retirement", "risk_satisfaction", "risk_overtime", "risk_pay", "risk_illness", "risk_training",
    "risk_team", "risk_subordinates", "risk_progression", "risk_readiness",
]


def exit_risk_components(df: DataFrame) -> DataFrame:
    """Additive exit risk, one column per factor, plus the two sums.

    ``termination_risk`` starts from 0.1; ``exit_risk`` adds the retirement part.
    """
    age, sat, over = F.col("age"), _dbl("satisfaction"), _dbl("overtime")
    pay, ill, ready = F.col("salary"), F.col("absence_days"), F.col("switching_readiness")
    usual = F.lit(40000.0) + (age - 25) * 600
    progress = progression_rank()

    def less(condition: Column, amount: float) -> Column:
        return F.when(condition, -amount).otherwise(ZERO)

    late_career = (
        F.lit(0.3)
        + less(sat > 6, 0.1)
        + less(job_level_rank() >= 2, 0.05)
        + less(F.col("performance") >= 4, 0.1)
    )
    parts = {
        "risk_retirement": F.when(age.between(60, 65), late_career).when(age > 65, 0.5).otherwise(ZERO),
        "risk_satisfaction": F.when(sat <= 2, 0.45)
        .when(sat <= 5, 0.2)
        .when(sat >= 6, (sat - 5) * -0.08)
        .otherwise(ZERO),
        "risk_overtime": F.when(over > 15, (over - 15) * 0.01 + 0.25).when(over < 5, -0.1).otherwise(ZERO),
        "risk_pay": F.when(pay < usual * 0.7, 0.3).when(pay >= usual * 1.3, -0.1).otherwise(ZERO),
        "risk_illness": F.when(ill > 20, 0.15).when(ill < 5, -0.05).otherwise(ZERO),
        "risk_training": less(F.col("training_costs") > 2000, 0.05),
        "risk_team": F.when((F.col("team_size") > 15) & F.col("position").isin(TEAM_LEADS), 0.1).otherwise(ZERO),
        "risk_subordinates": F.when(F.col("number_of_subordinates") > 5, 0.05).otherwise(ZERO),
        "risk_progression": F.when(progress <= 3, 0.2).when(progress >= 7, -0.1).otherwise(ZERO),
        "risk_readiness": F.when(ready > 0.7, 0.2).when(ready >= 0.4, 0.1).otherwise(-0.1),
    }
    out = df.withColumns(parts)
    termination = reduce(lambda a, b: a + b, [F.col(c) for c in RISK_COMPONENTS[1:]], F.lit(0.1))
    return out.withColumn("termination_risk", termination).withColumn(
        "exit_risk", F.col("risk_retirement") + F.col("termination_risk")
    )


def exit_rule_flags(df: DataFrame) -> DataFrame:
    """Which exit rule applies first, and the yearly retirement chance where that rule is a chance."""
    age, sat = F.col("age"), F.col("satisfaction")
    flag = (
        F.when(age >= RETIREMENT_AGE, "retire")
        .when(age.between(60, 69), "may_retire")
        .when((F.col("switching_readiness") > 0.7) & (sat < 4), "leave")
        .when((F.year("hiring_date") < F.col("year") - 5) & (sat < 5), "may_leave")
        .otherwise("stay")
    )
    chance = F.greatest(F.lit(0.05), (5 - sat) * 0.05)
    return df.withColumn("exit_rule", flag).withColumn(
        "retirement_chance", F.when(F.col("exit_rule") == "may_retire", chance)
    )


def absence_class(df: DataFrame) -> DataFrame:
    days = F.col("absence_days")
    label = F.when(days > 20, "Illness with rehab").when(days == 0, "none").otherwise(F.col("absence_reason"))
    return df.withColumn("absence_class", label)


def age_band_table(spark: SparkSession) -> DataFrame:
    rows = [(p, low, high) for p, bands in AGE_BANDS.items() for low, high in bands]
    return spark.createDataFrame(rows, "band_position string, band_from int, band_to int")


def absence_by_age_band(df: DataFrame) -> DataFrame:
    """Rows and mean absence per position and age band; other positions use the standard bands."""
    bands = age_band_table(df.sparkSession)
    listed = [p for p in AGE_BANDS if p != "Standard"]
    own = F.when(F.col("position").isin(listed), F.col("position")).otherwise("Standard")
    cond = (own == F.col("band_position")) & F.col("age").between(F.col("band_from"), F.col("band_to"))
    # the band table is a fixed literal of a few dozen rows
    return (
        df.join(F.broadcast(bands), cond, "left")
        .groupBy("position", "band_from", "band_to")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg("absence_days").alias("avg_absence_days"))
    )


def summarise(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Rows per group and the mean of each score."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.avg(c).alias(f"avg_{c}") for c in columns]
    )
