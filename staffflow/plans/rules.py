"""Queries of the rule scores: each score computed for every row, then summarised."""

from pyspark.sql import functions as F

from staffflow.operators import rules as ops
from staffflow.operators.clean import label_turnover
from staffflow.operators.distributions import rounded
from staffflow.plans.registry import query
from staffflow.sources.tables import STAFF_SQL, on_panel, panel, staff_inputs

RISK_COLUMNS = [
    "employee_id", "name", "year", "month", "status", "position", "age", "satisfaction", "overtime", "salary",
    "absence_days", "training_costs", "switching_readiness", "job_level",
]


def staff(spark, sf_dir, columns):
    return staff_inputs(panel(spark, sf_dir, list(dict.fromkeys(["employee_id", "year", "month", *columns]))))


def cases(column: str, values: dict, default: str = "1e0") -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in values.items()) + f" ELSE {default} END"


EXPECTED_SQL = f"""paid AS (SELECT *, 30000e0 * ({cases('position', ops.POSITION_FACTOR)})
  * (1 + greatest(age - 25, 0) // 5 * 0.05e0) * ({cases('education_level', ops.EDUCATION_FACTOR)})
  * ({cases('work_model', ops.WORK_MODEL_FACTOR)}) AS expected_salary FROM staff)"""
EXPECTED_COLUMNS = ["position", "age", "education_level", "work_model", "salary"]


@query(
    "age_tenure_retirement",
    on_panel("""SELECT employee_id, year, month, age_years, CAST(year - year(hiring_date) AS INTEGER) AS tenure_years,
      greatest(0, 67 - age_years) AS until_retirement FROM (
        SELECT *, CAST(year - year(birthdate) - CASE WHEN month < month(birthdate)
          OR (month = month(birthdate) AND day(birthdate) > 1) THEN 1 ELSE 0 END AS INTEGER) AS age_years FROM panel)"""),
)
def age_tenure_retirement(spark, sf_dir):
    src = panel(spark, sf_dir, ["employee_id", "year", "month", "birthdate", "hiring_date"])
    return ops.age_tenure_retirement(src).drop("birthdate", "hiring_date")


@query(
    "expected_salary_gap",
    on_panel("""SELECT position, year, count(*) AS n_rows, round(avg(expected_salary), 4) AS avg_expected_salary,
      round(avg(salary - expected_salary), 4) AS avg_gap FROM paid GROUP BY position, year""", STAFF_SQL, EXPECTED_SQL),
)
def expected_salary_gap(spark, sf_dir):
    src = ops.expected_salary(staff(spark, sf_dir, EXPECTED_COLUMNS))
    gap = src.withColumn("gap", F.col("salary") - F.col("expected_salary"))
    out = ops.summarise(gap, ["expected_salary", "gap"], ["position", "year"])
    return rounded(out, 4, ["avg_expected_salary", "avg_gap"])


@query(
    "inflation_adjusted_salary",
    on_panel("""SELECT year, count(*) AS n_rows, round(avg(salary), 4) AS avg_salary,
      round(avg(salary * pow(1.02e0, greatest(year - year(hiring_date), 0))), 4) AS avg_adjusted_salary
      FROM panel GROUP BY year"""),
)
def inflation_adjusted_salary(spark, sf_dir):
    src = ops.inflation_adjusted_salary(panel(spark, sf_dir, ["year", "salary", "hiring_date"]))
    return rounded(ops.summarise(src, ["salary", "adjusted_salary"], ["year"]), 4, ["avg_salary", "avg_adjusted_salary"])


@query(
    "satisfaction_score",
    on_panel("""SELECT position, year, count(*) AS n_rows, round(avg(s), 6) AS avg_satisfaction_score FROM (
      SELECT position, year, greatest(1e0, least(1e1, 7 + (workplace_flexibility - 5) * 0.5e0
        - 0.5e0 * pow(greatest(overtime - 5, 0), 1.2e0) + 0.2e0 * (salary / 1000)
        - CASE WHEN expected_salary > salary THEN 0.05e0 * (expected_salary - salary) / 1000 ELSE 0 END
        + (benefits - 5) * 0.5e0 - 0.2e0 * pow(absence_days, 1.1e0)
        + CASE WHEN age > 60 THEN -0.3e0 WHEN age < 30 THEN 0.2e0 ELSE 0 END)) AS s FROM paid)
      GROUP BY position, year""", STAFF_SQL, EXPECTED_SQL),
)
def satisfaction_score(spark, sf_dir):
    src = staff(spark, sf_dir, [*EXPECTED_COLUMNS, "overtime", "absence_days"])
    scored = ops.satisfaction_score(ops.expected_salary(src))
    out = ops.summarise(scored, ["satisfaction_score"], ["position", "year"])
    return rounded(out, 6, ["avg_satisfaction_score"])


@query(
    "illness_days_base",
    on_panel("""SELECT position, year, illness_days, count(*) AS n_rows FROM (
      SELECT position, year, CASE WHEN make_date(year, month, 1) - hiring_date <= 90 THEN least(d, 3) ELSE d END
        AS illness_days FROM (
        SELECT *, CAST(trunc(greatest(0, least(40, (5 + age // 8) / 12 + 0.5e0 * pow(10 - satisfaction, 2)
          + CASE WHEN work_model = 'Part-time' THEN -3 ELSE 0 END
          + CASE WHEN age > 55 THEN 4 WHEN age < 25 THEN -2 ELSE 0 END
          + CASE WHEN position IN ('Office Manager', 'Headquarters Manager', 'Department Head',
              'Assistant Department Head') THEN 5 ELSE 0 END))) AS INTEGER) AS d FROM staff))
      GROUP BY ALL""", STAFF_SQL),
)
def illness_days_base(spark, sf_dir):
    src = staff(spark, sf_dir, ["position", "age", "satisfaction", "work_model", "hiring_date"])
    return ops.illness_days_base(src).groupBy("position", "year", "illness_days").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "switching_readiness_score",
    on_panel("""SELECT position, year, count(*) AS n_rows, round(avg(r), 9) AS avg_readiness_score FROM (
      SELECT position, year, round_even(greatest(0e0, least(1e0, 0.3e0
        + CASE WHEN satisfaction <= 4 THEN (5 - satisfaction) * 0.08e0 ELSE 0 END
        + CASE WHEN overtime > 10 THEN (overtime - 10) * 0.005e0 ELSE 0 END
        + CASE WHEN salary < expected_salary * 0.8e0 THEN 0.15e0 WHEN salary >= expected_salary * 1.2e0 THEN -0.12e0 ELSE 0 END
        + CASE WHEN workplace_flexibility >= 7 THEN (workplace_flexibility - 6) * -0.06e0
               WHEN workplace_flexibility <= 3 THEN (4 - workplace_flexibility) * 0.03e0 ELSE 0 END
        + CASE WHEN absence_days > 10 THEN (absence_days - 10) * 0.005e0 ELSE 0 END
        + (coalesce(stress, 5) - 5) * 0.03e0 + (recognition - 5) * -0.05e0 + (work_environment - 5) * -0.04e0
        + (future_opportunities - 5) * -0.05e0 + (team_conflicts - 5) * 0.04e0 + (boredom - 5) * 0.02e0)) * 100, 0) / 100 AS r
      FROM paid) GROUP BY position, year""", STAFF_SQL, EXPECTED_SQL),
)
def switching_readiness_score(spark, sf_dir):
    src = staff(spark, sf_dir, [*EXPECTED_COLUMNS, "overtime", "absence_days", "satisfaction"])
    scored = ops.switching_readiness_score(ops.expected_salary(src))
    return rounded(ops.summarise(scored, ["readiness_score"], ["position", "year"]), 9, ["avg_readiness_score"])


RISK_SQL = """risks AS (SELECT *, risk_retirement + termination_risk AS exit_risk FROM (
  SELECT *, 0.1e0 + risk_satisfaction + risk_overtime + risk_pay + risk_illness + risk_training + risk_team
    + risk_subordinates + risk_progression + risk_readiness AS termination_risk FROM (
  SELECT *,
    CASE WHEN age BETWEEN 60 AND 65 THEN 0.3e0 + CASE WHEN satisfaction > 6 THEN -0.1e0 ELSE 0 END
      + CASE WHEN coalesce(TRY_CAST(job_level AS INTEGER), CASE job_level WHEN 'Entry Level' THEN 1
          WHEN 'Mid Level' THEN 2 WHEN 'Senior Level' THEN 3 ELSE 4 END) >= 2 THEN -0.05e0 ELSE 0 END
      + CASE WHEN performance >= 4 THEN -0.1e0 ELSE 0 END
      WHEN age > 65 THEN 0.5e0 ELSE 0e0 END AS risk_retirement,
    CASE WHEN satisfaction <= 2 THEN 0.45e0 WHEN satisfaction <= 5 THEN 0.2e0
      WHEN satisfaction >= 6 THEN (satisfaction - 5) * -0.08e0 ELSE 0e0 END AS risk_satisfaction,
    CASE WHEN overtime > 15 THEN (overtime - 15) * 0.01e0 + 0.25e0 WHEN overtime < 5 THEN -0.1e0 ELSE 0e0 END AS risk_overtime,
    CASE WHEN salary < (40000 + (age - 25) * 600) * 0.7e0 THEN 0.3e0
      WHEN salary >= (40000 + (age - 25) * 600) * 1.3e0 THEN -0.1e0 ELSE 0e0 END AS risk_pay,
    CASE WHEN absence_days > 20 THEN 0.15e0 WHEN absence_days < 5 THEN -0.05e0 ELSE 0e0 END AS risk_illness,
    CASE WHEN training_costs > 2000 THEN -0.05e0 ELSE 0e0 END AS risk_training,
    CASE WHEN team_size > 15 AND position IN ('Department Head', 'Assistant Department Head', 'Office Manager')
      THEN 0.1e0 ELSE 0e0 END AS risk_team,
    CASE WHEN number_of_subordinates > 5 THEN 0.05e0 ELSE 0e0 END AS risk_subordinates,
    CASE WHEN progress <= 3 THEN 0.2e0 WHEN progress >= 7 THEN -0.1e0 ELSE 0e0 END AS risk_progression,
    CASE WHEN switching_readiness > 0.7e0 THEN 0.2e0 WHEN switching_readiness >= 0.4e0 THEN 0.1e0 ELSE -0.1e0 END AS risk_readiness
  FROM (SELECT *, coalesce(TRY_CAST(job_role_progression AS INTEGER), CASE job_role_progression
    WHEN 'Leave and Rejoin' THEN 2 WHEN 'No Change' THEN 4 WHEN 'Lateral Move' THEN 5 WHEN 'Promotion' THEN 8 END) AS progress
    FROM staff))))"""
RISK_SCORED_SQL = [
    STAFF_SQL,
    RISK_SQL,
    """risk_scored AS (SELECT employee_id, name, year, month, status, position, age,
  CAST(status = 'Left' AS INTEGER) AS turnover,
  round(greatest(0e0, least(1e0, exit_risk)) * 100, 4) AS churn_probability FROM risks WHERE status <> 'Retired')""",
]


def risk_scored(spark, sf_dir):
    """The rule score as a model: its exit risk in percent for everyone not retired."""
    risks = ops.exit_risk_components(staff(spark, sf_dir, RISK_COLUMNS).filter(F.col("status") != "Retired"))
    percent = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("exit_risk"))) * 100, 4)
    return label_turnover(risks).select(
        "employee_id", "name", "year", "month", "status", "position", "age", "turnover",
        percent.alias("churn_probability"),
    )


AVERAGED = [*ops.RISK_COMPONENTS, "termination_risk", "exit_risk"]


@query(
    "exit_risk_components",
    on_panel("SELECT position, year, count(*) AS n_rows, " + ", ".join(f"round(avg({c}), 9) AS avg_{c}" for c in AVERAGED)
             + " FROM risks GROUP BY position, year", STAFF_SQL, RISK_SQL),
)
def exit_risk_components(spark, sf_dir):
    risks = ops.exit_risk_components(staff(spark, sf_dir, RISK_COLUMNS))
    out = ops.summarise(risks, AVERAGED, ["position", "year"])
    return rounded(out, 9, [f"avg_{c}" for c in AVERAGED])


@query(
    "exit_rule_flags",
    on_panel("""SELECT exit_rule, year, count(*) AS n_rows,
        round(avg(CASE WHEN exit_rule = 'may_retire' THEN greatest(0.05e0, (5 - satisfaction) * 0.05e0) END), 9)
          AS avg_retirement_chance FROM (
      SELECT *, CASE WHEN age >= 67 THEN 'retire' WHEN age BETWEEN 60 AND 69 THEN 'may_retire'
        WHEN switching_readiness > 0.7e0 AND satisfaction < 4 THEN 'leave'
        WHEN year(hiring_date) < year - 5 AND satisfaction < 5 THEN 'may_leave' ELSE 'stay' END AS exit_rule FROM panel)
      GROUP BY exit_rule, year"""),
)
def exit_rule_flags(spark, sf_dir):
    src = panel(spark, sf_dir, ["year", "age", "satisfaction", "switching_readiness", "hiring_date"])
    out = ops.summarise(ops.exit_rule_flags(src), ["retirement_chance"], ["exit_rule", "year"])
    return rounded(out, 9, ["avg_retirement_chance"])


@query(
    "absence_class",
    on_panel("""SELECT year, CASE WHEN absence_days > 20 THEN 'Illness with rehab' WHEN absence_days = 0 THEN 'none'
        ELSE absence_reason END AS absence_class, count(*) AS n_rows, sum(CAST(absence_days AS BIGINT))::BIGINT AS days
      FROM panel GROUP BY ALL"""),
)
def absence_class(spark, sf_dir):
    src = ops.absence_class(panel(spark, sf_dir, ["year", "absence_days", "absence_reason"]))
    return src.groupBy("year", "absence_class").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("absence_days").alias("days")
    )


BANDS_SQL = "bands(band_position, band_from, band_to) AS (VALUES " + ", ".join(
    f"('{p}', {low}, {high})" for p, bands in ops.AGE_BANDS.items() for low, high in bands
) + ")"


@query(
    "absence_by_age_band",
    on_panel("""SELECT position, band_from, band_to, count(*) AS n_rows, round(avg(absence_days), 6) AS avg_absence_days
      FROM staff LEFT JOIN bands ON age BETWEEN band_from AND band_to
        AND band_position = CASE WHEN position IN (SELECT band_position FROM bands) THEN position ELSE 'Standard' END
      GROUP BY position, band_from, band_to""", STAFF_SQL, BANDS_SQL),
)
def absence_by_age_band(spark, sf_dir):
    src = staff(spark, sf_dir, ["position", "age", "absence_days"])
    return rounded(ops.absence_by_age_band(src), 6, ["avg_absence_days"])
