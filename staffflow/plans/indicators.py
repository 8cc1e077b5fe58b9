"""Queries of the indicator family."""

from pyspark.sql import functions as F

from staffflow.operators import indicators as ops
from staffflow.plans.registry import query
from staffflow.sources.tables import on_panel, panel

KPI_SQL = """SELECT year, avg(salary) AS avg_salary, avg(satisfaction) AS avg_satisfaction,
  avg(absence_days) FILTER (absence_reason = 'Illness') AS avg_absence_days FROM panel GROUP BY year"""
KPI_COLUMNS = ["year", "salary", "satisfaction", "absence_reason", "absence_days"]


@query(
    "kpis_by_year",
    on_panel(f"""SELECT year, round(avg_salary, 4) AS avg_salary, round(avg_satisfaction, 6) AS avg_satisfaction,
      round(avg_absence_days, 6) AS avg_absence_days FROM ({KPI_SQL})"""),
)
def kpis_by_year(spark, sf_dir):
    out = ops.kpis_by_year(panel(spark, sf_dir, KPI_COLUMNS))
    return out.select(
        "year",
        F.round("avg_salary", 4).alias("avg_salary"),
        F.round("avg_satisfaction", 6).alias("avg_satisfaction"),
        F.round("avg_absence_days", 6).alias("avg_absence_days"),
    )


@query(
    "kpi_labels",
    on_panel(f"""SELECT year, 'Salary (' || year || ')' AS salary_title,
      coalesce(printf('%.2f €', avg_salary), 'No data') AS salary_label,
      'Satisfaction (' || year || ')' AS satisfaction_title,
      coalesce(printf('%.2f / 10', avg_satisfaction), 'No data') AS satisfaction_label,
      'Sick Days (' || year || ')' AS absence_title,
      coalesce(printf('%.2f days', avg_absence_days), 'No data') AS absence_label FROM ({KPI_SQL})"""),
)
def kpi_labels(spark, sf_dir):
    return ops.kpi_labels(ops.kpis_by_year(panel(spark, sf_dir, KPI_COLUMNS)))


@query(
    "flows_by_year",
    on_panel("""SELECT coalesce(h.year, e.year) AS year, coalesce(new_hires, 0) AS new_hires,
      coalesce(exits, 0) AS exits, coalesce(retirements, 0) AS retirements FROM
      (SELECT CAST(year(hiring_date) AS INTEGER) AS year, count(DISTINCT employee_id) AS new_hires
       FROM panel GROUP BY 1) h FULL JOIN
      (SELECT CAST(year(exit_date) AS INTEGER) AS year,
         count(DISTINCT employee_id) FILTER (status = 'Left') AS exits,
         count(DISTINCT employee_id) FILTER (status = 'Retired') AS retirements
       FROM panel WHERE exit_date IS NOT NULL GROUP BY 1) e ON h.year = e.year"""),
)
def flows_by_year(spark, sf_dir):
    return ops.flows_by_year(panel(spark, sf_dir, ["employee_id", "hiring_date", "exit_date", "status"]))


@query(
    "active_by_month",
    on_panel("SELECT year, month, count(*) AS count FROM panel WHERE status = 'Active' GROUP BY year, month"),
)
def active_by_month(spark, sf_dir):
    return ops.active_by_month(panel(spark, sf_dir, ["year", "month", "status"]))


@query(
    "exits_by_month_status",
    on_panel("""SELECT year, month, status, count(*) AS count FROM panel
      WHERE status IN ('Left', 'Retired') GROUP BY ALL"""),
)
def exits_by_month_status(spark, sf_dir):
    return ops.exits_by_month_status(panel(spark, sf_dir, ["year", "month", "status"]))


@query(
    "active_by_year",
    on_panel("""SELECT year, count(DISTINCT employee_id) AS count FROM panel
      WHERE status = 'Active' GROUP BY year"""),
)
def active_by_year(spark, sf_dir):
    return ops.active_by_year(panel(spark, sf_dir, ["year", "employee_id", "status"]))


@query(
    "exits_by_year_status",
    on_panel("""SELECT year, status, count(*) AS count FROM panel
      WHERE status IN ('Left', 'Retired') GROUP BY ALL"""),
)
def exits_by_year_status(spark, sf_dir):
    return ops.exits_by_year_status(panel(spark, sf_dir, ["year", "status"]))


@query(
    "distinct_by_year_category",
    on_panel("""SELECT year, count(DISTINCT employee_id) FILTER (status = 'Left') AS left_count,
      count(DISTINCT employee_id) FILTER (status = 'Retired') AS retired_count,
      count(DISTINCT employee_id) FILTER (status NOT IN ('Left', 'Retired')) AS active_count
      FROM panel GROUP BY year"""),
)
def distinct_by_year_category(spark, sf_dir):
    return ops.distinct_by_year_category(panel(spark, sf_dir, ["year", "employee_id", "status"]))


@query(
    "hires_per_year",
    on_panel("""SELECT CAST(year(hiring_date) AS INTEGER) AS year, count(DISTINCT employee_id) AS hired
      FROM panel GROUP BY 1"""),
)
def hires_per_year(spark, sf_dir):
    return ops.hires_per_year(panel(spark, sf_dir, ["employee_id", "hiring_date"]))


FIRST_OF_YEAR = """firsts AS (SELECT * FROM panel
  QUALIFY row_number() OVER (PARTITION BY employee_id, year ORDER BY month) = 1)"""
MATRIX_SQL = """SELECT year, count(DISTINCT employee_id) FILTER (status = 'Active') AS "Active",
  count(DISTINCT employee_id) FILTER (status = 'Left') AS "Left",
  count(DISTINCT employee_id) FILTER (status = 'Retired') AS "Retired" FROM firsts GROUP BY year"""


@query("year_category_pivot", on_panel(MATRIX_SQL, FIRST_OF_YEAR))
def year_category_pivot(spark, sf_dir):
    return ops.year_category_pivot(panel(spark, sf_dir, ["year", "month", "employee_id", "status"]))


@query("yearly_status_matrix", on_panel(MATRIX_SQL, FIRST_OF_YEAR))
def yearly_status_matrix(spark, sf_dir):
    return ops.yearly_status_matrix(panel(spark, sf_dir, ["year", "month", "employee_id", "status"]))


@query(
    "category_by_first_year",
    on_panel("""SELECT year, 'gender' AS variable, gender AS category, count(*) AS count FROM first_rows GROUP BY ALL
      UNION ALL SELECT year, 'job_level', job_level, count(*) FROM first_rows GROUP BY ALL""",
             """first_rows AS (SELECT * FROM panel
      QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY year, month) = 1)"""),
)
def category_by_first_year(spark, sf_dir):
    src = panel(spark, sf_dir, ["employee_id", "year", "month", "gender", "job_level"])
    parts = [
        ops.category_by_first_year(src, c).select("year", F.lit(c).alias("variable"), F.col(c).alias("category"), "count")
        for c in ["gender", "job_level"]
    ]
    return parts[0].unionByName(parts[1])


@query("distinct_periods", on_panel("SELECT DISTINCT year FROM panel"))
def distinct_periods(spark, sf_dir):
    return ops.distinct_periods(panel(spark, sf_dir, ["year", "employee_id"]))


@query(
    "headcount_gap",
    on_panel("""SELECT year, month, headcount, 180 - headcount AS gap, abs(180 - headcount) > 33 AS flagged FROM (
      SELECT year, month, count(DISTINCT employee_id) AS headcount FROM panel
      WHERE status = 'Active' GROUP BY year, month)"""),
)
def headcount_gap(spark, sf_dir):
    return ops.headcount_gap(panel(spark, sf_dir, ["year", "month", "employee_id", "status"]), 180)
