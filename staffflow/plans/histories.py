"""Queries of the per-employee history family."""

from staffflow.operators import histories as ops
from staffflow.plans.registry import query
from staffflow.sources.tables import on_panel, panel

KEY = ["employee_id", "year", "month"]


@query(
    "first_row_per_key",
    on_panel("""SELECT employee_id, year, month, status, salary FROM panel
      QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY year, month) = 1"""),
)
def first_row_per_key(spark, sf_dir):
    src = panel(spark, sf_dir, [*KEY, "status", "salary"])
    return ops.first_row_per_key(src, ["employee_id"], ["year", "month"], ["status", "salary"])


@query(
    "best_row_per_employee",
    on_panel("""SELECT employee_id, salary, year, month, n - 1 AS n_dropped FROM (
      SELECT *, count(*) OVER (PARTITION BY employee_id) AS n,
        row_number() OVER (PARTITION BY employee_id ORDER BY salary DESC, year DESC, month DESC) AS rn FROM panel)
      WHERE rn = 1"""),
)
def best_row_per_employee(spark, sf_dir):
    return ops.best_row_per_employee(panel(spark, sf_dir, [*KEY, "salary"]), "salary", ["year", "month"])


@query(
    "sticky_flags",
    on_panel("""SELECT employee_id, year, month, max(children) OVER (PARTITION BY employee_id, year ORDER BY month
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS children FROM panel"""),
)
def sticky_flags(spark, sf_dir):
    return ops.sticky_flags(panel(spark, sf_dir, [*KEY, "children"]), ["children"])


@query(
    "expand_spells_to_panel",
    on_panel("""SELECT employee_id, CAST(p AS DATE) AS period, CAST(year(p) AS INTEGER) AS year,
      CAST(month(p) AS INTEGER) AS month FROM (
        SELECT employee_id, unnest(generate_series(CAST(date_trunc('month', hired) AS TIMESTAMP),
          CAST(date_trunc('month', ended) AS TIMESTAMP), INTERVAL 1 MONTH)) AS p FROM (
            SELECT employee_id, min(hiring_date) AS hired,
              coalesce(max(exit_date), max(make_date(year, month, 1))) AS ended
            FROM panel GROUP BY employee_id))"""),
)
def expand_spells_to_panel(spark, sf_dir):
    return ops.expand_spells(panel(spark, sf_dir, [*KEY, "hiring_date", "exit_date"]))


@query(
    "exits_to_vacancies",
    on_panel("""SELECT CAST(year(opens) AS INTEGER) AS year, CAST(month(opens) AS INTEGER) AS month, position,
      count(*) AS vacancies, least(count(*), 15) AS planned_hires,
      strftime(max(exit_date), '%Y-%m') AS last_active_month
      FROM (SELECT *, date_trunc('month', exit_date) + INTERVAL 1 MONTH AS opens FROM panel
            WHERE exit_date IS NOT NULL) GROUP BY opens, position"""),
)
def exits_to_vacancies(spark, sf_dir):
    return ops.exits_to_vacancies(panel(spark, sf_dir, ["status", "exit_date", "position"]))


@query(
    "status_transitions",
    on_panel("""SELECT employee_id, year, month, status, prev_status FROM (
      SELECT *, lag(status) OVER (PARTITION BY employee_id ORDER BY year, month) AS prev_status FROM panel)
      WHERE status <> prev_status"""),
)
def status_transitions(spark, sf_dir):
    return ops.status_transitions(panel(spark, sf_dir, [*KEY, "status"]))


@query(
    "prev_period_join",
    on_panel("""SELECT p.employee_id, p.year, p.month, p.children, q.children AS prev_children
      FROM panel p LEFT JOIN panel q ON p.employee_id = q.employee_id AND p.year = q.year AND p.month = q.month + 1"""),
)
def prev_period_join(spark, sf_dir):
    return ops.prev_period_join(panel(spark, sf_dir, [*KEY, "children"]), ["children"])
