"""Queries of the filter family."""

from staffflow.operators import filters
from staffflow.operators.clean import label_turnover
from staffflow.plans.registry import query
from staffflow.sources.tables import FULL_SHARE, now_sql, on_panel, on_scores, panel, scores

KEY = ["employee_id", "year", "month"]


@query(
    "filter_year_range",
    on_panel("SELECT employee_id, year, month, salary FROM panel WHERE year BETWEEN 1997 AND 2000"),
)
def filter_year_range(spark, sf_dir):
    return filters.filter_year_range(panel(spark, sf_dir, [*KEY, "salary"]), 1997, 2000)


@query(
    "drop_retired",
    on_panel("SELECT employee_id, year, month, status FROM panel WHERE status IS DISTINCT FROM 'Retired'"),
)
def drop_retired(spark, sf_dir):
    return filters.drop_retired(panel(spark, sf_dir, [*KEY, "status"]))


@query(
    "filter_status_in",
    on_panel("SELECT employee_id, year, month, status FROM panel WHERE status IN ('Left', 'Retired')"),
)
def filter_status_in(spark, sf_dir):
    return filters.filter_status_in(panel(spark, sf_dir, [*KEY, "status"]), ["Left", "Retired"])


@query(
    "latest_period_snapshot",
    on_panel(f"""SELECT employee_id, name, year, month, salary, CAST(0 AS INTEGER) AS turnover FROM panel
      WHERE year * 12 + month = {now_sql("panel")} AND status <> 'Left'"""),
)
def latest_period_snapshot(spark, sf_dir):
    src = label_turnover(panel(spark, sf_dir, [*KEY, "name", "salary", "status"])).drop("status")
    return filters.latest_period_snapshot(src, full_share=FULL_SHARE)


@query("score_above_threshold", on_scores("SELECT row_key, model, y, score FROM scores WHERE score > 0.5"))
def score_above_threshold(spark, sf_dir):
    return filters.score_above_threshold(scores(spark, sf_dir), "score", 0.5)


@query(
    "drop_incomplete_rows",
    on_panel("""SELECT employee_id, year, month, absence_reason, exit_date FROM panel
      WHERE absence_reason IS NOT NULL AND exit_date IS NOT NULL"""),
)
def drop_incomplete_rows(spark, sf_dir):
    src = panel(spark, sf_dir, [*KEY, "absence_reason", "exit_date"])
    return filters.drop_incomplete_rows(src, ["absence_reason", "exit_date"])


@query(
    "event_year_filter",
    on_panel("SELECT employee_id, year, month, exit_date FROM panel WHERE year(exit_date) = 2000"),
)
def event_year_filter(spark, sf_dir):
    return filters.event_year_filter(panel(spark, sf_dir, [*KEY, "exit_date"]), "exit_date", 2000)
