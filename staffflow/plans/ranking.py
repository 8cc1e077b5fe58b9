"""Queries of the ranking family; the flagship among them."""

from pyspark.sql import functions as F

from staffflow.operators import ranking as ops
from staffflow.plans.joining import SCORED_SQL, scored_panel, top_lists
from staffflow.plans.registry import query
from staffflow.plans.rules import RISK_SCORED_SQL, risk_scored
from staffflow.sources.tables import FULL_SHARE, now_sql, on_panel


@query(
    "critical_employees",
    on_panel(
        f"""SELECT employee_id, churn_probability, year, month, name, position, age, status, turnover,
      CAST(0 AS BIGINT) AS n_dropped FROM risk_scored
      WHERE turnover = 0 AND churn_probability > 20
        AND year * 12 + month = {now_sql("risk_scored")}
      ORDER BY churn_probability DESC, employee_id LIMIT 15""",
        *RISK_SCORED_SQL,
    ),
)
def critical_employees(spark, sf_dir):
    return ops.top_n_at_risk(ops.critical_employees(risk_scored(spark, sf_dir), 20.0, full_share=FULL_SHARE))


@query(
    "critical_employees_all_models",
    on_panel("""SELECT employee_id, name, year, month, status, turnover, model, churn_probability,
      CAST(row_number() OVER (PARTITION BY model ORDER BY churn_probability DESC, employee_id) AS INTEGER) AS rank
      FROM tops""", SCORED_SQL),
)
def critical_employees_all_models(spark, sf_dir):
    return top_lists(spark, sf_dir)


@query(
    "top_n_at_risk",
    on_panel("""SELECT employee_id, name, year, month, status, turnover, churn_probability FROM scored
      WHERE model = 'price' ORDER BY churn_probability DESC, employee_id, year, month LIMIT 15""", SCORED_SQL),
)
def top_n_at_risk(spark, sf_dir):
    rows = scored_panel(spark, sf_dir).filter(F.col("model") == "price").drop("model")
    return ops.top_n_at_risk(rows, tie_break=["employee_id", "year", "month"])

