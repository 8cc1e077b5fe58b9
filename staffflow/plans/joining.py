"""Queries of the join, lookup and overlap family."""

from pyspark.sql import functions as F

from staffflow.operators import joining as ops
from staffflow.operators.filters import latest_period_snapshot
from staffflow.operators.ranking import top_per_model
from staffflow.operators.rules import POSITION_FACTOR, SALARY_GROUP
from staffflow.plans.registry import query
from staffflow.sources.tables import FULL_SHARE, STAFF_SQL, now_sql, on_panel, panel, staff_inputs

MODELS = ["price", "lines", "disc"]
SCORE_COLUMNS = ["employee_id", "name", "year", "month", "status", "salary", "overtime", "switching_readiness"]

SCORED_SQL = f"""wide_scores AS (
  SELECT employee_id, name, year, month, status, CAST(status = 'Left' AS INTEGER) AS turnover,
    floor(salary / 5000) / CAST(100 AS DOUBLE) AS price,
    least(overtime / 3, 10) / CAST(10 AS DOUBLE) AS lines,
    round(switching_readiness * 10) / CAST(10 AS DOUBLE) AS disc FROM panel WHERE status <> 'Retired'),
scored AS (
  SELECT * EXCLUDE (price, lines, disc), 'price' AS model, price * 100 AS churn_probability FROM wide_scores
  UNION ALL SELECT * EXCLUDE (price, lines, disc), 'lines', lines * 100 FROM wide_scores
  UNION ALL SELECT * EXCLUDE (price, lines, disc), 'disc', disc * 100 FROM wide_scores),
latest AS (SELECT * FROM scored WHERE turnover = 0
  AND year * 12 + month = {now_sql("scored")}),
tops AS (SELECT * FROM latest WHERE churn_probability > 0
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY churn_probability DESC, employee_id) <= 15)"""


def scored_panel(spark, sf_dir):
    """Panel rows under three scorers, one row per employee, month and model."""
    src = panel(spark, sf_dir, SCORE_COLUMNS).filter(F.col("status") != "Retired")
    wide = src.select(
        "employee_id", "name", "year", "month", "status",
        (F.col("status") == "Left").cast("int").alias("turnover"),
        (F.floor(F.col("salary") / 5000) / 100.0 * 100).alias("price"),
        (F.least(F.col("overtime") / 3, F.lit(10.0)) / 10.0 * 100).alias("lines"),
        (F.round(F.col("switching_readiness") * 10) / 10.0 * 100).alias("disc"),
    )
    ids = ["employee_id", "name", "year", "month", "status", "turnover"]
    return wide.unpivot(ids, MODELS, "model", "churn_probability")


def top_lists(spark, sf_dir):
    return top_per_model(latest_period_snapshot(scored_panel(spark, sf_dir), full_share=FULL_SHARE))


COMPARE_SQL = """SELECT coalesce(p.name, l.name, d.name) AS name,
  coalesce(p.employee_id, l.employee_id, d.employee_id) AS employee_id,
  p.churn_probability AS churn_price, l.churn_probability AS churn_lines, d.churn_probability AS churn_disc,
  CAST((p.model IS NOT NULL) AS INTEGER) + CAST((l.model IS NOT NULL) AS INTEGER)
    + CAST((d.model IS NOT NULL) AS INTEGER) AS frequency_in_models,
  CAST((p.model IS NOT NULL) AS INTEGER) + CAST((l.model IS NOT NULL) AS INTEGER)
    + CAST((d.model IS NOT NULL) AS INTEGER) > 1 AS match
  FROM (SELECT * FROM tops WHERE model = 'price') p
  FULL JOIN (SELECT * FROM tops WHERE model = 'lines') l ON p.name = l.name AND p.employee_id = l.employee_id
  FULL JOIN (SELECT * FROM tops WHERE model = 'disc') d
    ON coalesce(p.name, l.name) = d.name AND coalesce(p.employee_id, l.employee_id) = d.employee_id"""


@query("compare_models_outer", on_panel(COMPARE_SQL, SCORED_SQL))
def compare_models_outer(spark, sf_dir):
    return ops.compare_models(top_lists(spark, sf_dir), MODELS)


@query("sort_by_name_id", on_panel(f"{COMPARE_SQL} ORDER BY 1, 2", SCORED_SQL))
def sort_by_name_id(spark, sf_dir):
    return ops.sort_by_name_id(ops.compare_models(top_lists(spark, sf_dir), MODELS))


@query(
    "model_overlap_sets",
    on_panel("""SELECT employee_id, count(DISTINCT model) AS n_models, count(DISTINCT model) = 3 AS in_all FROM scored
      WHERE churn_probability > 60 GROUP BY employee_id HAVING count(DISTINCT model) >= 2""", SCORED_SQL),
)
def model_overlap_sets(spark, sf_dir):
    flagged = scored_panel(spark, sf_dir).filter(F.col("churn_probability") > 60)
    counts = ops.model_overlap(flagged).filter(F.col("n_models") >= 2)
    return counts.withColumn("in_all", F.col("n_models") == len(MODELS))


@query(
    "lookup_parameters",
    on_panel(
        "SELECT employee_id, year, month, position, CASE position "
        + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SALARY_GROUP.items())
        + " END AS salary_group, CAST(CASE position "
        + " ".join(f"WHEN '{k}' THEN {v}" for k, v in POSITION_FACTOR.items())
        + " ELSE 1.0 END AS DOUBLE) AS position_factor FROM staff",
        STAFF_SQL,
    ),
)
def lookup_parameters(spark, sf_dir):
    src = staff_inputs(panel(spark, sf_dir, ["employee_id", "year", "month", "position"])).select("employee_id", "year", "month", "position")
    groups = ops.parameter_table(spark, SALARY_GROUP, "position", "salary_group", "string")
    factors = ops.parameter_table(spark, POSITION_FACTOR, "position", "position_factor", "double")
    out = ops.lookup_parameters(src, groups, "position", "salary_group", None)
    return ops.lookup_parameters(out, factors, "position", "position_factor", 1.0)


@query(
    "attach_scores_by_key",
    on_panel("""SELECT p.employee_id, p.year, p.month, p.position, s.churn_probability FROM panel p
      LEFT JOIN (SELECT * FROM scored WHERE model = 'price') s
        ON p.employee_id = s.employee_id AND p.year = s.year AND p.month = s.month""", SCORED_SQL),
)
def attach_scores_by_key(spark, sf_dir):
    keys = ["employee_id", "year", "month"]
    scored = scored_panel(spark, sf_dir).filter(F.col("model") == "price").select(*keys, "churn_probability")
    return ops.attach_scores_by_key(panel(spark, sf_dir, [*keys, "position"]), scored, keys)
