"""Queries of the projection and cleaning family."""

from pyspark.sql import functions as F

from staffflow.operators import clean
from staffflow.plans.registry import query
from staffflow.schema import ILLNESS, STATUSES
from staffflow.sources.tables import PANEL_VIEW_COLUMNS, on_panel, panel

KEY = ["employee_id", "year", "month"]

# The panel as it arrives from careless exports: padded texts, tokens for null, broken dates.
DIRTY_SQL = """dirty AS (
  SELECT employee_id, month, year,
    CASE WHEN employee_id % 11 = 0 THEN ' N/A ' WHEN employee_id % 13 = 0 THEN 'null'
         ELSE '  ' || position || chr(9) END AS position,
    CASE WHEN employee_id % 17 = 0 THEN 'bad' ELSE CAST(hiring_date AS VARCHAR) END AS hiring_text,
    CAST(switching_readiness AS VARCHAR) AS readiness_text,
    CAST(absence_days AS VARCHAR) AS absence_text, CAST(overtime AS VARCHAR) AS overtime_text
  FROM panel)"""


def dirty(spark, sf_dir):
    emp = F.col("employee_id")
    return panel(
        spark, sf_dir, [*KEY, "position", "hiring_date", "switching_readiness", "absence_days", "overtime"]
    ).select(
        "employee_id", "month", "year",
        F.when(emp % 11 == 0, " N/A ").when(emp % 13 == 0, "null")
        .otherwise(F.concat(F.lit("  "), "position", F.lit("\t"))).alias("position"),
        F.when(emp % 17 == 0, "bad").otherwise(F.col("hiring_date").cast("string")).alias("hiring_text"),
        F.col("switching_readiness").cast("string").alias("readiness_text"),
        F.col("absence_days").cast("string").alias("absence_text"),
        F.col("overtime").cast("string").alias("overtime_text"),
    )


@query(
    "derive_year",
    on_panel(
        "SELECT employee_id, month, hiring_date, CAST(year(hiring_date) AS INTEGER) AS year FROM panel"
    ),
)
def derive_year(spark, sf_dir):
    return clean.derive_year(panel(spark, sf_dir, ["employee_id", "month", "hiring_date"]))


PROFILE = ["exit_date", "absence_reason", "hiring_date", "salary", "status"]
PROFILE_TYPES = ["date", "string", "date", "double", "string"]


@query(
    "null_profile",
    on_panel(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) - count({c}) AS n_null, count(*) AS n_rows FROM panel"
            for c, t in zip(PROFILE, PROFILE_TYPES)
        )
    ),
)
def null_profile(spark, sf_dir):
    return clean.null_profile(panel(spark, sf_dir, PROFILE))


@query(
    "fill_nulls",
    on_panel("""SELECT employee_id, year, month, coalesce(CAST(exit_date AS VARCHAR), 'No Exit') AS exit_date,
      coalesce(absence_reason, 'unknown') AS absence_reason FROM panel"""),
)
def fill_nulls(spark, sf_dir):
    src = panel(spark, sf_dir, [*KEY, "exit_date", "absence_reason"])
    shown = src.withColumn("exit_date", F.col("exit_date").cast("string"))
    return clean.fill_nulls(shown, {"exit_date": "No Exit", "absence_reason": "unknown"})


@query(
    "normalise_text",
    on_panel(
        r"""SELECT employee_id, year, month,
      CASE WHEN regexp_replace(position, '^\s+|\s+$', '', 'g') NOT IN ('', 'null', 'N/A')
           THEN regexp_replace(position, '^\s+|\s+$', '', 'g') END AS position FROM dirty""",
        DIRTY_SQL,
    ),
)
def normalise_text(spark, sf_dir):
    src = dirty(spark, sf_dir).select(*KEY, "position")
    return clean.normalise_text(src, ["position"], ["", "null", "N/A"])


@query(
    "typed_cast",
    on_panel(
        """SELECT employee_id, year, month, CAST(readiness_text AS DOUBLE) AS readiness_text,
      CAST(absence_text AS INTEGER) AS absence_text, CAST(overtime_text AS INTEGER) AS overtime_text FROM dirty""",
        DIRTY_SQL,
    ),
)
def typed_cast(spark, sf_dir):
    src = dirty(spark, sf_dir).select(*KEY, "readiness_text", "absence_text", "overtime_text")
    return clean.typed_cast(src, {"readiness_text": "double", "absence_text": "int", "overtime_text": "int"})


@query(
    "coerce_dates",
    on_panel(
        "SELECT employee_id, year, month, TRY_CAST(hiring_text AS DATE) AS hiring_text FROM dirty", DIRTY_SQL
    ),
)
def coerce_dates(spark, sf_dir):
    return clean.coerce_dates(dirty(spark, sf_dir).select(*KEY, "hiring_text"), ["hiring_text"])


@query(
    "drop_exact_duplicates",
    on_panel("""SELECT DISTINCT employee_id, year, month, position, salary, status FROM
      (SELECT * FROM panel UNION ALL SELECT * FROM panel WHERE status <> 'Active')"""),
)
def drop_exact_duplicates(spark, sf_dir):
    src = panel(spark, sf_dir, [*KEY, "position", "salary", "status"])
    return clean.drop_exact_duplicates(src.unionByName(src.filter(F.col("status") != "Active")))


VIEW_FEATURES = [
    "year", "month", "age", "overtime", "absence_days", "salary", "satisfaction", "switching_readiness",
    "training_costs", "position", "gender", "location", "work_model", "children", "job_level", "tenure",
]


@query(
    "select_features",
    on_panel(f"SELECT {', '.join(VIEW_FEATURES)}, CAST(status = 'Left' AS INTEGER) AS turnover FROM panel"),
)
def select_features(spark, sf_dir):
    src = clean.label_turnover(panel(spark, sf_dir, [*VIEW_FEATURES, "status"]))
    return clean.select_features(src, VIEW_FEATURES, "turnover")


@query(
    "rename_columns",
    on_panel('SELECT year AS "Year", count(DISTINCT employee_id) AS "Left_Count" FROM panel'
             " WHERE status = 'Left' GROUP BY year"),
)
def rename_columns(spark, sf_dir):
    left = panel(spark, sf_dir, ["year", "employee_id", "status"]).filter(F.col("status") == "Left")
    counts = left.groupBy("year").agg(F.countDistinct("employee_id").alias("employee_id"))
    return clean.rename_columns(counts, {"year": "Year", "employee_id": "Left_Count"})


TYPED = {"job_level": "categorical", "position": "categorical", "age": "numeric", "salary": "numeric",
         "absence_reason": "categorical", "overtime": "numeric"}


@query(
    "type_profile",
    on_panel(
        "SELECT \"column\", kind, numeric_share, numeric_share > 0 AND numeric_share < 1 AS mixed, n_distinct FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{k}' AS kind,
              round(count(TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)) / CAST(count({c}) AS DOUBLE), 6) AS numeric_share,
              count(DISTINCT {c}) AS n_distinct FROM panel"""
            for c, k in TYPED.items()
        )
        + ")"
    ),
)
def type_profile(spark, sf_dir):
    return clean.type_profile(panel(spark, sf_dir, list(TYPED)))


@query(
    "sick_absence_only",
    on_panel(f"""SELECT employee_id, year, month, absence_reason,
      CASE WHEN absence_reason = '{ILLNESS}' THEN absence_days ELSE 0 END AS absence_days FROM panel"""),
)
def sick_absence_only(spark, sf_dir):
    return clean.sick_absence_only(panel(spark, sf_dir, [*KEY, "absence_reason", "absence_days"]))


@query(
    "label_turnover",
    on_panel("SELECT employee_id, year, month, status, CAST(status = 'Left' AS INTEGER) AS turnover FROM panel"),
)
def label_turnover(spark, sf_dir):
    return clean.label_turnover(panel(spark, sf_dir, [*KEY, "status"]))


@query(
    "exit_category",
    on_panel("""SELECT employee_id, year, month, status,
      CASE WHEN status IN ('Left', 'Retired') THEN status ELSE 'Active' END AS exit_category FROM panel"""),
)
def exit_category(spark, sf_dir):
    return clean.exit_category(panel(spark, sf_dir, [*KEY, "status"]))


CONTRACT = {
    "status": {"required": True, "domain": STATUSES},
    "job_level": {"required": True, "type": "int"},
    "absence_reason": {"required": True, "domain": ["Illness", "Parental Leave", "Sabbatical", "none"]},
    "satisfaction": {"required": True, "range": (1, 9)},
    "salary": {"required": True, "range": (1000, 450000)},
    "coaching": {"required": True},
}


@query(
    "contract_violations",
    on_panel("""SELECT * FROM (
      SELECT 'status' AS "column", 'null' AS violation, count(*) FILTER (status IS NULL) AS n_rows FROM panel
      UNION ALL SELECT 'status', 'out_of_domain', count(*) FILTER (status NOT IN ('Active', 'Left', 'Retired')) FROM panel
      UNION ALL SELECT 'job_level', 'null', count(*) FILTER (job_level IS NULL) FROM panel
      UNION ALL SELECT 'job_level', 'uncastable', count(*) FILTER (job_level LIKE '%Level') FROM panel
      UNION ALL SELECT 'absence_reason', 'null', count(*) FILTER (absence_reason IS NULL) FROM panel
      UNION ALL SELECT 'absence_reason', 'out_of_domain', count(*) FILTER (absence_reason NOT IN
        ('Illness', 'Parental Leave', 'Sabbatical', 'none')) FROM panel
      UNION ALL SELECT 'satisfaction', 'null', count(*) FILTER (satisfaction IS NULL) FROM panel
      UNION ALL SELECT 'satisfaction', 'out_of_range', count(*) FILTER (satisfaction < 1 OR satisfaction > 9) FROM panel
      UNION ALL SELECT 'salary', 'null', count(*) FILTER (salary IS NULL) FROM panel
      UNION ALL SELECT 'salary', 'out_of_range', count(*) FILTER (salary < 1000 OR salary > 450000) FROM panel
      UNION ALL SELECT 'coaching', 'missing_column', count(*) FROM panel)"""),
)
def contract_violations(spark, sf_dir):
    used = [c for c in CONTRACT if c in PANEL_VIEW_COLUMNS]
    return clean.contract_violations(panel(spark, sf_dir, used), CONTRACT)
