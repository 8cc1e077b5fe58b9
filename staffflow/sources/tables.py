"""The panel and score views derived from the star-schema tables.

``panel`` turns orders into an employee-by-month table: a customer is an
employee, all orders of a month make one row. Pay, line items and quantities are
summed; status, absence reason and the expressions of the order key come from
the month's last order, the one with the largest key. Joins are added only for
the columns asked for, so that a two-column query does not read line items.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# what the ranking queries take as "now": the last month with this share of the median month's rows
FULL_SHARE = 0.5

_FROM_LINES = {"overtime", "absence_days", "switching_readiness"}
_FROM_SPELL = {"hiring_date", "exit_date", "status", "tenure"}
_FROM_CUSTOMER = {"name", "position", "location"}

PANEL_VIEW_COLUMNS = [
    "employee_id", "name", "year", "month", "period_date", "hiring_date", "status", "exit_date",
    "position", "location", "salary", "satisfaction", "switching_readiness", "overtime",
    "absence_days", "absence_reason", "age", "tenure", "gender", "education_level", "work_model",
    "birthdate", "training_costs", "job_level", "children",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, orders: DataFrame | None = None
) -> DataFrame:
    wanted = list(columns) if columns is not None else PANEL_VIEW_COLUMNS
    needs = set(wanted)
    src = (
        (orders if orders is not None else table(spark, sf_dir, "orders"))
        .select(
            F.col("o_custkey").alias("employee_id"),
            F.col("o_orderdate").cast("date").alias("period_date"),
            "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        )
        .withColumn("year", F.year("period_date"))
        .withColumn("month", F.month("period_date"))
    )
    sums = [F.max("period_date").alias("period_date"), F.round(F.sum("o_totalprice"), 2).alias("o_totalprice")]
    detailed = src
    if needs & _FROM_LINES:
        detailed = src.join(order_lines(spark, sf_dir), "o_orderkey", "left")
        sums += [F.sum("n_lines").alias("n_lines"), F.sum("qty").alias("qty"), F.max("disc").alias("disc")]
    # one row per employee-month; sums and the max of a struct combine map-side, a hot employee spreads by month
    last = F.struct("o_orderkey", "o_orderstatus", "o_orderpriority")
    rows = detailed.groupBy("employee_id", "year", "month").agg(F.max(last).alias("last"), *sums)
    rows = rows.select("*", "last.*").drop("last")
    if needs & _FROM_SPELL:
        spell = src.groupBy("employee_id").agg(
            F.min("period_date").alias("hiring_date"),
            F.max(F.trunc("period_date", "MM")).alias("last_month"),
        )
        rows = rows.join(spell, "employee_id")
    if needs & _FROM_CUSTOMER:
        staff = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("employee_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("position"),
            "c_nationkey",
        )
        if "location" in needs:
            nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
            region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("location"))
            staff = staff.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
                region, F.col("n_regionkey") == F.col("r_regionkey")
            )
        rows = rows.join(staff, "employee_id")
    expr = _panel_expressions()
    return rows.select(*[expr[c].alias(c) for c in wanted])


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").alias("qty"),
            F.max("l_discount").alias("disc"),
        )
    )


def _panel_expressions() -> dict[str, Column]:
    emp, key = F.col("employee_id"), F.col("o_orderkey")
    last = F.col("last_month") == F.trunc("period_date", "MM")
    status = (
        F.when(last & (F.col("o_orderstatus") == "F"), "Left")
        .when(last & (F.col("o_orderstatus") == "P"), "Retired")
        .otherwise("Active")
    )

    def choose(index: Column, values: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))

    return {
        "employee_id": emp,
        "name": F.col("name"),
        "year": F.col("year"),
        "month": F.col("month"),
        "period_date": F.col("period_date"),
        "hiring_date": F.col("hiring_date"),
        "status": status,
        "exit_date": F.when(status != "Active", F.col("period_date")),
        "position": F.col("position"),
        "location": F.col("location"),
        "salary": F.col("o_totalprice"),
        "satisfaction": (1 + key % 10).cast("int"),
        "switching_readiness": F.round(F.coalesce("disc", F.lit(0.0)) * 10, 2),
        "overtime": (3 * F.coalesce("n_lines", F.lit(0))).cast("int"),
        "absence_days": F.coalesce(F.col("qty").cast("int"), F.lit(0)) % 25,
        "absence_reason": F.when(F.col("o_orderpriority") == "1-URGENT", "Illness")
        .when(F.col("o_orderpriority") == "2-HIGH", "Parental Leave")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Sabbatical")
        .when(F.col("o_orderpriority") == "5-LOW", "none"),
        "age": (25 + emp % 40).cast("int"),
        "tenure": F.col("year") - F.year("hiring_date"),
        "gender": choose(emp % 2, ["Male", "Female"]),
        "education_level": choose(
            emp % 4, ["Vocational Training", "Bachelor Degree", "Master Degree", "Doctoral Candidate"]
        ),
        "work_model": choose(emp % 3, ["Full-time", "Part-time", "Homeoffice"]),
        "birthdate": F.date_add(F.lit("1960-01-01").cast("date"), (emp % 14000).cast("int")),
        "training_costs": F.when(key % 2 == 0, key % 5000).otherwise(0).cast("int"),
        "job_level": F.when(emp % 5 == 0, choose(emp % 3, ["Entry Level", "Mid Level", "Senior Level"])).otherwise(
            (1 + emp % 4).cast("string")
        ),
        "children": F.when((key + emp) % 7 == 0, "Yes").otherwise("No"),
    }


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long score table: one row per order and scorer (price, lines, disc)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    wide = orders.join(order_lines(spark, sf_dir), "o_orderkey", "left").select(
        F.col("o_orderkey").alias("row_key"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.floor(F.col("o_totalprice") / 5000) / 100.0).alias("price"),
        (F.least(F.coalesce("n_lines", F.lit(0)), F.lit(10)) / 10.0).alias("lines"),
        (F.round(F.coalesce("disc", F.lit(0.0)) * 100) / 10.0).alias("disc"),
    )
    long = wide.unpivot(["row_key", "y"], ["price", "lines", "disc"], "model", "score")
    return long.select("row_key", "model", "y", "score")


# The same views as common table expressions for the SQL engine of the checks.
PANEL_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty, max(l_discount) AS disc
  FROM lineitem GROUP BY l_orderkey),
ord AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         CAST(o_orderdate AS DATE) AS d,
         CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mo
  FROM orders),
picked AS (
  SELECT o_custkey, yr, mo, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus,
    arg_max(o_orderpriority, o_orderkey) AS o_orderpriority, round(sum(o_totalprice), 2) AS o_totalprice, max(d) AS d,
    sum(n_lines) AS n_lines, sum(qty) AS qty, max(disc) AS disc
  FROM ord LEFT JOIN lines ON o_orderkey = l_orderkey GROUP BY o_custkey, yr, mo),
spell AS (
  SELECT o_custkey AS ck, min(d) AS hired, max(yr * 12 + mo) AS last_mo FROM ord GROUP BY o_custkey),
base AS (
  SELECT p.*, s.hired, c.c_name, c.c_mktsegment, r.r_name,
         CASE WHEN s.last_mo = p.yr * 12 + p.mo AND o_orderstatus = 'F' THEN 'Left'
              WHEN s.last_mo = p.yr * 12 + p.mo AND o_orderstatus = 'P' THEN 'Retired'
              ELSE 'Active' END AS st
  FROM picked p JOIN spell s ON p.o_custkey = s.ck JOIN customer c ON p.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
panel AS (
  SELECT o_custkey AS employee_id, c_name AS name, yr AS year, mo AS month, d AS period_date,
    hired AS hiring_date, st AS status, CASE WHEN st <> 'Active' THEN d END AS exit_date,
    c_mktsegment AS position, r_name AS location, o_totalprice AS salary,
    CAST(1 + o_orderkey % 10 AS INTEGER) AS satisfaction,
    round(coalesce(disc, 0) * 10, 2) AS switching_readiness,
    CAST(3 * coalesce(n_lines, 0) AS INTEGER) AS overtime,
    CAST(coalesce(CAST(qty AS INTEGER), 0) % 25 AS INTEGER) AS absence_days,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Illness' WHEN '2-HIGH' THEN 'Parental Leave'
      WHEN '3-MEDIUM' THEN 'Sabbatical' WHEN '5-LOW' THEN 'none' END AS absence_reason,
    CAST(25 + o_custkey % 40 AS INTEGER) AS age,
    CAST(yr - year(hired) AS INTEGER) AS tenure,
    CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE o_custkey % 4 WHEN 0 THEN 'Vocational Training' WHEN 1 THEN 'Bachelor Degree'
      WHEN 2 THEN 'Master Degree' ELSE 'Doctoral Candidate' END AS education_level,
    CASE o_custkey % 3 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Part-time' ELSE 'Homeoffice' END AS work_model,
    CAST(DATE '1960-01-01' + CAST(o_custkey % 14000 AS INTEGER) AS DATE) AS birthdate,
    CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5000 ELSE 0 END AS INTEGER) AS training_costs,
    CASE WHEN o_custkey % 5 <> 0 THEN CAST(1 + o_custkey % 4 AS VARCHAR)
      WHEN o_custkey % 3 = 0 THEN 'Entry Level' WHEN o_custkey % 3 = 1 THEN 'Mid Level'
      ELSE 'Senior Level' END AS job_level,
    CASE WHEN (o_orderkey + o_custkey) % 7 = 0 THEN 'Yes' ELSE 'No' END AS children
  FROM base)"""

SCORES_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, max(l_discount) AS disc FROM lineitem GROUP BY l_orderkey),
wide AS (
  SELECT o_orderkey AS row_key, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
    floor(o_totalprice / 5000) / CAST(100 AS DOUBLE) AS price,
    least(coalesce(n_lines, 0), 10) / CAST(10 AS DOUBLE) AS lines,
    round(coalesce(disc, 0) * 100) / CAST(10 AS DOUBLE) AS disc
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey),
scores AS (
  SELECT row_key, 'price' AS model, y, price AS score FROM wide
  UNION ALL SELECT row_key, 'lines', y, lines FROM wide
  UNION ALL SELECT row_key, 'disc', y, disc FROM wide)"""


def now_sql(table: str) -> str:
    """SQL for year * 12 + month of the last month of ``table`` with FULL_SHARE of the median month's rows."""
    months = f"SELECT year * 12 + month AS p, count(*) AS n FROM {table} GROUP BY year * 12 + month"
    return f"(SELECT max(p) FROM ({months}) WHERE n >= {FULL_SHARE} * (SELECT median(n) FROM ({months})))"


def on_panel(sql: str, *more: str) -> str:
    """SQL text over the panel view; ``more`` holds further CTEs."""
    return "WITH " + ",\n".join([PANEL_SQL, *more]) + "\n" + sql


def on_scores(sql: str, *more: str) -> str:
    return "WITH " + ",\n".join([SCORES_SQL, *more]) + "\n" + sql


# Staff view: the panel with position titles and the inputs of the rule scores that the tables
# lack, all small expressions of the keys; one factor is null at times.
TITLES = {
    "AUTOMOBILE": "Office Clerk",
    "BUILDING": "Specialist",
    "FURNITURE": "Office Manager",
    "HOUSEHOLD": "Department Head",
}
_DERIVED = {
    "workplace_flexibility": "employee_id % 11",
    "benefits": "(employee_id + month) % 11",
    "team_size": "5 + employee_id % 21",
    "number_of_subordinates": "employee_id % 8",
    "performance": "1 + (employee_id + year) % 5",
    "stress": "CASE WHEN month % 4 <> 0 THEN 1 + (employee_id + month) % 10 END",
    "recognition": "1 + (employee_id * 3 + month) % 10",
    "work_environment": "1 + (employee_id * 7 + month) % 10",
    "future_opportunities": "1 + (employee_id * 9 + month) % 10",
    "team_conflicts": "1 + (employee_id * 11 + month) % 10",
    "boredom": "1 + (employee_id * 13 + month) % 10",
}

# job role progression is mixed, words and digits, as delivered
_DERIVED_TEXT = {
    "job_role_progression": "CASE employee_id % 15 WHEN 11 THEN 'Promotion' WHEN 12 THEN 'Lateral Move' "
    "WHEN 13 THEN 'No Change' WHEN 14 THEN 'Leave and Rejoin' ELSE CAST(employee_id % 11 AS STRING) END",
    "married": "CASE WHEN employee_id % 3 = 0 THEN 'Yes' ELSE 'No' END",
}


def staff_inputs(df: DataFrame) -> DataFrame:
    title = F.create_map(*[F.lit(x) for pair in TITLES.items() for x in pair])
    out = df.withColumn("position", F.coalesce(F.try_element_at(title, F.col("position")), F.lit("Unlisted")))
    numbers = {name: F.expr(text).cast("int") for name, text in _DERIVED.items()}
    return out.withColumns(numbers | {name: F.expr(text) for name, text in _DERIVED_TEXT.items()})


STAFF_SQL = (
    "staff AS (SELECT * REPLACE (CASE position "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TITLES.items())
    + " ELSE 'Unlisted' END AS position), "
    + ", ".join(f"CAST({text} AS INTEGER) AS {name}" for name, text in _DERIVED.items())
    + ", "
    + ", ".join(f"{text} AS {name}" for name, text in _DERIVED_TEXT.items())
    + " FROM panel)"
)
