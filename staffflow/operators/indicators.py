"""Yearly and monthly indicators.

Distinct head counts are two small aggregations - distinct (group, employee)
pairs first, then a count per group - so no group's id set sits in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffflow.operators.clean import exit_category
from staffflow.operators.histories import first_row_per_key
from staffflow.schema import EXIT_STATUSES, ILLNESS, STATUSES


def kpis_by_year(df: DataFrame) -> DataFrame:
    """Mean pay, satisfaction and illness days of every year in one pass."""
    sick = F.when(F.col("absence_reason") == ILLNESS, F.col("absence_days"))
    return df.groupBy("year").agg(
        F.avg("salary").alias("avg_salary"),
        F.avg("satisfaction").alias("avg_satisfaction"),
        F.avg(sick).alias("avg_absence_days"),
    )


def kpi_labels(kpis: DataFrame) -> DataFrame:
    """Display texts of the yearly indicators; missing values read "No data"."""

    def shown(col: str, unit: str) -> Column:
        text = F.format_string(f"%.2f {unit}", F.col(col))
        return F.when(F.col(col).isNull(), "No data").otherwise(text)

    def title(text: str) -> Column:
        return F.concat(F.lit(f"{text} ("), F.col("year").cast("string"), F.lit(")"))

    return kpis.select(
        "year",
        title("Salary").alias("salary_title"),
        shown("avg_salary", "€").alias("salary_label"),
        title("Satisfaction").alias("satisfaction_title"),
        shown("avg_satisfaction", "/ 10").alias("satisfaction_label"),
        title("Sick Days").alias("absence_title"),
        shown("avg_absence_days", "days").alias("absence_label"),
    )


def flows_by_year(df: DataFrame) -> DataFrame:
    """Distinct hires, leavers and retirees per event year from one scan.

    Every row yields its (year, flow) events; distinct triples are counted, so
    the three date keys share one shuffle.
    """
    status, exit_date = F.col("status"), F.col("exit_date")
    events = F.array(
        F.struct(F.year("hiring_date").alias("year"), F.lit("hired").alias("flow")),
        F.struct(
            F.when(status.isin(EXIT_STATUSES), F.year(exit_date)).alias("year"), F.lower(status).alias("flow")
        ),
    )
    people = (
        df.select("employee_id", F.explode(events).alias("e"))
        .select("employee_id", "e.year", "e.flow")
        .filter(F.col("year").isNotNull())
        .distinct()
    )
    return people.groupBy("year").agg(
        *[
            F.count(F.when(F.col("flow") == flow, 1)).alias(name)
            for flow, name in [("hired", "new_hires"), ("left", "exits"), ("retired", "retirements")]
        ]
    )


def active_by_month(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("status") == "Active").groupBy("year", "month").agg(F.count(F.lit(1)).alias("count"))
    )


def exits_by_month_status(df: DataFrame) -> DataFrame:
    exits = df.filter(F.col("status").isin(EXIT_STATUSES))
    return exits.groupBy("year", "month", "status").agg(F.count(F.lit(1)).alias("count"))


def distinct_staff(df: DataFrame, by: list[str], name: str = "count") -> DataFrame:
    """Distinct employees per group."""
    people = df.select(*by, "employee_id").distinct().filter(F.col("employee_id").isNotNull())
    return people.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def active_by_year(df: DataFrame) -> DataFrame:
    return distinct_staff(df.filter(F.col("status") == "Active"), ["year"])


def exits_by_year_status(df: DataFrame) -> DataFrame:
    exits = df.filter(F.col("status").isin(EXIT_STATUSES))
    return exits.groupBy("year", "status").agg(F.count(F.lit(1)).alias("count"))


def distinct_by_year_category(df: DataFrame) -> DataFrame:
    """Distinct staff per year for each exit category, side by side."""
    people = exit_category(df).select("year", "exit_category", "employee_id").distinct()
    return people.groupBy("year").agg(
        *[
            F.count(F.when(F.col("exit_category") == c, F.col("employee_id"))).alias(f"{c.lower()}_count")
            for c in ["Left", "Retired", "Active"]
        ]
    )


def hires_per_year(df: DataFrame) -> DataFrame:
    hires = df.filter(F.col("hiring_date").isNotNull()).select(F.year("hiring_date").alias("year"), "employee_id")
    return distinct_staff(hires, ["year"], "hired")


def year_category_pivot(df: DataFrame, keep: str = "first") -> DataFrame:
    """First row of each employee and year, counted per exit category."""
    chosen = first_row_per_key(exit_category(df), ["year", "employee_id"], ["month"], ["exit_category"], keep)
    return pivot_counts(chosen, "year", "exit_category", STATUSES)


def yearly_status_matrix(df: DataFrame, keep: str = "first") -> DataFrame:
    chosen = first_row_per_key(df, ["year", "employee_id"], ["month"], ["status"], keep)
    return pivot_counts(chosen, "year", "status", STATUSES)


def pivot_counts(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Long to wide with listed values: no extra job to find them, zeros for gaps."""
    return df.groupBy(row).pivot(column, values).count().na.fill(0, values)


def category_by_first_year(df: DataFrame, category: str) -> DataFrame:
    """Every employee once, in the year of the first row, counted per category."""
    chosen = first_row_per_key(df, ["employee_id"], ["year", "month"], [category])
    return chosen.groupBy("year", category).agg(F.count(F.lit(1)).alias("count"))


def distinct_periods(df: DataFrame) -> DataFrame:
    return df.select("year").filter(F.col("year").isNotNull()).distinct().orderBy("year")


def headcount_gap(df: DataFrame, target: int, tolerance: int = 33) -> DataFrame:
    """Active heads per month against a target."""
    heads = distinct_staff(df.filter(F.col("status") == "Active"), ["year", "month"], "headcount")
    gap = F.lit(target) - F.col("headcount")
    return heads.select("year", "month", "headcount", gap.alias("gap"), (F.abs(gap) > tolerance).alias("flagged"))
