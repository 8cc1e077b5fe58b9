"""Per-employee histories: first and last rows, spells, carried flags, transitions.

An employee may own a large share of all rows. Reductions are therefore
map-side aggregates, and row-to-row steps work on (employee, year) pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffflow.functions.ordered import previous_row
from staffflow.schema import EXIT_STATUSES


def period_index(year: str = "year", month: str = "month") -> Column:
    return F.col(year) * 12 + F.col(month)


def first_row_per_key(
    df: DataFrame, key: list[str], order: list[str], columns: list[str], keep: str = "first"
) -> DataFrame:
    """Chosen columns of the first (or last) row per key.

    Rows compare by order columns and then by the chosen columns, so equal
    periods cannot make the pick arbitrary.
    """
    row = F.struct(*order, *[c for c in columns if c not in order])
    pick = F.min(row) if keep == "first" else F.max(row)
    return df.groupBy(*key).agg(pick.alias("_row")).select(*key, "_row.*")


def best_row_per_employee(df: DataFrame, score: str, columns: list[str]) -> DataFrame:
    """Row with the highest score per employee plus the number of rows dropped."""
    best = F.max(F.struct(score, *columns))
    return (
        df.groupBy("employee_id")
        .agg(best.alias("_row"), (F.count(F.lit(1)) - 1).alias("n_dropped"))
        .select("employee_id", "_row.*", "n_dropped")
    )


def sticky_flags(df: DataFrame, flags: list[str], per_year: bool = True) -> DataFrame:
    """Yes/No flags that stay "Yes" from their first "Yes" on (within a year by default).

    The first "Yes" period per key is a map-side minimum; joining it back lets
    AQE split a hot employee, which a window over the employee could not.
    """
    key = ["employee_id", "year"] if per_year else ["employee_id"]
    index = period_index()
    firsts = df.groupBy(*key).agg(
        *[F.min(F.when(F.col(f) == "Yes", index)).alias(f"_first_{f}") for f in flags]
    )
    out = df.join(firsts, key, "left")
    held = {f: F.when(F.coalesce(index >= F.col(f"_first_{f}"), F.lit(False)), "Yes").otherwise(F.col(f)) for f in flags}
    return out.withColumns(held).select(*df.columns)


def prev_period_join(df: DataFrame, columns: list[str], reset_each_year: bool = True) -> DataFrame:
    """Attach the values of the same employee one month earlier (null where absent).

    Both sides are keyed by (employee, month number): a hot employee spreads over its months.
    """
    index = period_index()
    before = df.select(
        F.col("employee_id").alias("_e"),
        (index + 1).alias("_p"),
        F.col("year").alias("_y"),
        *[F.col(c).alias(f"prev_{c}") for c in columns],
    )
    cond = (F.col("employee_id") == F.col("_e")) & (index == F.col("_p"))
    if reset_each_year:
        cond = cond & (F.col("year") == F.col("_y"))
    return df.join(before, cond, "left").drop("_e", "_p", "_y")


def expand_spells(df: DataFrame) -> DataFrame:
    """Dense panel: one row per employee and month from hire to exit (or last row)."""
    spells = df.groupBy("employee_id").agg(
        F.min("hiring_date").alias("hired"),
        F.coalesce(F.max("exit_date"), F.max(F.make_date("year", "month", F.lit(1)))).alias("ended"),
    )
    months = F.expr("sequence(trunc(hired, 'MM'), trunc(ended, 'MM'), interval 1 month)")
    valid = F.trunc("hired", "MM") <= F.trunc("ended", "MM")
    dense = spells.filter(valid).select("employee_id", F.explode(months).alias("period"))
    return dense.select(
        "employee_id", "period", F.year("period").alias("year"), F.month("period").alias("month")
    )


def exits_to_vacancies(df: DataFrame) -> DataFrame:
    """Every exit opens its position in the following month (December rolls into January)."""
    opened = F.add_months(F.trunc("exit_date", "MM"), 1)
    exits = df.filter(F.col("status").isin(EXIT_STATUSES) & F.col("exit_date").isNotNull())
    return (
        exits.groupBy(opened.alias("opens"), "position")
        .agg(F.count(F.lit(1)).alias("vacancies"), F.max("exit_date").alias("last_exit"))
        .select(
            F.year("opens").alias("year"),
            F.month("opens").alias("month"),
            "position",
            "vacancies",
            F.least(F.col("vacancies"), F.lit(15).cast("bigint")).alias("planned_hires"),
            F.date_format("last_exit", "yyyy-MM").alias("last_active_month"),
        )
    )


def status_transitions(df: DataFrame) -> DataFrame:
    """Rows whose status differs from the employee's preceding row."""
    rows = previous_row(
        df.select("employee_id", "year", "month", "status"), "employee_id", "year", ["month"], ["status"]
    )
    return rows.filter(F.col("prev_status").isNotNull() & (F.col("status") != F.col("prev_status")))
