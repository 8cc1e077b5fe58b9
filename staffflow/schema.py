"""Declared schema of the employee-month panel and its fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values: (header in the delivered files, our column name, Spark type).
PANEL_COLUMNS = [
    ("Year", "year", T.IntegerType()),
    ("Month", "month", T.IntegerType()),
    ("Employee_ID", "employee_id", T.LongType()),
    ("Name", "name", T.StringType()),
    ("Gender", "gender", T.StringType()),
    ("Hiring Date", "hiring_date", T.DateType()),
    ("Exit Date", "exit_date", T.DateType()),
    ("Position", "position", T.StringType()),
    ("Education Level", "education_level", T.StringType()),
    ("Age", "age", T.IntegerType()),
    ("Birthdate", "birthdate", T.DateType()),
    ("Salary Group", "salary_group", T.StringType()),
    ("Basic Education", "basic_education", T.StringType()),
    ("Internal Training", "internal_training", T.IntegerType()),
    ("Planned Position", "planned_position", T.StringType()),
    ("Time Until Retirement", "time_until_retirement", T.IntegerType()),
    ("Married", "married", T.StringType()),
    ("Children", "children", T.StringType()),
    ("Vacation Days Taken", "vacation_days_taken", T.IntegerType()),
    ("Overtime", "overtime", T.IntegerType()),
    ("Absence Days", "absence_days", T.IntegerType()),
    ("Absence Reason", "absence_reason", T.StringType()),
    ("Annual Performance Review", "annual_performance_review", T.IntegerType()),
    ("Location", "location", T.StringType()),
    ("Switching Readiness", "switching_readiness", T.DoubleType()),
    ("Training Costs", "training_costs", T.IntegerType()),
    ("Number of Subordinates", "number_of_subordinates", T.IntegerType()),
    ("Job Role Progression", "job_role_progression", T.StringType()),
    ("Salary", "salary", T.DoubleType()),
    ("Workplace Flexibility", "workplace_flexibility", T.IntegerType()),
    ("Team Size", "team_size", T.IntegerType()),
    ("Coaching", "coaching", T.StringType()),
    ("Job Level", "job_level", T.StringType()),
    ("Work Model", "work_model", T.StringType()),
    ("Satisfaction", "satisfaction", T.DoubleType()),
    ("Status", "status", T.StringType()),
    ("Tenure", "tenure", T.IntegerType()),
]

PANEL = T.StructType([T.StructField(name, kind) for _, name, kind in PANEL_COLUMNS])
HEADER_TO_NAME = {header: name for header, name, _ in PANEL_COLUMNS}
NAME_TO_HEADER = {name: header for header, name, _ in PANEL_COLUMNS}

# Texts that mean "no value" in delivered files ("none" is a value).
NULL_TEXTS = ["", "None", "NA", "N/A", "NULL", "null", "NaN", "nan"]

# States, reasons and model features of the panel.
STATUSES = ["Active", "Left", "Retired"]
EXIT_STATUSES = ["Left", "Retired"]
ILLNESS = "Illness"
FEATURES = [
    "year", "month", "age", "overtime", "absence_days", "salary", "satisfaction",
    "switching_readiness", "training_costs", "position", "gender", "location",
    "work_model", "married", "children", "job_role_progression", "job_level", "tenure",
]
CLUSTER_FEATURES = ["age", "salary", "overtime", "switching_readiness", "satisfaction"]
DISPLAY_COLUMNS = [
    "year", "month", "employee_id", "name", "position", "age", "status", "churn_probability",
]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def require_columns(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
