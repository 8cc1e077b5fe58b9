"""Typing, cleaning and derived columns. All of it is column expressions: no shuffle."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffflow.schema import FEATURES, ILLNESS, NULL_TEXTS, require_columns, text_columns


def strip(col: Column) -> Column:
    """Trim every kind of white space, as text clean-up expects, not blanks only."""
    return F.trim(col, F.lit(" \t\n\r\f\v"))


def derive_year(df: DataFrame, source: str = "hiring_date") -> DataFrame:
    """Keep ``year``; where the table has none take it from a date column."""
    if "year" in df.columns:
        return df
    if source not in df.columns:
        raise ValueError(f"table has neither year nor {source}")
    return df.withColumn("year", F.year(F.to_date(source)))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls, rows and type per column in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.col(f.name).isNull().cast("bigint")).alias(f.name) for f in df.schema.fields],
    )
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    long = counts.unpivot(["_rows"], df.columns, "column", "n_null")
    return long.select(
        "column", types[F.col("column")].alias("type"), "n_null", F.col("_rows").alias("n_rows")
    )


def fill_nulls(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.na.fill(defaults)


def normalise_text(df: DataFrame, columns: list[str] | None = None, tokens: list[str] | None = None) -> DataFrame:
    """Trim texts and turn the given tokens into nulls."""
    tokens = tokens if tokens is not None else NULL_TEXTS
    changed = {}
    for name in columns or text_columns(df):
        text = strip(F.col(name))
        changed[name] = F.when(~text.isin(tokens), text)
    return df.withColumns(changed)


def typed_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Strict casts: under ANSI mode a bad value fails the job."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def coerce_dates(df: DataFrame, columns: list[str], fmt: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumns({c: F.try_to_date(F.col(c), fmt) for c in columns})


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct; copies collapse map-side before the shuffle."""
    return df.distinct()


def select_features(df: DataFrame, features: list[str] | None = None, label: str | None = None) -> DataFrame:
    wanted = list(features or FEATURES) + ([label] if label else [])
    require_columns(df, wanted)
    return df.select(*wanted)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def type_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: kind, share of values that read as numbers, distinct values.

    The exact distinct count groups (column, value) pairs, so copies collapse
    map-side; ``exact=False`` keeps one sketch per column instead.
    """
    kinds = {
        f.name: "numeric" if isinstance(f.dataType, T.NumericType) else "categorical" for f in df.schema.fields
    }
    kind = F.create_map(*[F.lit(x) for c, k in kinds.items() for x in (c, k)])
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    numeric_text = F.expr("try_cast(value AS double)").isNotNull().cast("bigint")
    if exact:
        cells = texts.unpivot([], df.columns, "column", "value").groupBy("column", "value")
        stats = (
            cells.agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("value").isNotNull())
            .groupBy("column")
            .agg(
                F.sum("n").alias("n"),
                F.sum(F.col("n") * numeric_text).alias("numeric"),
                F.count(F.lit(1)).alias("n_distinct"),
            )
        )
    else:
        long = texts.unpivot([], df.columns, "column", "value").filter(F.col("value").isNotNull())
        stats = long.groupBy("column").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(numeric_text).alias("numeric"),
            F.approx_count_distinct("value").alias("n_distinct"),
        )
    share = F.round(F.col("numeric") / F.col("n"), 6)
    return stats.select(
        "column",
        kind[F.col("column")].alias("kind"),
        share.alias("numeric_share"),
        ((share > 0) & (share < 1)).alias("mixed"),
        "n_distinct",
    )


def sick_absence_only(df: DataFrame) -> DataFrame:
    days = F.when(F.col("absence_reason") == ILLNESS, F.col("absence_days")).otherwise(0)
    return df.withColumn("absence_days", days)


def label_turnover(df: DataFrame) -> DataFrame:
    return df.withColumn("turnover", F.coalesce((F.col("status") == "Left").cast("int"), F.lit(0)))


def exit_category(df: DataFrame) -> DataFrame:
    status = F.col("status")
    return df.withColumn("exit_category", F.when(status.isin("Retired", "Left"), status).otherwise("Active"))


def clean_panel(df: DataFrame, reason_label: str | None = None) -> DataFrame:
    """The cleaning step as one plan: tokens to null, dates coerced, copies dropped."""
    out = normalise_text(df)
    dates = [c for c in ("hiring_date", "exit_date", "birthdate") if c in out.columns]
    texts = [c for c in dates if isinstance(out.schema[c].dataType, T.StringType)]
    out = drop_exact_duplicates(coerce_dates(out, texts))
    if reason_label is not None:
        out = fill_nulls(out, {"absence_reason": reason_label})
    return out


def contract_violations(df: DataFrame, contract: dict[str, dict]) -> DataFrame:
    """Data-quality counts per column and rule in one pass over the table.

    ``contract[column]`` may hold ``type`` (the text must cast), ``domain``
    (allowed values), ``range`` (lowest, highest) and ``required`` (no nulls).
    Missing columns are known from the schema and cost no job.
    """
    checks: dict[tuple[str, str], Column] = {}
    for name, rules in contract.items():
        col = F.col(name)
        if name not in df.columns:
            checks[name, "missing_column"] = F.lit(True)
            continue
        if rules.get("required"):
            checks[name, "null"] = col.isNull()
        if "type" in rules:
            checks[name, "uncastable"] = col.isNotNull() & F.expr(
                f"try_cast(`{name}` AS {rules['type']})"
            ).isNull()
        if "domain" in rules:
            checks[name, "out_of_domain"] = col.isNotNull() & ~col.isin(rules["domain"])
        if "range" in rules:
            low, high = rules["range"]
            checks[name, "out_of_range"] = col.isNotNull() & ~col.between(low, high)
    names = {f"c{i}": pair for i, pair in enumerate(checks)}
    counts = df.agg(*[F.sum(checks[p].cast("bigint")).alias(c) for c, p in names.items()])
    long = counts.unpivot([], list(names), "check", "n_rows")

    def part(i: int) -> Column:
        return F.create_map(*[F.lit(x) for c, p in names.items() for x in (c, p[i])])[F.col("check")]

    return long.select(part(0).alias("column"), part(1).alias("violation"), "n_rows")


