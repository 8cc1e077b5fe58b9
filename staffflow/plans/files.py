"""Queries that write files and read them back."""

from pyspark.sql import functions as F

from staffflow.plans.joining import MODELS, SCORED_SQL, scored_panel
from staffflow.plans.registry import query
from staffflow.schema import PANEL
from staffflow.session import new_path
from staffflow.sources import files
from staffflow.sources.tables import PANEL_VIEW_COLUMNS, on_panel, panel

STORED = [c for c in PANEL_VIEW_COLUMNS if c in PANEL.fieldNames()]
STORED_SQL = "SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c == "satisfaction" else c for c in STORED
) + " FROM panel"


LAST = "exit_date"  # null for most rows: those lines are short


def _raw_lines(rows, path, long: bool = False) -> None:
    """CSV whose lines end where their last values are null; with ``long`` they have one field too many."""
    names = [*[c for c in rows.columns if c != LAST], LAST]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names[:-1]]
    tail = F.when(F.col(LAST).isNull(), "").otherwise(F.concat(F.lit(","), F.col(LAST).cast("string")))
    if long:
        tail = F.concat(F.lit(","), F.coalesce(F.col(LAST).cast("string"), F.lit("")), F.lit(",surplus"))
    header = ",".join(files.NAME_TO_HEADER[c] for c in names)
    # no quoting: the one column is the whole line, its name the header line
    line = F.concat(F.concat_ws(",", *texts), tail).alias(header)
    rows.select(line).write.option("header", True).option("quote", "\u0000").option("sep", "\u0001").csv(path)


def mixed_deliveries(spark, sf_dir) -> list[str]:
    """Folders in three layouts: plain with line breaks in names; other order with 31.0 for 31; short and long lines."""
    src = panel(spark, sf_dir, STORED).withColumn("name", F.expr(f"CASE WHEN {BROKEN} THEN name || chr(10) || 'II' ELSE name END"))
    paths = [new_path(spark, f"delivery-{k}") for k in range(4)]
    kind = F.col("employee_id") % 3
    files.write_panel(src.filter(kind == 0), paths[0], "csv")
    other = src.filter(kind == 1).select(*reversed(STORED))
    files.write_panel(other.withColumns({c: F.col(c).cast("double") for c in ("age", "month", "overtime")}), paths[1], "csv")
    plain = src.filter(kind == 2)
    _raw_lines(plain.filter("month <> 7"), paths[2])
    _raw_lines(plain.filter("month = 7"), paths[3], long=True)
    return paths


BROKEN = "employee_id % 12 = 0"
DELIVERED_SQL = STORED_SQL.replace(" FROM panel", "").replace(
    "name,", f"CASE WHEN {BROKEN} THEN name || chr(10) || 'II' ELSE name END AS name,"
) + " FROM panel"


@query("scan_panel_csv", on_panel(DELIVERED_SQL))
def scan_panel_csv(spark, sf_dir):
    return files.scan_panel_csv(spark, mixed_deliveries(spark, sf_dir), multi_line=True).select(*STORED)


@query(
    "csv_line_report",
    on_panel("""SELECT CASE WHEN month = 7 THEN 'long' ELSE 'short' END AS problem, count(*) AS n_lines FROM panel
      WHERE employee_id % 3 = 2 AND (month = 7 OR exit_date IS NULL) GROUP BY 1"""),
)
def csv_line_report(spark, sf_dir):
    return files.csv_line_report(spark, mixed_deliveries(spark, sf_dir), multi_line=True)


@query("write_panel", on_panel(STORED_SQL.replace("CAST(satisfaction AS DOUBLE) AS ", "")))
def write_panel(spark, sf_dir):
    path = new_path(spark, "panel")
    src = panel(spark, sf_dir, STORED)
    files.write_panel(src, path)
    return files.read_panel(spark, path, src.schema)


@query("scan_scores_multi", on_panel("SELECT name, employee_id, churn_probability, model FROM scored", SCORED_SQL))
def scan_scores_multi(spark, sf_dir):
    """One file per model, one file without the score column and one that does not exist."""
    scored = scored_panel(spark, sf_dir)
    paths = {}
    for model in MODELS:
        paths[model] = new_path(spark, f"scores-{model}")
        scored.filter(F.col("model") == model).drop("model").write.parquet(paths[model])
    paths["unscored"] = new_path(spark, "unscored")
    scored.select("name", "employee_id").distinct().write.parquet(paths["unscored"])
    paths["absent"] = new_path(spark, "absent")
    out, skipped = files.scan_scores_multi(spark, paths)
    if sorted(skipped) != ["absent", "unscored"]:
        raise AssertionError(f"unexpected sources skipped: {skipped}")
    return out
