import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from staffflow.operators import clean, filters
from staffflow.session import new_path
from staffflow.sources import files


def test_derive_year_needs_a_source(spark):
    df = spark.createDataFrame([("2020-05-01",)], "hiring_date string")
    assert clean.derive_year(df).first()["year"] == 2020
    with pytest.raises(ValueError):
        clean.derive_year(df.drop("hiring_date"))


def test_normalise_text_keeps_the_word_none(spark):
    rows = [("  x\t",), ("N/A",), ("",), ("None",), ("none",), (None,)]
    got = [r[0] for r in clean.normalise_text(spark.createDataFrame(rows, "a string")).collect()]
    assert got == ["x", None, None, None, "none", None]


def test_typed_cast_fails_on_bad_values(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    with pytest.raises(PySparkException):
        clean.typed_cast(df, {"a": "int"}).collect()


def test_drop_retired_keeps_missing_status(spark):
    df = spark.createDataFrame([("Retired",), ("Left",), (None,)], "status string")
    assert filters.drop_retired(df).count() == 2


def test_latest_period_is_last_month_of_last_year(spark):
    rows = [(1, 2020, 12, 0), (2, 2021, 2, 0), (3, 2021, 2, 1), (4, 2021, 1, 0)]
    df = spark.createDataFrame(rows, "employee_id long, year int, month int, turnover int")
    assert [r["employee_id"] for r in filters.latest_period_snapshot(df).collect()] == [2]


def test_csv_scan_types_nulls_and_broken_lines(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text(
        "Year,Month,Employee_ID,Hiring Date,Absence Reason,Job Level,Salary\n"
        "2020,1,7, 2019-03-01 ,None,3,10.5\n"
        "2020,2,8,N/A,none,Senior Level,abc\n"
        "2020,2,8,N/A,none,Senior Level,1,extra\n"
    )
    rows = files.scan_panel_csv(spark, str(path)).orderBy("employee_id", "month").collect()
    assert [r["employee_id"] for r in rows] == [7, 8, 8]
    assert rows[0]["hiring_date"] == datetime.date(2019, 3, 1) and rows[0]["absence_reason"] is None
    assert rows[1]["hiring_date"] is None and rows[1]["absence_reason"] == "none" and rows[1]["salary"] is None
    broken = files.corrupt_lines(spark, str(path)).collect()
    assert [(r["problem"], "extra" in r["line"]) for r in broken] == [("long", True)]


def test_csv_files_are_read_by_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Employee_ID,Name,Age,Salary\n1,"x\ny",31,5\n2,short\n')
    (tmp_path / "b.csv").write_text("Name,Employee_ID,Salary,Age\nz,9,44.0,31.0\n")
    rows = files.scan_panel_csv(spark, str(tmp_path), multi_line=True).orderBy("employee_id").collect()
    assert [(r["employee_id"], r["name"], r["age"], r["salary"]) for r in rows] == [(1, "x\ny", 31, 5.0), (2, "short", None, None), (9, "z", 31, 44.0)]
    assert [tuple(r) for r in files.csv_line_report(spark, str(tmp_path), multi_line=True).collect()] == [("short", 1)]
    (tmp_path / "c.csv").write_text("a,b\n1,2\n")
    with pytest.raises(files.SourceError):
        files.scan_panel_csv(spark, str(tmp_path))


def test_csv_scan_reports_missing_and_empty_files(spark, tmp_path):
    with pytest.raises(files.SourceError):
        files.scan_panel_csv(spark, str(tmp_path / "absent.csv"))
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(files.SourceError):
        files.scan_panel_csv(spark, str(empty))


def test_clean_panel_drops_copies_and_labels_reasons(spark):
    rows = [(1, " 2020-01-01", None), (1, "2020-01-01", "null"), (2, "bad", "Illness")]
    df = spark.createDataFrame(rows, "employee_id long, hiring_date string, absence_reason string")
    out = clean.clean_panel(df, "unknown").orderBy("employee_id").collect()
    assert [(r["employee_id"], r["absence_reason"]) for r in out] == [(1, "unknown"), (2, "Illness")]
    assert out[1]["hiring_date"] is None


def test_filters_reach_the_scan(spark):
    path = new_path(spark, "pushdown")
    spark.range(100).select(
        F.col("id").alias("employee_id"),
        (2000 + F.col("id") % 20).cast("int").alias("year"),
        (1 + F.col("id") % 12).cast("int").alias("month"),
        F.lit("2001-01-01").cast("date").alias("exit_date"),
    ).write.partitionBy("year", "month").parquet(path)
    df = spark.read.parquet(path)
    plan = filters.event_year_filter(filters.filter_year_range(df, 2005, 2010), "exit_date", 2001)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(exit_date" in text and "year#" in text.split("PartitionFilters: [")[1]


def test_latest_full_month_follows_the_table(spark):
    """Months with few rows count as not delivered; a table that reaches further has its own last month."""
    from staffflow.operators.filters import latest_period_snapshot

    rows = [(e, y, m, 0) for y in (2001, 2002) for m in range(1, 13) for e in range(10)] + [(e, 2003, 1, 0) for e in range(2)]
    more = [(e, y, 6, e % 2) for y in (2004, 2005) for e in range(10)] + [(1, 2005, 9, 0)]
    schema = "employee_id long, year int, month int, turnover int"
    for table, want in ((rows, (2002, 12, 10)), (rows + more, (2005, 6, 5))):
        out = latest_period_snapshot(spark.createDataFrame(table, schema), full_share=0.5).collect()
        assert {(r.year, r.month) for r in out} == {want[:2]} and len(out) == want[2]
    out = latest_period_snapshot(spark.createDataFrame(rows, schema)).collect()
    assert {(r.year, r.month) for r in out} == {(2003, 1)}


def test_query_and_twin_rank_the_last_month_of_a_longer_table(spark, tmp_path):
    """Orders moved on by four years: query and twin both rank 2005."""
    import os

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from staffflow.plans import load_all
    from tests.compare import compare, connect
    from tests.conftest import SMALL

    for name in os.listdir(SMALL):
        if name != "orders.parquet":
            os.symlink(f"{SMALL}/{name}", tmp_path / name)
    moved = spark.read.parquet(f"{SMALL}/orders.parquet").withColumn("o_orderdate", F.add_months("o_orderdate", 48).cast("date"))
    kind = dict(spark.read.parquet(f"{SMALL}/orders.parquet").dtypes)["o_orderdate"]
    pq.write_table(moved.withColumn("o_orderdate", F.col("o_orderdate").cast(kind)).toArrow(), tmp_path / "orders.parquet")
    for name in ("latest_period_snapshot", "critical_employees"):
        ok, note = compare(spark, connect(str(tmp_path)), load_all()[name], str(tmp_path))
        assert ok, note
    assert {r.year for r in load_all()["latest_period_snapshot"].build(spark, str(tmp_path)).collect()} == {2005}
