import datetime

from staffflow.operators import histories as ops
from staffflow.operators import indicators, joining

D = datetime.date
PANEL = "employee_id long, year int, month int, status string"


def test_transitions_cross_years_and_gaps(spark):
    rows = [(1, 2019, 11, "Active"), (1, 2021, 1, "Left"), (1, 2021, 3, "Left"), (2, 2020, 1, "Left")]
    out = ops.status_transitions(spark.createDataFrame(rows, PANEL)).collect()
    assert [(r["employee_id"], r["year"], r["month"], r["prev_status"]) for r in out] == [(1, 2021, 1, "Active")]


def test_sticky_flags_reset_with_the_year_unless_told(spark):
    rows = [(1, 2020, 11, "Yes"), (1, 2020, 12, "No"), (1, 2021, 1, "No")]
    df = spark.createDataFrame(rows, "employee_id long, year int, month int, children string")
    per_year = [r["children"] for r in ops.sticky_flags(df, ["children"]).orderBy("year", "month").collect()]
    forever = [r["children"] for r in ops.sticky_flags(df, ["children"], False).orderBy("year", "month").collect()]
    assert per_year == ["Yes", "Yes", "No"] and forever == ["Yes", "Yes", "Yes"]


def test_previous_month_over_new_year(spark):
    rows = [(1, 2020, 12, "a"), (1, 2021, 1, "b")]
    df = spark.createDataFrame(rows, "employee_id long, year int, month int, v string")
    assert [r["prev_v"] for r in ops.prev_period_join(df, ["v"]).orderBy("year").collect()] == [None, None]
    assert [r["prev_v"] for r in ops.prev_period_join(df, ["v"], False).orderBy("year").collect()] == [None, "a"]


def test_december_exit_opens_in_january(spark):
    df = spark.createDataFrame(
        [("Left", D(2020, 12, 15), "Clerk"), ("Active", None, "Clerk")], "status string, exit_date date, position string"
    )
    row = ops.exits_to_vacancies(df).collect()[0]
    assert (row["year"], row["month"], row["vacancies"], row["last_active_month"]) == (2021, 1, 1, "2020-12")


def test_spells_are_dense(spark):
    rows = [(1, 2020, 1, D(2019, 11, 20), None), (1, 2020, 2, D(2019, 11, 20), D(2020, 2, 1))]
    df = spark.createDataFrame(rows, "employee_id long, year int, month int, hiring_date date, exit_date date")
    out = ops.expand_spells(df).orderBy("period").collect()
    assert [(r["year"], r["month"]) for r in out] == [(2019, 11), (2019, 12), (2020, 1), (2020, 2)]


def test_first_row_of_year_hides_later_exit_but_last_row_shows_it(spark):
    rows = [(1, 2020, 1, "Active"), (1, 2020, 6, "Left")]
    df = spark.createDataFrame(rows, PANEL)
    first, last = (indicators.year_category_pivot(df, keep).first() for keep in ("first", "last"))
    assert (first["Active"], first["Left"]) == (1, 0) and (last["Active"], last["Left"]) == (0, 1)


def test_flows_count_people_once(spark):
    rows = [
        (1, "Active", D(2019, 1, 1), None), (1, "Left", D(2019, 1, 1), D(2020, 5, 1)),
        (2, "Retired", D(2020, 1, 1), D(2020, 6, 1)), (3, "Active", None, None),
    ]
    df = spark.createDataFrame(rows, "employee_id long, status string, hiring_date date, exit_date date")
    out = {r["year"]: (r["new_hires"], r["exits"], r["retirements"]) for r in indicators.flows_by_year(df).collect()}
    assert out == {2019: (1, 0, 0), 2020: (1, 1, 1)}


def test_kpis_without_illness_read_no_data(spark):
    df = spark.createDataFrame(
        [(2020, 100.0, 5, "none", 3)], "year int, salary double, satisfaction int, absence_reason string, absence_days int"
    )
    row = indicators.kpi_labels(indicators.kpis_by_year(df)).first()
    assert row["salary_label"] == "100.00 €" and row["absence_label"] == "No data"


def test_comparison_counts_models(spark):
    rows = [("Ann", 1, "a", 5.0), ("Ann", 1, "b", 7.0), ("Bob", 2, "b", 1.0)]
    tops = spark.createDataFrame(rows, "name string, employee_id long, model string, churn_probability double")
    out = joining.sort_by_name_id(joining.compare_models(tops, ["a", "b", "c"])).collect()
    assert [(r["churn_a"], r["churn_b"], r["churn_c"], r["frequency_in_models"], r["match"]) for r in out] == [
        (5.0, 7.0, None, 2, True),
        (None, 1.0, None, 1, False),
    ]


def _runs(spark, out):
    from staffflow.session import subfolders

    return [run for level in subfolders(spark, out) for run in subfolders(spark, level)]


def test_runs_are_merged_and_the_newest_wins(spark):
    """Batches in any order, some repeated: few runs are left and each key has its newest row."""
    import random

    from staffflow.session import new_path
    from staffflow.streaming.uploads import KEYS, UPLOADED, store_run, stored_newest

    rnd, out, want = random.Random(3), new_path(spark, "runs"), {}
    schema = f"employee_id long, year int, month int, {UPLOADED} long, score double"
    batches = []
    for number in range(20):
        rows = [(rnd.randrange(12), 2000, rnd.randrange(1, 4), rnd.randrange(1000), rnd.random()) for _ in range(30)]
        batches.append((number, rows))
        for e, y, m, t, s in rows:
            want[e, y, m] = max(want.get((e, y, m), (-1, 0.0)), (t, s))
    order = batches + rnd.sample(batches, 3)  # three batches come once more
    for number, rows in order:
        store_run(spark.createDataFrame(rows, schema), out, number, KEYS, fan_in=4)
        assert all(sum(f"level={k}/" in r for r in _runs(spark, out)) < 4 for k in range(5))
    got = {(r["employee_id"], r["year"], r["month"]): (r[UPLOADED], r["score"]) for r in stored_newest(spark, out, KEYS).collect()}
    assert got == want


def test_keyed_state_expires_and_ignores_replays(spark):
    """An older delivery after a newer one changes nothing; months beyond the limit leave the state."""
    from staffflow.session import new_path
    from staffflow.streaming.uploads import KEYS, UPLOADED, stored_newest, stream_newest

    folder, out, state = (new_path(spark, n) for n in ("deliveries", "newest", "state"))
    schema = f"employee_id long, year int, month int, {UPLOADED} long, score double"
    steps = [
        [(1, 2020, 1, 5, 0.5), (2, 2020, 1, 5, 0.5)],
        [(1, 2020, 1, 3, 0.3)],  # out of order
        [(1, 2024, 1, 6, 0.6)],  # moves the limit on
        [(2, 2020, 1, 9, 0.9)],  # too late: its month has expired
        [(1, 2024, 1, 6, 0.6), (1, 2023, 12, 7, 0.7)],  # a replay and a row within the limit
    ]
    for k, rows in enumerate(steps):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/delivery={k}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/*")
        stream_newest(stream, out, state, keep="365 days", fan_in=3)
    got = {(r["employee_id"], r["year"], r["month"]): r["score"] for r in stored_newest(spark, out, KEYS).collect()}
    assert got == {(1, 2020, 1): 0.5, (2, 2020, 1): 0.5, (1, 2024, 1): 0.6, (1, 2023, 12): 0.7}
