import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffflow.functions.neighbours import nearest_neighbours
from staffflow.operators import learning, preparation
from staffflow.operators.oversampling import smote_balance
from staffflow.operators.rules import progression_rank
from staffflow.plans import load_all
from staffflow.plans import learning as plans
from staffflow.plans.live import streamed_scores
from staffflow.plans.preparation import KEY, labelled, training_inputs
from staffflow.session import new_path
from staffflow.sources import files

REGISTRY = load_all()


@pytest.mark.parametrize("cell_rows, block_rows", [(1000, None), (40, None), (100, 15)])
def test_neighbours_equal_brute_force(spark, monkeypatch, cell_rows, block_rows):
    from staffflow.functions import neighbours

    monkeypatch.setattr(neighbours, "VISITORS", 50)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 0.05, (250, 4)), rng.normal(0, 3, (150, 4)), [[100.0] * 4]])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "key long, vector array<double>, copies long")
    got = {}
    for r in nearest_neighbours(df, 5, cell_rows, block_rows).collect():
        got.setdefault(r["key"], {})[r["rank"]] = r["distance"]
    gap = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(gap, np.inf)
    for i in range(len(x)):
        assert np.allclose([got[i][k] for k in range(1, 6)], np.sort(gap[i])[:5])


def test_neighbours_of_equal_distance_are_the_smaller_keys(spark):
    # corners of a cube: every row has three neighbours at distance 1, three at the root of 2
    x = [[float(i >> b & 1) for b in range(3)] for i in range(8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x)], "key long, vector array<double>, copies long")
    for cells in (1000, 3):
        near = {}
        for r in nearest_neighbours(df, 5, cells).collect():
            near.setdefault(r["key"], []).append((r["rank"], r["neighbour"]))
            assert list(r["neighbour_vector"]) == x[r["neighbour"]]
        for i in range(8):
            order = sorted((j for j in range(8) if j != i), key=lambda j: ((i ^ j).bit_count(), j))
            assert [j for _, j in sorted(near[i])] == order[:5]


def test_a_visit_holds_little_beside_its_rows():
    import tracemalloc

    from staffflow.functions.neighbours import _Best

    rng = np.random.default_rng(7)
    x, refs = rng.normal(0, 1, (1_500, 40)), rng.normal(0, 1, (16_000, 40))
    best = _Best(np.arange(1_500), x, 5, np.zeros(40))
    tracemalloc.start()
    best.visit(np.arange(10_000, 26_000), refs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6  # a distance matrix of 1,024 rows in double precision and its ranks took four times that
    gap = np.sort(((x[:50, None, :] - refs[None, :, :]) ** 2).sum(axis=2), axis=1)
    assert np.allclose(best.distance[:50] ** 2, gap[:, :5])


def test_balancing_counts_segments_and_copies(spark):
    rng = np.random.default_rng(6)
    rows = [(i, 0, rng.normal(0, 1, 3).tolist()) for i in range(500)]
    rows += [(1000 + i, 1, [9.0, 9.0, 9.0]) for i in range(30)]  # a hot group of copies
    rows += [(2000 + i, 1, rng.normal(5, 1, 3).tolist()) for i in range(31)]
    df = spark.createDataFrame(rows, "id long, label int, vector array<double>")
    out = smote_balance(df, "label", ["id"], cell_rows=16).collect()
    assert sum(r["label"] == 1 for r in out) == sum(r["label"] == 0 for r in out) == 500
    made = [r for r in out if r["is_synthetic"]]
    minority = {tuple(r[2]) for r in rows if r[1] == 1}
    per_base = {}
    for r in made:
        per_base[r["id"]] = per_base.get(r["id"], 0) + 1
        base, near, v = (np.array(r[c]) for c in ("base_vector", "neighbour_vector", "vector"))
        assert tuple(base) in minority and tuple(near) in minority
        assert np.allclose(np.cross(v - base, near - base), 0, atol=1e-9)
        assert ((v >= np.minimum(base, near) - 1e-9) & (v <= np.maximum(base, near) + 1e-9)).all()
        if r["id"] < 2000:
            assert np.allclose(v, 9.0)  # more copies than neighbours asked for
    assert max(per_base.values()) - min(per_base.values()) <= 1 and len(per_base) == 61
    again = sorted((r["id"], tuple(r["vector"])) for r in smote_balance(df, "label", ["id"], cell_rows=16).collect())
    assert again == sorted((r["id"], tuple(r["vector"])) for r in out)


def test_balancing_needs_two_classes(spark):
    df = spark.createDataFrame([(1, 1, [1.0])], "id long, label int, vector array<double>")
    with pytest.raises(ValueError):
        smote_balance(df, "label", ["id"])


def test_dummies_drop_the_first_value_and_keep_missing_apart(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id long, c string")
    out = {r["id"]: (r["c_b"], r["c_nan"]) for r in preparation.one_hot_drop_first(df, ["c"]).collect()}
    assert out == {1: (1, 0), 2: (0, 0), 3: (0, 1)}


def test_alignment_fills_and_refuses(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id long, a double, extra double")
    assert preparation.align_features(df, ["a", "gone"], ["id"]).first().asDict() == {"id": 1, "a": 2.0, "gone": 0.0}
    with pytest.raises(ValueError):
        preparation.align_features(df, ["a", "gone"], ["id"], strict=True)


def test_split_shares_are_exact_per_class(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = preparation.stratified_split(df, "y", ["id"])
    got = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    assert got == {(0, "train"): 720, (0, "test"): 180, (1, "train"): 80, (1, "test"): 20}


def test_logistic_ranks_well_and_scores_are_probabilities(spark, sf_dir):
    row = plans.evaluated(spark, sf_dir, "logistic_regression").first()
    assert row["roc_auc"] > 0.8
    bounds = plans.data(spark, sf_dir).train.groupBy("turnover").count().collect()
    assert len({r["count"] for r in bounds}) == 1  # balanced


def test_saved_model_scores_the_same(spark, sf_dir):
    row = REGISTRY["save_load_pipeline"].build(spark, sf_dir).first()
    assert row["n_rows"] > 0 and row["n_different"] == 0 and row["n_outside"] == 0


def test_one_failing_model_does_not_stop_the_rest(spark, sf_dir):
    def broken(_data):
        raise RuntimeError("no")

    trainers = {"broken": broken, "logistic_regression": lambda _d: plans.model(spark, sf_dir, "logistic_regression")}
    models, failed = learning.train_selected(plans.data(spark, sf_dir), list(trainers), trainers)
    assert list(models) == ["logistic_regression"] and failed == {"broken": "RuntimeError"}


def test_upload_and_stream_score_alike(spark, sf_dir):
    ranked = plans.ranked_upload(spark, sf_dir).collect()
    streamed = streamed_scores(spark, sf_dir)
    assert streamed.count() == streamed.select(*KEY).distinct().count()
    stored = {(r["employee_id"], r["year"], r["month"]): r["churn_probability"] for r in streamed.collect()}
    for r in ranked:
        assert stored[r["employee_id"], r["year"], r["month"]] == pytest.approx(r["churn_probability"], abs=1e-9)


def test_training_and_upload_prepare_the_same_features(spark, sf_dir):
    """The raw panel, retired staff and all absence days included, gives the training inputs after a round trip."""
    folder = new_path(spark, "raw")
    plans.write_upload(spark, sf_dir, folder)
    raw = files.scan_panel_csv(spark, folder)
    assert raw.filter("status = 'Retired'").count() > 0
    assert raw.filter("absence_reason <> 'Illness' and absence_days > 0").count() > 0
    assert raw.filter(F.col("job_role_progression") == "Lateral Move").count() > 0
    columns = [*KEY, *plans.MODEL_INPUTS, *plans.MODEL_CATEGORICAL]
    before = training_inputs(labelled(spark, sf_dir)).select(*columns)
    after = training_inputs(raw).select(*columns)
    assert before.count() == after.count()
    assert before.exceptAll(after).isEmpty()


def test_mixed_progression_is_ranked(spark):
    rows = [("Lateral Move", 5), ("7", 7), ("Promotion", 8), ("?", None), (None, None)]
    df = spark.createDataFrame(rows, "job_role_progression string, want int")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", progression_rank()).collect())


def test_uploads_of_any_year_are_scored(spark, sf_dir):
    """No row of an upload goes because of its year, unless years are asked for."""
    rows = labelled(spark, sf_dir).limit(20).withColumn("year", F.lit(1950)).withColumn("training_costs", F.lit(1.0))
    pipeline = plans.artefact(spark, sf_dir)
    n = rows.filter("status <> 'Retired'").count()
    assert plans.score_rows(pipeline, rows).count() == n > 0
    assert plans.score_rows(pipeline, rows, years=(1990, 2030)).count() == 0


def test_families_of_trees_are_trained_at_the_same_time(spark, monkeypatch):
    met, order = threading.Barrier(3, timeout=30), []

    def fitted(_spark, _sf_dir, name):
        if name not in order:
            order.append(name)
            if name in plans.TOGETHER:
                met.wait()
        return name

    monkeypatch.setattr(plans, "data", lambda *_: None)
    monkeypatch.setattr(plans, "model", fitted)
    assert plans.all_models(spark, "nowhere") == {name: name for name in plans.ops.TRAINERS}
    # the others set the session back and forth: one after another, before
    assert order[:2] == [name for name in plans.ops.TRAINERS if name not in plans.TOGETHER]


def test_a_family_that_fails_beside_others_is_reported(spark, monkeypatch):
    def fitted(_spark, _sf_dir, name):
        if name == "gbt_leafwise":
            raise ValueError(name)
        return name

    monkeypatch.setattr(plans, "data", lambda *_: None)
    monkeypatch.setattr(plans, "model", fitted)
    with pytest.raises(ValueError, match="gbt_leafwise"):
        plans.all_models(spark, "nowhere")
