import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from staffflow.functions import ordered
from staffflow.operators import clustering, distributions, evaluation


def test_quantiles_are_exact_with_a_hot_value_and_outliers(spark):
    rnd = random.Random(1)
    values = {
        "a": [5.0] * 3000 + [rnd.gauss(0, 1) for _ in range(2000)],
        "b": [rnd.expovariate(1e-4) for _ in range(1501)] + [1e12],
        "c": [2.0],
    }
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p5": 0.05, "q1": 0.25, "median": 0.5, "p95": 0.95}
    out = {r["g"]: r for r in ordered.quantiles(df, ["g"], "v", probs).collect()}
    for g, vs in values.items():
        for name, p in probs.items():
            assert out[g][name] == pytest.approx(np.quantile(vs, p), rel=1e-12), (g, name)


def test_running_totals_match_a_plain_sort(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("xyz"), float(rnd.randint(0, 200))) for _ in range(5000)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = ordered.cumulative(df, ["g"], "v", {"n": F.count(F.lit(1))}, rows=7).collect()
    for r in out:
        assert r["cum_n"] == sum(1 for g, v in rows if g == r["g"] and v <= r["v"])
        assert r["all_n"] == sum(1 for g, _ in rows if g == r["g"])


def test_hash_rank_is_dense_per_group(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    out = ordered.hash_rank(df, ["g"], ["id"], "rank", digits=1).collect()
    for g in range(3):
        ranks = sorted(r["rank"] for r in out if r["g"] == g)
        assert ranks == list(range(1, len(ranks) + 1))


def test_corrected_moments(spark):
    values = [1.0, 2.0, 2.0, 7.0, 11.0]
    row = distributions.skew_kurtosis(spark.createDataFrame([(v,) for v in values], "v double")).first()
    n, m = len(values), np.mean(values)
    s = np.std(values, ddof=1)
    skew = n / ((n - 1) * (n - 2)) * sum(((v - m) / s) ** 3 for v in values)
    kurt = n * (n + 1) / ((n - 1) * (n - 2) * (n - 3)) * sum(((v - m) / s) ** 4 for v in values) - 3 * (n - 1) ** 2 / (
        (n - 2) * (n - 3)
    )
    assert row["skewness"] == pytest.approx(skew) and row["kurtosis"] == pytest.approx(kurt)


def test_constant_columns_have_no_shape(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "v double")
    row = distributions.skew_kurtosis(df).first()
    assert (row["skewness"], row["kurtosis"]) == (0.0, 0.0)
    assert distributions.kde_grid(df, "v").count() == 0


def test_correlation_skips_missing_values_pairwise(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, None, 5.0), (3.0, 1.0, 2.0), (4.0, 7.0, None), (9.0, 3.0, 4.0)]
    got = distributions.correlation_long(spark.createDataFrame(rows, "a double, b double, c double")).collect()
    for r in got:
        i, j = "abc".index(r["column_a"]), "abc".index(r["column_b"])
        pairs = [(x[i], x[j]) for x in rows if x[i] is not None and x[j] is not None]
        assert r["correlation"] == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1], abs=1e-12)


def test_histogram_of_a_constant_column_is_centred(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    out = distributions.histogram_bins(df, ["v"]).collect()
    assert [(r["bin"], r["count"]) for r in out] == [(15, 4)]
    counts, _ = np.histogram([3.0] * 4, bins=30)
    assert counts[15] == 4


def test_kde_integrates_to_one(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(300)], "v double")
    out = distributions.kde_grid(df, "v").orderBy("i").collect()
    step = out[1]["x"] - out[0]["x"]
    assert len(out) == 200 and sum(r["density"] for r in out) * step == pytest.approx(1.0, abs=0.01)


def test_kde_takes_every_distinct_value(spark):
    # far outliers: cells laid over the whole range would blur the narrow middle
    values = [i / 1000 for i in range(900)] + [-300.0, 500.0]
    out = distributions.kde_grid(spark.createDataFrame([(v,) for v in values], "v double"), "v").collect()
    v, n = np.array(values), len(values)
    bw = v.std(ddof=1) * n**-0.2
    for r in out:
        exact = np.exp(-0.5 * ((r["x"] - v) / bw) ** 2).sum() / (n * bw * np.sqrt(2 * np.pi))
        assert r["density"] == pytest.approx(exact, rel=1e-9, abs=1e-15)


def test_correlation_needs_two_columns_and_gives_null_for_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "a double, b double")
    assert all(r["correlation"] is None for r in distributions.correlation_long(df).collect())
    with pytest.raises(ValueError):
        distributions.correlation_long(df.select("a"))


def scored(spark, n=400):
    rnd = random.Random(3)
    rows = [("m", int(rnd.random() < 0.4), round(rnd.random(), 2)) for _ in range(n)]
    rows += [("one_class", 1, 0.3), ("one_class", 1, 0.7)]
    return spark.createDataFrame(rows, "model string, y int, score double")


def test_auc_equals_evaluator_and_is_null_for_one_class(spark):
    df = scored(spark)
    got = {r["model"]: r["roc_auc"] for r in evaluation.roc_auc(df, ["model"]).collect()}
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score")
    assert got["m"] == pytest.approx(evaluator.evaluate(df.filter("model = 'm'")), abs=1e-12)
    assert got["one_class"] is None


def test_roc_runs_from_origin_to_one(spark):
    curve = evaluation.roc_curve(scored(spark).filter("model = 'm'"), ["model"]).orderBy("fpr", "tpr").collect()
    assert (curve[0]["fpr"], curve[0]["tpr"]) == (0.0, 0.0) and (curve[-1]["fpr"], curve[-1]["tpr"]) == (1.0, 1.0)


def test_metrics_where_denominators_are_zero(spark):
    df = spark.createDataFrame([("m", 0, 0.1), ("m", 0, 0.2)], "model string, y int, score double")
    low = evaluation.classification_metrics(df, ["model"]).first()
    high = evaluation.classification_metrics(df, ["model"], empty=1.0).first()
    assert (low["precision"], low["recall"], low["f1"], low["mcc"], low["accuracy"]) == (0, 0, 0, 0, 1)
    assert (high["precision"], high["recall"], high["f1"]) == (1, 1, 1)


def test_threshold_rule_and_default(spark):
    rows = [("m", 0, 0.1), ("m", 1, 0.4), ("m", 0, 0.5), ("m", 1, 0.8)]
    df = spark.createDataFrame(rows, "model string, y int, score double")
    got = [evaluation.threshold_for_precision(df, ["model"], t).first()["threshold"] for t in (0.6, 0.99, 1.0)]
    assert got == [0.4, 0.8, 0.5]


def test_score_on_the_threshold(spark):
    df = spark.createDataFrame([("m", 1, 0.5)], "model string, y int, score double")
    assert evaluation.confusion_matrix(df, ["model"]).first()["tp"] == 1
    assert evaluation.confusion_matrix(df, ["model"], inclusive=False).first()["tp"] == 0


def test_best_model_rules(spark):
    metrics = spark.createDataFrame(
        [("a", 0.9, 0.5), ("b", 0.9, 0.7), ("c", 0.99, 0.9)], "model string, roc_auc double, f1 double"
    )
    accuracy = spark.createDataFrame(
        [("a", 0.9, 0.8), ("b", 0.9, 0.9), ("c", 0.99, 0.7)], "model string, train_accuracy double, test_accuracy double"
    )
    fit = evaluation.fit_flags(accuracy)
    assert evaluation.best_model_name(metrics, fit) == "b"
    with pytest.raises(ValueError):
        evaluation.best_model_name(metrics, fit.withColumn("underfit", F.lit(True)))
    with pytest.raises(ValueError):
        evaluation.leaderboard(metrics, "no_such_metric")
    gaps = {r["model"]: r["fit"] for r in evaluation.fit_gap_classes(accuracy).collect()}
    assert gaps["c"] == "overfit" and gaps["b"] == "balanced"


def test_silhouette_equals_all_pairs(spark):
    rnd = random.Random(4)
    points = [(i, rnd.gauss(i % 3 * 3, 1), rnd.gauss(0, 1), i % 3) for i in range(120)] + [(999, 50.0, 50.0, 3)]
    df = spark.createDataFrame(points, "id long, x double, y double, cluster int")
    out = {r["id"]: r["silhouette"] for r in clustering.silhouette_rows(df, ["x", "y"], [0, 1, 2, 3, 4]).collect()}
    for i, x, y, c in points:
        gaps = {}
        for j, u, v, d in points:
            if i != j:
                gaps.setdefault(d, []).append((x - u) ** 2 + (y - v) ** 2)
        if c not in gaps:
            assert out[i] == 0.0
            continue
        a, b = np.mean(gaps[c]), min(np.mean(g) for k, g in gaps.items() if k != c)
        assert out[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)
    three = df.filter("cluster < 3")
    mean = clustering.silhouette_rows(three, ["x", "y"], [0, 1, 2]).agg(F.avg("silhouette")).first()[0]
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(three)
    assert mean == pytest.approx(ClusteringEvaluator(predictionCol="cluster").evaluate(vectors), abs=1e-9)


def test_kmeans_orders_clusters_and_covers_every_row(spark):
    rows = [(float(c * 10 + i % 5), float(i % 3)) for c in range(3) for i in range(50)]
    out, centres = clustering.kmeans_segments(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    assert centres == sorted(centres) and out.count() == 150
    assert math.isclose(sum(r["n_rows"] for r in clustering.cluster_profile(out, ["a", "b"]).collect()), 150)


@pytest.mark.parametrize("shape", ["crowded", "normal", "doubling", "infinite"])
def test_buckets_stay_small_whatever_the_values(spark, shape):
    """Exact running totals, and no bucket of more than the wanted rows, also where nearly all values lie close together."""
    rng = np.random.default_rng(21)
    values = {
        "crowded": np.concatenate([rng.random(60) * 1e9, 5e8 + rng.random(5_940) * 1e-6 * 5e8]),
        "normal": rng.normal(0, 1, 6_000),
        "doubling": 2.0 ** rng.integers(-900, 900, 6_000) * rng.choice([-1, 1], 6_000),
        "infinite": np.concatenate([[-np.inf, np.inf], rng.normal(0, 1, 500)]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    cells = df.distinct()
    bucketed = ordered.value_buckets(cells, "v", rows=300)
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_bucket").collect()
    if shape != "infinite":
        assert max(r["n"] for r in sizes) <= 300 and len(sizes) >= cells.count() / 300
    assert all(a["hi"] < b["lo"] for a, b in zip(sizes, sizes[1:]))
    got = {r["v"]: r["cum_n"] for r in ordered.cumulative(df.withColumn("g", F.lit(1)), ["g"], "v", {"n": F.count(F.lit(1))}, rows=300).collect()}
    ranks = np.sort(values)
    assert all(got[v] == np.searchsorted(ranks, v, "right") for v in np.unique(values))


def test_kmeans_finds_the_means_of_separate_groups(spark):
    """Centres are the means of their members and every row is with its nearest one, both recomputed plainly."""
    rng = np.random.default_rng(31)
    groups = [rng.normal(c, 0.3, (80, 2)) for c in ([0, 0], [6, 1], [3, 9])]
    x = np.concatenate(groups)
    out, centres = clustering.kmeans_segments(spark.createDataFrame(x.tolist(), "a double, b double"), ["a", "b"])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    want = sorted(z[80 * k : 80 * (k + 1)].mean(axis=0).tolist() for k in range(3))
    assert np.allclose(centres, want, atol=1e-6)
    for r in out.collect():
        row = (np.array([r["a"], r["b"]]) - x.mean(axis=0)) / x.std(axis=0)
        assert r["cluster"] == int(((np.array(want) - row) ** 2).sum(axis=1).argmin())
