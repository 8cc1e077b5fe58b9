"""Queries of the evaluation family over the deterministic score table."""

from pyspark.sql import functions as F

from staffflow.operators import evaluation as ops
from staffflow.operators.distributions import rounded
from staffflow.operators.joining import join_metrics_fit
from staffflow.operators.preparation import hash_fold
from staffflow.plans.registry import query
from staffflow.sources.tables import on_scores, scores

MATRIX = """m AS (SELECT model, count(*) FILTER (y = 1 AND score {op} {t}) AS tp,
  count(*) FILTER (y = 0 AND NOT score {op} {t}) AS tn, count(*) FILTER (y = 0 AND score {op} {t}) AS fp,
  count(*) FILTER (y = 1 AND NOT score {op} {t}) AS fn FROM scores GROUP BY model)"""
METRICS = """SELECT model, tp, tn, fp, fn, round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN {e} ELSE tp / (tp + fp) END, 9) AS precision,
  round(CASE WHEN tp + fn = 0 THEN {e} ELSE tp / (tp + fn) END, 9) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN {e} ELSE 2 * tp / (2 * tp + fp + fn) END, 9) AS f1,
  round(CASE WHEN (tp + fp) * (tp + fn) * CAST(tn + fp AS DOUBLE) * (tn + fn) = 0 THEN 0 ELSE
    (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
    / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) END, 9) AS mcc FROM m"""
RATES = ["accuracy", "precision", "recall", "f1", "mcc"]


@query("confusion_matrix", on_scores("SELECT * FROM m", MATRIX.format(op=">=", t="0.5e0")))
def confusion_matrix(spark, sf_dir):
    return ops.confusion_matrix(scores(spark, sf_dir), ["model"])


@query(
    "classification_metrics",
    on_scores(
        "SELECT 'from_half' AS rule, * FROM (" + METRICS.format(e="0e0") + ") UNION ALL SELECT 'above_0.9', * FROM ("
        + METRICS.format(e="1e0").replace("FROM m", "FROM m2") + ")",
        MATRIX.format(op=">=", t="0.5e0"),
        MATRIX.format(op=">", t="0.9e0").replace("m AS", "m2 AS", 1),
    ),
)
def classification_metrics(spark, sf_dir):
    src = scores(spark, sf_dir)
    half = ops.classification_metrics(src, ["model"])
    strict = ops.classification_metrics(src, ["model"], 0.9, inclusive=False, empty=1.0)
    out = half.select(F.lit("from_half").alias("rule"), "*").unionByName(strict.select(F.lit("above_0.9").alias("rule"), "*"))
    return rounded(out, 9, RATES)


LOSS_SQL = """SELECT model, round(avg(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END), 6) AS log_loss FROM (
  SELECT model, y, least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM scores) GROUP BY model"""


@query("log_loss", on_scores(LOSS_SQL))
def log_loss(spark, sf_dir):
    return rounded(ops.log_loss(scores(spark, sf_dir), ["model"]), 6, ["log_loss"])


CURVE = """curve AS (SELECT model, score, pos, neg,
  CAST(sum(pos) OVER up AS BIGINT) AS tp, CAST(sum(neg) OVER up AS BIGINT) AS fp,
  CAST(sum(pos) OVER (PARTITION BY model) AS BIGINT) AS p, CAST(sum(neg) OVER (PARTITION BY model) AS BIGINT) AS n
  FROM (SELECT model, score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scores GROUP BY model, score)
  WINDOW up AS (PARTITION BY model ORDER BY score DESC))"""
AUC_SQL = """SELECT model, round(sum(pos * (CAST(n - fp AS DOUBLE) + neg / 2)) / (any_value(p) * CAST(any_value(n) AS DOUBLE)), 9)
  AS roc_auc FROM curve GROUP BY model"""


@query("roc_auc", on_scores(AUC_SQL, CURVE))
def roc_auc(spark, sf_dir):
    return rounded(ops.roc_auc(scores(spark, sf_dir), ["model"]), 9, ["roc_auc"])


@query(
    "roc_curve",
    on_scores("""SELECT model, score AS threshold, round(fp / n, 9) AS fpr, round(tp / p, 9) AS tpr FROM curve
      UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0e0, 0e0 FROM curve
      UNION ALL SELECT 'Random Baseline', CAST(NULL AS DOUBLE), v, v FROM (VALUES (0e0), (1e0)) b(v)""", CURVE),
)
def roc_curve(spark, sf_dir):
    curve = ops.roc_curve(scores(spark, sf_dir), ["model"])
    ends = [("Random Baseline", None, 0.0, 0.0), ("Random Baseline", None, 1.0, 1.0)]
    diagonal = spark.createDataFrame(ends, "model string, threshold double, fpr double, tpr double")
    return rounded(curve.unionByName(diagonal), 9, ["fpr", "tpr"])


@query(
    "precision_recall_curve",
    on_scores("""SELECT model, score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / p, 9) AS recall FROM curve
      UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1e0, 0e0 FROM curve""", CURVE),
)
def precision_recall_curve(spark, sf_dir):
    return rounded(ops.precision_recall_curve(scores(spark, sf_dir), ["model"]), 9, ["precision", "recall"])


@query(
    "threshold_for_precision",
    on_scores("""SELECT model, target, coalesce(min(score) FILTER (tp / (tp + fp) > target), 0.5e0) AS threshold
      FROM curve, (VALUES (0.6e0), (0.33e0)) t(target) GROUP BY model, target""", CURVE),
)
def threshold_for_precision(spark, sf_dir):
    src = scores(spark, sf_dir)
    parts = [
        ops.threshold_for_precision(src, ["model"], t).select("model", F.lit(t).alias("target"), "threshold")
        for t in (0.6, 0.33)
    ]
    return parts[0].unionByName(parts[1])


FOLDS = """folded AS (SELECT *, CASE WHEN substr(md5(CAST(row_key AS VARCHAR)), 1, 4) < 'cccc' THEN 'train' ELSE 'test' END
  AS fold FROM scores),
accuracies AS (SELECT model, avg(CAST((score > {t}) = (y = 1) AS INTEGER)) FILTER (fold = 'train') AS train_accuracy,
  avg(CAST((score > {t}) = (y = 1) AS INTEGER)) FILTER (fold = 'test') AS test_accuracy FROM folded GROUP BY model),
flags AS (SELECT model, train_accuracy - test_accuracy > 0.1e0 AS overfit,
  train_accuracy < 0.6e0 AND test_accuracy < 0.6e0 AS underfit FROM accuracies)"""


def folded(spark, sf_dir):
    return hash_fold(scores(spark, sf_dir), ["row_key"], 0.8)


@query("fit_flags", on_scores("SELECT * FROM flags", FOLDS.format(t="0.5e0")))
def fit_flags(spark, sf_dir):
    return ops.fit_flags(ops.train_test_accuracy(folded(spark, sf_dir)))


@query(
    "fit_gap_classes",
    on_scores("""SELECT model, round(train_accuracy, 9) AS train_accuracy, round(test_accuracy, 9) AS test_accuracy,
      round(train_accuracy - test_accuracy, 9) AS gap, CASE WHEN train_accuracy - test_accuracy > 0.1e0 THEN 'overfit'
        WHEN train_accuracy - test_accuracy < -0.1e0 THEN 'underfit' ELSE 'balanced' END AS fit FROM accuracies
      ORDER BY gap DESC, model""", FOLDS.format(t="0.5e0")),
)
def fit_gap_classes(spark, sf_dir):
    out = ops.fit_gap_classes(ops.train_test_accuracy(folded(spark, sf_dir)))
    return rounded(out, 9, ["train_accuracy", "test_accuracy", "gap"])


# All models together, decided above 0.9 (most scores lie below, so accuracy is the base rate).
BOARD = [FOLDS.format(t="0.9e0"), CURVE, MATRIX.format(op=">", t="0.9e0"),
         f"metrics AS (SELECT * FROM ({METRICS.format(e='0e0')}) JOIN ({AUC_SQL}) USING (model) JOIN ({LOSS_SQL}) USING (model))"]
BOARD_ROUND = {9: [*RATES, "roc_auc"], 6: ["log_loss"]}


def board(spark, sf_dir):
    out = ops.evaluation_table(scores(spark, sf_dir), ["model"], 0.9, inclusive=False)
    for digits, columns in BOARD_ROUND.items():
        out = rounded(out, digits, columns)
    return out


def board_flags(spark, sf_dir):
    return ops.fit_flags(ops.train_test_accuracy(folded(spark, sf_dir), 0.9))


@query("join_metrics_fit", on_scores("SELECT * FROM metrics JOIN flags USING (model)", *BOARD))
def metrics_with_fit(spark, sf_dir):
    return join_metrics_fit(board(spark, sf_dir), board_flags(spark, sf_dir))


@query("leaderboard", on_scores("SELECT * FROM metrics ORDER BY roc_auc DESC, model", *BOARD))
def leaderboard(spark, sf_dir):
    return ops.leaderboard(board(spark, sf_dir), "roc_auc")


@query(
    "best_model",
    on_scores("""SELECT * FROM metrics JOIN flags USING (model) WHERE NOT overfit AND NOT underfit
      ORDER BY roc_auc DESC, f1 DESC, model LIMIT 1""", *BOARD),
)
def best_model(spark, sf_dir):
    return ops.best_model(board(spark, sf_dir), board_flags(spark, sf_dir))


@query(
    "score_histogram",
    on_scores("""SELECT model, bin, round(lo + bin * ((hi - lo) / 30), 9) AS bin_start, count(*) AS count,
      n_positive, n_positive = 0 AS no_positives FROM (
        SELECT s.model, lo, hi, n_positive, CAST(least(floor((score - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin
        FROM scores s JOIN (SELECT model, min(score) AS lo, max(score) AS hi,
          count(*) FILTER (score > 0.5e0) AS n_positive FROM scores GROUP BY model) b ON s.model = b.model)
      GROUP BY model, bin, lo, hi, n_positive"""),
)
def score_histogram(spark, sf_dir):
    return rounded(ops.score_histogram(scores(spark, sf_dir), ["model"]), 9, ["bin_start"])
