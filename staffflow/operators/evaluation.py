"""Model evaluation as table jobs over (label, score), grouped by model and any segment.

Curves and areas need scores in order. Equal scores collapse first and the
running totals are built per score bucket (see functions.ordered), so a model's
scores are never gathered in one task.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffflow.functions.ordered import cumulative
from staffflow.schema import require_columns

EPS = sys.float_info.epsilon


def _ratio(top: Column, bottom: Column, empty: float) -> Column:
    return F.when(bottom == 0, F.lit(empty)).otherwise(top.cast("double") / bottom)


def _cells(threshold: float, inclusive: bool) -> list[Column]:
    cut = F.lit(float(threshold))
    guess = (F.col("score") >= cut) if inclusive else (F.col("score") > cut)
    label = F.col("y") == 1
    cells = {"tp": label & guess, "tn": ~label & ~guess, "fp": ~label & guess, "fn": label & ~guess}
    return [F.count(F.when(c, 1)).alias(n) for n, c in cells.items()]


def confusion_matrix(
    scored: DataFrame, by: list[str], threshold: float = 0.5, inclusive: bool = True
) -> DataFrame:
    """TP, TN, FP, FN per group; a score on the threshold counts as positive when ``inclusive``."""
    return scored.groupBy(*by).agg(*_cells(threshold, inclusive))


def _rates(empty: float) -> list[Column]:
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    d = [c.cast("double") for c in (tp + fp, tp + fn, tn + fp, tn + fn)]
    spread = F.sqrt(d[0]) * F.sqrt(d[1]) * F.sqrt(d[2]) * F.sqrt(d[3])
    agreement = tp.cast("double") * tn - fp.cast("double") * fn
    return [
        _ratio(tp + tn, tp + tn + fp + fn, 0.0).alias("accuracy"),
        _ratio(tp, tp + fp, empty).alias("precision"),
        _ratio(tp, tp + fn, empty).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn, empty).alias("f1"),
        _ratio(agreement, spread, 0.0).alias("mcc"),
    ]


def classification_metrics(
    scored: DataFrame, by: list[str], threshold: float = 0.5, inclusive: bool = True, empty: float = 0.0
) -> DataFrame:
    """Accuracy, precision, recall, F1 and MCC; ``empty`` stands where a denominator is zero."""
    return confusion_matrix(scored, by, threshold, inclusive).select("*", *_rates(empty))


def _loss() -> Column:
    p = F.least(F.greatest(F.col("score"), F.lit(EPS)), F.lit(1 - EPS))
    return F.avg(F.when(F.col("y") == 1, -F.log(p)).otherwise(-F.log(1 - p))).alias("log_loss")


def log_loss(scored: DataFrame, by: list[str]) -> DataFrame:
    """Mean negative log likelihood with scores clipped by the machine epsilon."""
    return scored.groupBy(*by).agg(_loss())


def _by_score(scored: DataFrame, by: list[str]) -> DataFrame:
    """Per distinct score: positives and negatives, running totals from below, group totals."""
    is_pos = F.col("y") == 1
    return cumulative(
        scored, by, "score", {"pos": F.count(F.when(is_pos, 1)), "neg": F.count(F.when(~is_pos, 1))}
    )


def roc_auc(scored: DataFrame, by: list[str]) -> DataFrame:
    """Area under the ROC curve, ties at half; null where a group has one class only."""
    below = F.col("cum_neg") - F.col("neg") + F.col("neg") / 2
    return (
        _by_score(scored, by)
        .groupBy(*by)
        .agg(
            F.sum(F.col("pos") * below).alias("_won"),
            F.max("all_pos").cast("double").alias("_p"),
            F.max("all_neg").cast("double").alias("_n"),
        )
        .select(*by, F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_won") / (F.col("_p") * F.col("_n"))).alias("roc_auc"))
    )


def _at_or_above(curve: DataFrame) -> DataFrame:
    """True and false positives when every score from the row's score upwards is called positive."""
    return curve.withColumn("tp", F.col("all_pos") - F.col("cum_pos") + F.col("pos")).withColumn(
        "fp", F.col("all_neg") - F.col("cum_neg") + F.col("neg")
    )


def roc_curve(scored: DataFrame, by: list[str]) -> DataFrame:
    """One point per distinct score plus the origin (null threshold) of every group."""
    rows = _at_or_above(_by_score(scored, by))
    tpr = _ratio(F.col("tp"), F.col("all_pos"), 0.0)
    fpr = _ratio(F.col("fp"), F.col("all_neg"), 0.0)
    points = rows.select(*by, F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    none = F.lit(None).cast("double")
    origins = scored.select(*by).distinct().select(*by, none.alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origins)


def precision_recall_curve(scored: DataFrame, by: list[str]) -> DataFrame:
    """Precision and recall per distinct score plus the end point (1, 0) without a threshold."""
    rows = _at_or_above(_by_score(scored, by))
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0.0)
    recall = _ratio(F.col("tp"), F.col("all_pos"), 1.0)
    points = rows.select(
        *by, F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall")
    )
    none = F.lit(None).cast("double")
    ends = scored.select(*by).distinct().select(
        *by, none.alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(ends)


def threshold_for_precision(scored: DataFrame, by: list[str], target: float = 0.6, default: float = 0.5) -> DataFrame:
    """Smallest threshold whose precision exceeds the target, else the default."""
    curve = precision_recall_curve(scored, by)
    good = F.min(F.when(F.col("precision") > F.lit(float(target)), F.col("threshold")))
    return curve.groupBy(*by).agg(F.coalesce(good, F.lit(float(default))).alias("threshold"))


def fit_flags(accuracy: DataFrame, overfit: float = 0.1, underfit: float = 0.6) -> DataFrame:
    """Over- and underfit from train and test accuracy."""
    train, test = F.col("train_accuracy"), F.col("test_accuracy")
    return accuracy.select(
        "model",
        ((train - test) > F.lit(overfit)).alias("overfit"),
        ((train < F.lit(underfit)) & (test < F.lit(underfit))).alias("underfit"),
    )


def fit_gap_classes(accuracy: DataFrame, tolerance: float = 0.1) -> DataFrame:
    gap = F.col("train_accuracy") - F.col("test_accuracy")
    label = F.when(gap > tolerance, "overfit").when(gap < -tolerance, "underfit").otherwise("balanced")
    return accuracy.select("model", "train_accuracy", "test_accuracy", gap.alias("gap"), label.alias("fit")).orderBy(
        F.desc("gap"), "model"
    )


def train_test_accuracy(scored: DataFrame, threshold: float = 0.5, inclusive: bool = False) -> DataFrame:
    """Accuracy per model on both folds, side by side; ``fold`` is "train" or "test"."""
    m = classification_metrics(scored, ["model", "fold"], threshold, inclusive)
    return m.groupBy("model").agg(
        F.max(F.when(F.col("fold") == "train", F.col("accuracy"))).alias("train_accuracy"),
        F.max(F.when(F.col("fold") == "test", F.col("accuracy"))).alias("test_accuracy"),
    )


def evaluation_table(scored: DataFrame, by: list[str], threshold: float = 0.5, inclusive: bool = True) -> DataFrame:
    """All metrics of every model: one row per group, from one plain pass and one ordered one."""
    plain = scored.groupBy(*by).agg(*_cells(threshold, inclusive), _loss())
    return plain.select("*", *_rates(0.0)).join(roc_auc(scored, by), by)


def leaderboard(metrics: DataFrame, sort_by: str) -> DataFrame:
    """Models by a chosen metric, best first; an unknown metric is an error."""
    require_columns(metrics, [sort_by])
    return metrics.orderBy(F.desc(sort_by), "model")


def best_model(metrics: DataFrame, fit: DataFrame, primary: str = "roc_auc", tie_breaker: str = "f1") -> DataFrame:
    """The best model that neither over- nor underfits; zero rows if there is none."""
    require_columns(metrics, ["model", primary])
    require_columns(fit, ["model", "overfit", "underfit"])
    valid = metrics.join(fit, "model").filter(~F.col("overfit") & ~F.col("underfit"))
    order = [F.desc(primary)] + ([F.desc(tie_breaker)] if tie_breaker in metrics.columns else []) + [F.col("model")]
    return valid.orderBy(*order).limit(1)


def best_model_name(metrics: DataFrame, fit: DataFrame, primary: str = "roc_auc", tie_breaker: str = "f1") -> str:
    rows = best_model(metrics, fit, primary, tie_breaker).select("model").collect()  # at most one row
    if not rows:
        raise ValueError("every model over- or underfits")
    return rows[0]["model"]


def score_histogram(scored: DataFrame, by: list[str], bins: int = 30, threshold: float = 0.5) -> DataFrame:
    """Equal-width bins of the score per group, with the predicted positives in each and a flag where none is."""
    spans = scored.groupBy(*by).agg(
        F.min("score").alias("lo"),
        F.max("score").alias("hi"),
        F.count(F.when(F.col("score") > threshold, 1)).alias("n_positive"),
    )
    flat = F.col("lo") == F.col("hi")
    spans = spans.select(
        *by,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "n_positive",
    )
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.least(F.floor((F.col("score") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    return (
        scored.join(F.broadcast(spans), by)  # one row per group: the scores stay where they are
        .groupBy(*by, "lo", "hi", "n_positive", index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            *by, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"), "count",
            "n_positive", (F.col("n_positive") == 0).alias("no_positives"),
        )
    )
