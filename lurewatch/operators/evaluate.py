"""Evaluation reports over a score table ``(mail_id, score, label[, noisy_label, family])``.

Rank reports (AUC, curve points, calibration) read one small stored table of how many
mails have each score; ``score_counts`` makes it once for several reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lurewatch.schema import DECISION_THRESHOLD, PHISHING_FAMILIES
from lurewatch.sources.reports import stored

#: Score buckets of the distributed prefix sums; bounds every single-task window.
BUCKETS = 4096


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def by_label_kind(scores: DataFrame) -> DataFrame:
    """One row per mail and label kind: clean truth and, when present, observed label."""
    kinds = [("clean", "label")] + (
        [("noisy", "noisy_label")] if "noisy_label" in scores.columns else []
    )
    pairs = F.array(*[F.struct(F.lit(k).alias("label_kind"), F.col(c).alias("y")) for k, c in kinds])
    return scores.select("score", F.inline(pairs))


def binary_metrics(scores: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Confusion counts, precision, recall, F1 and Brier score per label kind."""
    hit, y = F.col("score") >= threshold, F.col("y") == 1
    counts = by_label_kind(scores).groupBy("label_kind").agg(
        F.count_if(hit & y).alias("tp"),
        F.count_if(hit & ~y).alias("fp"),
        F.count_if(~hit & y).alias("fn"),
        F.count_if(~hit & ~y).alias("tn"),
        F.avg(F.pow(F.col("score") - F.col("y"), 2)).alias("brier"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "label_kind", "tn", "fp", "fn", "tp",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "brier",
    )


def family_report(scores: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Detection rate of attack families, false-positive rate of benign ones, worst first."""
    rate = F.avg((F.col("score") >= threshold).cast("double"))
    report = scores.groupBy("family").agg(
        rate.alias("rate"), F.count("*").alias("n"), F.avg("score").alias("mean_score")
    )
    attack = F.col("family").isin(*PHISHING_FAMILIES)
    return report.select(
        "family",
        F.when(attack, "phishing").otherwise("benign").alias("type"),
        F.when(attack, F.col("rate")).alias("detection_rate"),
        F.when(~attack, F.col("rate")).alias("false_positive_rate"),
        "n", "mean_score",
    ).orderBy(F.col("detection_rate").asc_nulls_last(), "family")


def corpus_profile(mail: DataFrame) -> DataFrame:
    """Sizes, class counts and observed-label noise of a labelled corpus."""
    flipped = F.count_if(F.col("label") != F.col("noisy_label"))
    return mail.agg(
        F.count("*").alias("total"),
        F.sum("label").alias("phishing"),
        F.sum(1 - F.col("label")).alias("benign"),
        flipped.alias("noisy"),
        (flipped / F.count("*")).alias("noise_rate"),
    )


def class_weights(mail: DataFrame, label: str = "label") -> DataFrame:
    """Balanced class weights n / (2 * n_class)."""
    counts = mail.groupBy(label).agg(F.count("*").alias("n_class"))
    total = F.sum("n_class").over(Window.partitionBy())  # two rows
    classes = F.count("*").over(Window.partitionBy())
    return counts.select(
        label, "n_class", (total / (classes * F.col("n_class"))).alias("class_weight")
    )


def score_counts(scores: DataFrame, label: str = "label") -> DataFrame:
    """``(score, tp_here, n_here)``: mails of each score, stored, so the mails are scored once.

    Scores count to nine digits. Every rank report accepts this table in place of scores.
    """
    if "n_here" in scores.columns:
        return scores
    counts = scores.groupBy(F.round("score", 9).alias("score")).agg(
        F.sum(label).alias("tp_here"), F.count("*").alias("n_here")
    )
    return stored(counts, "score_counts")


def _cumulative(scores: DataFrame, label: str) -> DataFrame:
    """Distinct scores with running counts from the highest score down.

    Rows collapse per score first (map-side), then running sums are offset + window
    inside a score bucket: no task ever sorts the whole table. Scores count to nine
    digits, so a bucket holds at most 10**9 / BUCKETS of them however they crowd.
    """
    by_score = score_counts(scores, label)
    by_score = by_score.withColumn("bucket", F.floor(F.col("score") * BUCKETS))
    above = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = by_score.groupBy("bucket").agg(
        F.sum("tp_here").alias("tp"), F.sum("n_here").alias("n")
    )
    # At most BUCKETS + 1 rows: the global window and the broadcast stay small.
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("tp").over(above), F.lit(0)).alias("tp_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.sum("tp").over(Window.partitionBy()).alias("positives"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    inside = (
        Window.partitionBy("bucket")
        .orderBy(F.col("score").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return by_score.join(F.broadcast(offsets), "bucket").select(
        "score", "tp_here", "n_here", "positives", "total",
        (F.col("tp_above") + F.sum("tp_here").over(inside)).alias("tp"),
        (F.col("n_above") + F.sum("n_here").over(inside)).alias("n"),
    )


def ranking_metrics(scores: DataFrame, label: str = "label") -> DataFrame:
    """Exact ROC-AUC (ties count one half) and average precision (step sum)."""
    c = _cumulative(scores, label)
    fp_here = F.col("n_here") - F.col("tp_here")
    negatives = F.col("total") - F.col("positives")
    pairs = F.sum(fp_here * (F.col("tp") - F.col("tp_here") / 2))
    steps = F.sum(F.col("tp_here") * (F.col("tp") / F.col("n")))
    return c.agg(
        (pairs / (F.max("positives") * F.max(negatives))).alias("roc_auc"),
        (steps / F.max("positives")).alias("pr_auc"),
        F.max("positives").alias("positives"),
        F.max(negatives).alias("negatives"),
    )


def roc_points(scores: DataFrame, label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    c, negatives = _cumulative(scores, label), F.col("total") - F.col("positives")
    return c.select(
        F.col("score").alias("threshold"),
        ((F.col("n") - F.col("tp")) / negatives).alias("fpr"),
        (F.col("tp") / F.col("positives")).alias("tpr"),
    )


def pr_points(scores: DataFrame, label: str = "label") -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    return _cumulative(scores, label).select(
        F.col("score").alias("threshold"),
        (F.col("tp") / F.col("n")).alias("precision"),
        (F.col("tp") / F.col("positives")).alias("recall"),
    )


def calibration_bins(scores: DataFrame, label: str = "label", bins: int = 10) -> DataFrame:
    """Observed against predicted rate in quantile bins (linear interpolation).

    Quantiles are read off the running counts, so no task holds all scores.
    """
    c = _cumulative(scores, label)
    # Zero-based ranks, ascending, covered by the rows of one score.
    first, last = F.col("total") - F.col("n"), F.col("total") - F.col("n") + F.col("n_here") - 1

    def edge(k: int) -> Column:
        place = (F.col("total") - 1) * F.lit(k / bins)
        low, high = F.floor(place), F.ceil(place)
        at = lambda r: F.max(F.when((first <= r) & (r <= last), F.col("score")))
        share = F.max(place - low)
        return at(low) + (at(high) - at(low)) * share

    edges = c.agg(F.array(*[edge(k) for k in range(1, bins)]).alias("edges")).scalar()
    located = c.withColumn("edges", edges).select(
        F.size(F.filter("edges", lambda e: e < F.col("score"))).alias("bin"),
        "score", "tp_here", "n_here",
    )
    n = F.sum("n_here")
    return located.groupBy("bin").agg(
        n.alias("n"),
        (F.sum("tp_here") / n).alias("fraction_positive"),
        (F.sum(F.col("score") * F.col("n_here")) / n).alias("mean_predicted"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """Model of the highest F1; the first of the reporting order wins ties."""
    return metrics.agg(
        F.max_by("model", F.struct(F.col("f1"), -F.col("position"))).alias("best_model"),
        F.max("f1").alias("f1"),
    )
