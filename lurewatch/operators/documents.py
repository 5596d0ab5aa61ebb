"""Report documents: result tables folded into one nested object each.

Every document is one row whose columns are the top-level keys, so ``write_report``
turns it into one JSON object and ``read_report`` gives it back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lurewatch.operators import evaluate
from lurewatch.schema import PHISH_THRESHOLD

# --- Fixed values: texts of the documents. ---
_NOTE = (
    "Metriques titre = contre etiquettes bruitees (realiste). Bloc 'intrinsic' = contre verite propre "
    "(plafond, donnees synthetiques separables)."
)
_HEADLINE = "noisy_label (operationnel)"
_DEFINITION = "Taux de détection = part des phishing scorés au-dessus du seuil 'phishing' ({:.2f})."
_READING = "'chute' = détection perdue sous attaque ; 'récup' = détection restaurée par les défenses."
_FORECAST_NOTE = (
    "Projections logistiques à partir de tendances sectorielles indicatives. Le test prospectif empile des "
    "évasions montantes (texte poli IA + homoglyphes + caractères invisibles) pour mesurer la résilience et "
    "justifier le ré-entraînement continu."
)
# --- End of fixed values. ---


def _folded(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """One row with a map ``m`` from ``key`` to ``value``; rows are few (models, families, variants)."""
    return rows.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), value.alias("v")))).alias("m"))


def _listed(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row with an array ``m`` of structs in the order of ``key``."""
    order = lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0)
    return rows.agg(F.array_sort(F.collect_list(F.struct(*columns)), order).alias("m"))


def _object(spark: SparkSession, parts: dict[str, DataFrame | Column]) -> DataFrame:
    """One row: columns as they are, one-row tables by their only value."""
    return spark.range(1).select(
        *[(p.scalar() if isinstance(p, DataFrame) else p).alias(name) for name, p in parts.items()]
    )


def _model_entry(scores: DataFrame, name: str) -> DataFrame:
    """``(model, label_kind, metrics, per_family)`` of one scored test table."""
    binary = evaluate.binary_metrics(scores)
    labels = {"clean": "label"} | ({"noisy": "noisy_label"} if "noisy_label" in scores.columns else {})
    ranks = [
        evaluate.ranking_metrics(scores, column).select(F.lit(kind).alias("label_kind"), "roc_auc", "pr_auc")
        for kind, column in labels.items()
    ]
    wide = binary.join(reduce(DataFrame.unionByName, ranks), "label_kind")
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix")
    names = ["precision", "recall", "f1", "roc_auc", "pr_auc", "brier"]
    entry = wide.select(F.lit(name).alias("model"), "label_kind", F.struct(*names, matrix).alias("metrics"))
    if "family" not in scores.columns:
        return entry.withColumn("per_family", F.lit(None).cast("map<string,struct<type:string,rate:double,n:bigint>>"))
    rate = F.coalesce("detection_rate", "false_positive_rate").alias("rate")
    families = _folded(evaluate.family_report(scores), "family", F.struct("type", rate, "n"))
    return entry.withColumn("per_family", families.scalar())


def metrics_document(
    train: DataFrame, test: DataFrame, scores: dict[str, DataFrame], importance: DataFrame | None = None, top: int = 15
) -> DataFrame:
    """Sizes, label protocol, metrics of every model on observed and clean labels, best model, importances.

    ``scores`` holds the scored test side of every model in reporting order.
    """
    spark = train.sparkSession
    noisy = "noisy_label" in test.columns
    sizes = train.select("label", F.lit("train").alias("side")).unionByName(test.select("label", F.lit("test").alias("side")))
    dataset = sizes.agg(F.struct(
        F.count("*").alias("total"), F.count_if(F.col("side") == "train").alias("train"),
        F.count_if(F.col("side") == "test").alias("test"), F.sum("label").alias("phishing"), F.sum(1 - F.col("label")).alias("benign"),
    ))
    rate = F.lit(0.0)
    if noisy:
        flips = train.select("label", "noisy_label").unionByName(test.select("label", "noisy_label"))
        rate = flips.agg(F.avg((F.col("label") != F.col("noisy_label")).cast("double"))).scalar()
    protocol = F.struct(
        F.lit("noisy_label" if noisy else "label").alias("train_labels"),
        F.lit(_HEADLINE if noisy else "label").alias("headline_eval_labels"), rate.alias("label_noise_rate"), F.lit(_NOTE).alias("note"),
    )
    entries = reduce(DataFrame.unionByName, [
        _model_entry(s, name).withColumn("position", F.lit(i)) for i, (name, s) in enumerate(scores.items())
    ])
    headline = entries.where(F.col("label_kind") == ("noisy" if noisy else "clean"))
    best = evaluate.best_model(headline.select("model", "position", F.col("metrics.f1").alias("f1")))
    parts: dict[str, DataFrame | Column] = {
        "dataset": dataset,
        "label_protocol": protocol,
        "models": _folded(headline, "model", F.struct("metrics.*", "per_family")),
        "intrinsic_clean": _folded(entries.where("label_kind = 'clean'"), "model", F.col("metrics")),
        "best_model": best.select("best_model"),
    }
    if importance is not None:
        first = importance.orderBy(F.col("importance").desc(), "feature").limit(top)
        parts["feature_importance_top"] = _folded(first, "feature", F.col("importance"))
    return _object(spark, parts)


_VARIANT = ["variant", "detection_clean", "detection_attacked", "detection_defended", "drop", "recovered", "n"]


def robustness_document(baseline: DataFrame, matrix: DataFrame, threshold: float = PHISH_THRESHOLD) -> DataFrame:
    """Baseline detection and every attack, from ``baseline_detection`` and ``robustness_matrix``."""
    return _object(matrix.sparkSession, {
        "baseline_detection": baseline.select(F.round("baseline_detection", 3)),
        "n_phishing_detected": baseline.select("n_detected"),
        "threshold": F.lit(threshold),
        "attacks": _listed(matrix.withColumnRenamed("variant", "attack"), "attack", ["attack", *_VARIANT[1:]]),
        "interpretation": F.struct(F.lit(_DEFINITION.format(threshold)).alias("definition"), F.lit(_READING).alias("lecture")),
    })


def forecast_document(series: DataFrame, baseline: DataFrame, matrix: DataFrame) -> DataFrame:
    """Projections of every technique with the robustness against the variants to come."""
    projected = series.groupBy("technique", "label").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == "history", F.struct("period", "prevalence"))))).alias("history"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == "forecast", F.struct("period", "prevalence"))))).alias("forecast"),
    )
    return _object(series.sparkSession, {
        "projections": _listed(projected, "technique", ["technique", "label", "history", "forecast"]),
        "future_robustness": F.struct(
            baseline.select(F.round("baseline_detection", 3)).scalar().alias("baseline_detection"),
            _listed(matrix, "variant", _VARIANT).scalar().alias("variants"),
        ),
        "note": F.lit(_FORECAST_NOTE),
    })
