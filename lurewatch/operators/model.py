"""Training: design matrix, calibrated classifiers, comparison, importances, persistence."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from lurewatch.functions.plan import pinned
from lurewatch.functions.text import clean_text, full_text
from lurewatch.functions.draws import ROW_SPAN, row_draw
from lurewatch.operators import evaluate, logistic
from lurewatch.operators.features import mail_features
from lurewatch.operators.sampling import kfold_assign
from lurewatch.operators.scoring import fit_scaler, sigmoid
from lurewatch.operators.textvec import TextSpace, fit_text_space, with_clean_text
from lurewatch.schema import FEATURES, PHISH_THRESHOLD, SUSPECT_THRESHOLD
from lurewatch.sources.reports import stored
from lurewatch.sources.weights import LinearScorer

ALL_BLOCKS = ("tab", "word", "char")

#: Vectors in one partition of the store that fits read.
PART_ROWS = 4096
#: Histograms of tree nodes that one pass over the data may hold, in MB of a task.
NODE_MEMORY = 512
#: Steps in which draws are cut off where a caller bounds the rows.
DRAW_SLOTS = 1 << 14
#: Fits that run side by side; each is a chain of small jobs that leaves most cores idle.
CONCURRENT = 6


def side_by_side(jobs: Iterable[Callable], spark: SparkSession) -> list:
    """Results of jobs that run in threads of the driver, each in a scheduler pool of its own.

    The pools share a cluster evenly where ``spark.scheduler.mode`` is FAIR.
    """

    def pooled(job: Callable, name: str) -> Callable:
        def run():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            return job()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(CONCURRENT) as threads:
        running = [threads.submit(pooled(job, f"fit_{i}")) for i, job in enumerate(jobs)]
        return [r.result() for r in running]


@dataclass(frozen=True)
class DesignSpace:
    """Fitted scaler and vocabularies; turns mails into ``[tab | word | char]`` vectors."""

    scaler: dict[str, tuple[float, float]]
    texts: dict[str, TextSpace] = field(default_factory=dict)

    @staticmethod
    def fit(mail: DataFrame, blocks: tuple[str, ...] = ALL_BLOCKS) -> "DesignSpace":
        clean = with_clean_text(mail).select("clean")
        kinds = [b for b in ("word", "char") if b in blocks]
        jobs = [lambda: fit_scaler(mail_features(mail)).collect()]
        jobs += [lambda k=k: fit_text_space(clean, k) for k in kinds]
        rows, *texts = side_by_side(jobs, mail.sparkSession)
        return DesignSpace({r["feature"]: (r["mean"], r["scale"]) for r in rows}, dict(zip(kinds, texts)))

    @property
    def width(self) -> int:
        return len(self.scaler) + sum(len(s.terms) for s in self.texts.values())

    def transform(self, mail: DataFrame, keep: tuple[str, ...], features: bool = False) -> DataFrame:
        """``keep``, the thirty features if asked for, and ``x``; map-only."""
        wide = mail.withColumn("clean", clean_text(full_text()))
        scaled = F.array(
            *[(F.col(f) - F.lit(m)) / F.lit(s) for f, (m, s) in self.scaler.items()]
        )
        held = (*keep, *FEATURES) if features else keep
        out = mail_features(wide, (*keep, "clean")).select(*held, "clean", array_to_vector(scaled).alias("tab"))
        for kind, space in self.texts.items():
            out = space.transform(out, kind)
        sizes = {"tab": len(self.scaler)} | {k: len(t.terms) for k, t in self.texts.items()}
        for part, size in sizes.items():
            # a known size spares the assembler a look at the data, and lets it work on streams
            out = VectorSizeHint(inputCol=part, size=size, handleInvalid="optimistic").transform(out)
        return VectorAssembler(inputCols=list(sizes), outputCol="x").transform(out).select(*held, "x")


@dataclass(frozen=True)
class ModelSpec:
    """One classifier kind with its size; defaults are the full-size settings."""

    kind: str = "logreg"
    trees: int = 300
    rounds: int = 400
    c: float = 4.0
    max_iter: int = 2000
    seed: int = 42

    def estimator(self):
        """Estimator of an ensemble; linear models are fitted by ``logistic``."""
        common = {"featuresCol": "x", "labelCol": "y", "maxMemoryInMB": NODE_MEMORY}
        if self.kind == "rf":
            return RandomForestClassifier(
                numTrees=self.trees, maxDepth=30, minInstancesPerNode=2, weightCol="w",
                seed=self.seed, **common,
            )
        if self.kind == "gbt":
            return GBTClassifier(
                maxIter=self.rounds, maxDepth=6, stepSize=0.1, subsamplingRate=0.9,
                featureSubsetStrategy="0.8", seed=self.seed, **common,
            )
        raise ValueError(f"unknown model kind: {self.kind}")


_LOADERS = {"rf": RandomForestClassificationModel, "gbt": GBTClassificationModel}


def with_margins(rows: DataFrame, kind: str, models: list) -> DataFrame:
    """Add ``margins``: of each model what its calibration maps, the linear margin or the ensemble's probability."""
    if kind == "logreg":
        return rows.withColumn("margins", logistic.margins(models))
    out = rows
    for i, model in enumerate(models):
        out = model.transform(out).withColumn(f"_m{i}", vector_to_array(F.col("probability"))[1])
        out = out.drop("rawPrediction", "probability", "prediction")
    return out.withColumn("margins", F.array(*[f"_m{i}" for i in range(len(models))])).select(*rows.columns, "margins")


def _balanced(rows: DataFrame, balanced: bool) -> DataFrame:
    """Add class weight ``w``."""
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if not balanced:
        return rows.withColumn("w", F.lit(1.0))
    pos, neg = (total / (2.0 * max(counts.get(k, 0), 1)) for k in (1, 0))
    return rows.withColumn("w", F.when(F.col("y") == 1, pos).otherwise(neg))


def _platt(margins: DataFrame) -> tuple[float, float]:
    """Slope and intercept of the sigmoid fitted on smoothed targets.

    A soft target t is a positive row of weight t plus a negative row of weight 1 - t.
    """
    n = margins.agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("n"))
    row = n.first()
    high, low = (row["p"] + 1.0) / (row["p"] + 2.0), 1.0 / (row["n"] + 2.0)
    target = F.when(F.col("y") == 1, high).otherwise(low)
    soft = F.array(
        F.struct(F.lit(1.0).alias("y2"), target.alias("w")),
        F.struct(F.lit(0.0).alias("y2"), (1 - target).alias("w")),
    )
    rows = margins.select(array_to_vector(F.array("margin")).alias("m"), F.inline(soft))
    fit = LogisticRegression(
        featuresCol="m", labelCol="y2", weightCol="w", regParam=0.0, maxIter=100
    ).fit(rows)
    return float(fit.coefficients[0]), float(fit.intercept)


@dataclass
class CalibratedModel:
    """Mean of fold models, each behind its own sigmoid."""

    kind: str
    space: DesignSpace
    members: list[tuple[object, float, float]]
    #: Of each member of a fit, its iterations and the objective after each (linear models).
    history: list[list[float]] = field(default_factory=list)
    phish_threshold: float = PHISH_THRESHOLD
    suspect_threshold: float = SUSPECT_THRESHOLD

    def score_vectors(self, rows: DataFrame) -> DataFrame:
        """Add ``score`` to a table that holds ``x``."""
        out = with_margins(rows, self.kind, [m for m, _, _ in self.members])
        total = F.lit(0.0)
        for i, (_, slope, intercept) in enumerate(self.members):
            total = total + sigmoid(F.lit(slope) * F.col("margins")[i] + F.lit(intercept))
        return pinned(out, {"score": total / len(self.members)}).select(*rows.columns, "score")

    def score_mail(self, mail: DataFrame, keep: tuple[str, ...] = ("mail_id",)) -> DataFrame:
        return self.score_vectors(self.space.transform(mail, keep)).drop("x")

    def score_features(self, mail: DataFrame, keep: tuple[str, ...] = ("mail_id",)) -> DataFrame:
        """``keep``, thirty features and ``score``, rounded like a linear export's."""
        rows = self.space.transform(mail, keep, features=True)
        return self.score_vectors(rows).drop("x").withColumn("score", F.round("score", 9))

    def linear_scorer(self) -> LinearScorer:
        """Fold-averaged coefficients of a linear model in the export layout."""
        if self.kind != "logreg":
            raise ValueError("only a linear model exports weights")
        n = len(self.members)
        coef = sum(m.coefficients for m, _, _ in self.members) / n
        intercept = sum(m.intercept for m, _, _ in self.members) / n
        tab = {f: (float(coef[i]), *self.space.scaler[f]) for i, f in enumerate(FEATURES)}
        word = self.space.texts["word"]
        first = len(FEATURES)
        terms = {
            t: (float(coef[first + j]), idf) for j, (t, idf) in enumerate(zip(word.terms, word.idf))
        }
        return LinearScorer(tab=tab, terms=terms, intercept=float(intercept))

    def save(self, spark: SparkSession, path: str) -> None:
        """Publish the model as a folder that is whole or refused.

        Everything goes to a private folder first; the manifest, written last, names it.
        A reader sees the old model, or the new one, or none.
        """
        place = f"parts_{uuid.uuid4().hex}"
        for i, (model, _, _) in enumerate(self.members):
            if self.kind == "logreg":
                row = [(model.coefficients.tolist(), model.intercept, list(model.history))]
                frame = spark.createDataFrame(row, "coefficients array<double>, intercept double, history array<double>")
                frame.coalesce(1).write.parquet(f"{path}/{place}/fold_{i}")
            else:
                model.write().save(f"{path}/{place}/fold_{i}")
        meta = {
            "kind": self.kind,
            "parts": place,
            "scaler": self.space.scaler,
            "texts": {k: [s.terms, s.idf] for k, s in self.space.texts.items()},
            "sigmoids": [[a, b] for _, a, b in self.members],
        }
        frame = spark.createDataFrame([(json.dumps(meta),)], "value string")
        frame.coalesce(1).write.mode("overwrite").text(f"{path}/manifest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "CalibratedModel":
        try:
            meta = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
        except (AnalysisException, TypeError) as missing:
            raise ValueError(f"no published model at {path}") from missing
        texts = {k: TextSpace(k, terms, idf) for k, (terms, idf) in meta["texts"].items()}
        space = DesignSpace({f: tuple(v) for f, v in meta["scaler"].items()}, texts)
        members, history = [], []
        for i, (a, b) in enumerate(meta["sigmoids"]):
            fold = f"{path}/{meta['parts']}/fold_{i}"
            if meta["kind"] == "logreg":
                row = spark.read.parquet(fold).first()
                model = logistic.LinearModel(np.asarray(row["coefficients"]), row["intercept"], row["history"])
                history.append(model.history)
            else:
                model = _LOADERS[meta["kind"]].load(fold)
            members.append((model, a, b))
        return CalibratedModel(meta["kind"], space, members, history)


def observed_label(mail: DataFrame) -> str:
    """Training uses the observed label when the table has one."""
    return "noisy_label" if "noisy_label" in mail.columns else "label"


def bounded_rows(mail: DataFrame, max_rows: int) -> tuple[DataFrame, int]:
    """The mails of the smallest draws, ``max_rows`` at most and all if there are no more; and how many."""
    drawn = mail.withColumn("_slot", F.floor(row_draw("fit", F.col("mail_id")) / (ROW_SPAN // DRAW_SLOTS)))
    n, last = 0, -1
    for row in sorted(drawn.groupBy("_slot").agg(F.count("*").alias("n")).collect()):  # at most DRAW_SLOTS rows
        if n + row["n"] > max_rows:
            break
        n, last = n + row["n"], row["_slot"]
    return drawn.where(F.col("_slot") <= last).drop("_slot"), n


def learned_rows(mail: DataFrame, folds: int = 3, max_rows: int | None = None) -> DataFrame:
    """All mails, or ``max_rows`` of them if a caller asks, with label ``y`` and stratified ``fold``, stored once in even parts.

    Every later step reads this table, and nothing is joined back on the id: mails that
    share one stay apart, and no wide vector is shuffled.
    """
    rows, n = (mail, mail.count()) if max_rows is None else bounded_rows(mail, max_rows)
    rows = kfold_assign(rows.withColumn("y", F.col(observed_label(mail))), folds, "y")
    parts = max(mail.sparkSession.sparkContext.defaultParallelism, -(-n // PART_ROWS))
    return stored(rows.repartition(parts, F.xxhash64("mail_id")), "learned")


def fit_vectors(rows: DataFrame, space: DesignSpace) -> DataFrame:
    """Stored training vectors of ``learned_rows``."""
    return stored(space.transform(rows, ("mail_id", "y", "fold")), "vectors")


def even(rows: DataFrame) -> DataFrame:
    """The same rows in one equal share for each core.

    Every level of the trees is one pass that waits for its largest share; a stored table comes
    back in shares as unequal as the files it was made from.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _fit_ensemble(vectors: DataFrame, spec: ModelSpec, fold: int):
    """An ensemble of all folds but one."""
    train = _balanced(vectors.where(F.col("fold") != fold), spec.kind != "gbt").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return spec.estimator().fit(train)
    finally:
        train.unpersist()


def fit_all(
    vectors: DataFrame, space: DesignSpace, specs: list[ModelSpec], folds: int = 3
) -> list[CalibratedModel]:
    """Calibrated models of all specs, fitted side by side.

    Folds of a linear spec share their passes; each ensemble is a job of its own. Then
    every member's sigmoid is fitted on the fold it did not see.
    """
    spark = vectors.sparkSession
    jobs, owners = [], []
    for spec in specs:
        if spec.kind == "logreg":
            jobs.append(lambda s=spec: logistic.fit_folds(vectors, space.width, list(range(folds)), s.c, s.max_iter))
            owners.append((spec, None))
        else:
            jobs += [lambda s=spec, k=k: _fit_ensemble(vectors, s, k) for k in range(folds)]
            owners += [(spec, k) for k in range(folds)]
    fitted: dict[int, list] = {id(s): [] for s in specs}
    for (spec, fold), result in zip(owners, side_by_side(jobs, spark)):
        fitted[id(spec)] += result if fold is None else [result]

    def calibrated(spec: ModelSpec, fold: int):
        held = with_margins(vectors.where(F.col("fold") == fold), spec.kind, [fitted[id(spec)][fold]])
        return _platt(held.select("y", F.col("margins")[0].alias("margin")))

    sigmoids = iter(side_by_side([lambda s=s, k=k: calibrated(s, k) for s in specs for k in range(folds)], spark))
    models = []
    for spec in specs:
        members = [(m, *next(sigmoids)) for m in fitted[id(spec)]]
        history = [m.history for m in fitted[id(spec)]] if spec.kind == "logreg" else []
        models.append(CalibratedModel(spec.kind, space, members, history))
    return models


def fit_calibrated(
    vectors: DataFrame, space: DesignSpace, spec: ModelSpec = ModelSpec(), folds: int = 3
) -> CalibratedModel:
    """Fit on all folds but one, calibrate on the one left out, keep every pair."""
    return fit_all(vectors, space, [spec], folds)[0]


def train(
    mail: DataFrame, spec: ModelSpec = ModelSpec(), blocks: tuple[str, ...] = ALL_BLOCKS
) -> CalibratedModel:
    rows = learned_rows(mail)
    space = DesignSpace.fit(rows, blocks)
    return fit_calibrated(fit_vectors(rows, space), space, spec)


def metric_rows(scores: DataFrame, model: str, position: int) -> DataFrame:
    """``(model, position, label_kind, metric, value)`` of one scored test table."""
    kinds = [("clean", "label")] + (
        [("noisy", "noisy_label")] if "noisy_label" in scores.columns else []
    )
    binary = evaluate.binary_metrics(scores)
    out = None
    for kind, label in kinds:
        rank = evaluate.ranking_metrics(scores, label).select(
            F.lit(kind).alias("label_kind"), "roc_auc", "pr_auc"
        )
        out = rank if out is None else out.unionByName(rank)
    wide = binary.join(out, "label_kind")
    names = ["precision", "recall", "f1", "roc_auc", "pr_auc", "brier"]
    long = wide.unpivot(["label_kind"], names, "metric", "value")
    return long.select(
        F.lit(model).alias("model"), F.lit(position).alias("position"), "label_kind", "metric",
        "value",
    )


def compare_models(
    train_mail: DataFrame,
    test_mail: DataFrame,
    specs: list[ModelSpec],
    blocks: tuple[str, ...] = ALL_BLOCKS,
) -> DataFrame:
    """Train every spec on the same vectors and report its test metrics."""
    rows = learned_rows(train_mail)
    space = DesignSpace.fit(rows, blocks)
    vectors = fit_vectors(rows, space)
    keep = ("mail_id", *[c for c in ("label", "noisy_label") if c in test_mail.columns])
    test = stored(space.transform(test_mail, keep), "test_vectors")
    report = None
    for position, (spec, model) in enumerate(zip(specs, fit_all(vectors, space, specs))):
        scores = stored(model.score_vectors(test).drop("x"), f"scores_{spec.kind}")
        rows = metric_rows(scores, spec.kind, position)
        report = rows if report is None else report.unionByName(rows)
    return with_choice(stored(report, "report"))


def deployed_choice(report: DataFrame) -> DataFrame:
    """Best model by F1 on the observed labels, first of the reporting order on ties."""
    kind = F.when(F.col("label_kind") == "noisy", 1).otherwise(0)
    f1 = report.where(F.col("metric") == "f1").withColumn("_k", kind)
    best = f1.groupBy("model", "position").agg(F.max_by("value", "_k").alias("f1"))
    return evaluate.best_model(best)


def with_choice(report: DataFrame) -> DataFrame:
    """Add ``chosen``: whether a row is of the model that gets deployed."""
    best = deployed_choice(report).select(F.col("best_model").alias("_best")).scalar()
    return report.withColumn("chosen", F.col("model") == best)


def feature_importance(mail: DataFrame, trees: int = 250, top: int = 15) -> DataFrame:
    """Impurity importances of a forest on the tabular block, largest first."""
    y = F.col(observed_label(mail)).cast("double").alias("y")
    x = array_to_vector(F.array(*FEATURES)).alias("x")
    rows = stored(mail_features(mail.withColumn("y", y), ("y",)).select("y", x), "tabular")
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="y", numTrees=trees, maxDepth=30, seed=42,
        # a row remembers its node in every tree instead of walking down from the root in each pass
        cacheNodeIds=True, maxMemoryInMB=NODE_MEMORY,
    ).fit(even(rows))
    values = [(f, float(v)) for f, v in zip(FEATURES, forest.featureImportances.toArray())]
    frame = mail.sparkSession.createDataFrame(values, "feature string, importance double")
    return frame.orderBy(F.col("importance").desc(), "feature").limit(top)
