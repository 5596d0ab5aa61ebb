"""Fits of every kind on small tables, calibration, choice, save and load."""

import json
import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from lurewatch.operators import logistic, model
from lurewatch.schema import FEATURES

ROWS = T.StructType([T.StructField("x", VectorUDT()), T.StructField("y", T.IntegerType()), T.StructField("fold", T.IntegerType())])


def vectors(spark, n=240, d=6):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.5)
    y = (x @ rng.normal(size=d) + 0.7 * rng.normal(size=n) > 0.4).astype(int)
    rows = [
        (Vectors.dense(v) if i % 3 else Vectors.sparse(d, np.flatnonzero(v), v[v != 0]), int(t), i % 3)
        for i, (v, t) in enumerate(zip(x, y))
    ]
    return x, y, spark.createDataFrame(rows, ROWS).repartition(4)


@pytest.fixture(scope="module")
def rows(spark, mail):
    return model.learned_rows(mail)


@pytest.fixture(scope="module")
def space(rows):
    return model.DesignSpace.fit(rows, ("tab", "word"))


@pytest.fixture(scope="module")
def table(rows, space):
    return model.fit_vectors(rows, space)


SPECS = [model.ModelSpec("logreg"), model.ModelSpec("rf", trees=6), model.ModelSpec("gbt", rounds=3)]


@pytest.fixture(scope="module")
def models(table, space):
    return model.fit_all(table, space, SPECS)


def test_each_fold_is_the_minimum_of_its_objective(spark):
    x, y, rows = vectors(spark)
    fold = np.arange(len(y)) % 3
    for k, m in enumerate(logistic.fit_folds(rows, x.shape[1], [0, 1, 2], c=4.0, max_iter=500)):
        a, b = x[fold != k], y[fold != k]
        n = len(b)
        w = np.where(b == 1, n / (2 * b.sum()), n / (2 * (n - b.sum())))
        error = w * (1 / (1 + np.exp(-(a @ m.coefficients + m.intercept))) - b) / n
        assert np.abs(a.T @ error + m.coefficients / (4.0 * n)).max() < 2e-5 and abs(error.sum()) < 2e-5
        assert all(p > q for p, q in zip(m.history, m.history[1:])) and len(m.history) < 100


def test_the_built_in_estimator_finds_the_same_model(spark):
    x, y, rows = vectors(spark)
    train = rows.where("fold <> 0")
    lr = LogisticRegression(featuresCol="x", labelCol="y", regParam=1 / (4.0 * train.count()), standardization=False, tol=1e-12, maxIter=500)
    want = lr.fit(train)
    got = logistic.fit_folds(rows, x.shape[1], [0], c=4.0, max_iter=500, balanced=False)[0]
    assert np.allclose(got.coefficients, want.coefficients.toArray(), atol=1e-3) and abs(got.intercept - want.intercept) < 1e-3
    margin = rows.select("x", logistic.margins([got, got])[1].alias("m")).collect()
    assert np.allclose([r.m for r in margin], [r.x.dot(got.coefficients) + got.intercept for r in margin])


def test_blocks_hold_one_fold_and_rows_without_entries_have_no_margin(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(90, 7)) * (rng.random((90, 7)) < 0.3)
    x[[0, 40, 89]] = 0.0
    rows = [(Vectors.sparse(7, np.flatnonzero(v), v[v != 0]), i % 2, i % 3) for i, v in enumerate(x)]
    found = logistic.blocks(spark.createDataFrame(rows, ROWS).coalesce(1), 1).collect()
    assert sorted(set(b.fold) for b in found) == [{0}, {1}, {2}]
    w, each = rng.normal(size=7), rng.normal(size=90)
    for b in found:
        mine = np.arange(90) % 3 == b.fold[0]
        assert np.allclose(b.margins(w), x[mine] @ w)
        assert np.allclose(b.sums(each[mine], 7), x[mine].T @ each[mine]) and (b.y == (np.arange(90) % 2)[mine]).all()


def test_rare_columns_need_few_passes(spark):
    """Columns from every row's to a handful of rows': with ten pairs of steps it took 207 iterations."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 200)) * (rng.random((600, 200)) < np.geomspace(1.0, 0.005, 200))
    y = (x[:, :40].sum(axis=1) + 2 * rng.normal(size=600) > 0).astype(int)
    rows = [(Vectors.sparse(200, np.flatnonzero(v), v[v != 0]), int(t), 0) for v, t in zip(x, y)]
    fit = logistic.fit_folds(spark.createDataFrame(rows, ROWS), 200, [1], c=400.0, max_iter=2000)[0]
    assert len(fit.history) <= 170


def test_shares_of_a_forest_are_even_and_hold_every_row(spark):
    uneven = spark.range(0, 4000, numPartitions=1).union(spark.range(4000, 4007, numPartitions=1))
    shares = model.even(uneven).rdd.mapPartitions(lambda rows: [sorted(r.id for r in rows)]).collect()
    assert sorted(sum(shares, [])) == list(range(4007))
    assert len(shares) == spark.sparkContext.defaultParallelism and max(map(len, shares)) - min(map(len, shares)) <= 2


def test_one_class_and_no_rows(spark):
    _, _, rows = vectors(spark, 30)
    ones = logistic.fit_folds(rows.where("y = 1"), 6, [0], c=4.0, max_iter=50)[0]
    assert ones.intercept > 0 and np.isfinite(ones.coefficients).all()


def test_rows_are_bounded_and_dealt_out(spark, mail):
    n = mail.count()
    few = model.learned_rows(mail, max_rows=50)
    assert 40 <= few.count() <= 50 and model.learned_rows(mail, max_rows=n).count() == n
    sizes = [r["count"] for r in few.groupBy("fold", "y").count().collect()]
    assert len(sizes) == 6 and few.rdd.getNumPartitions() > 1


def test_a_model_learns_from_every_mail(spark):
    """More mails than the 200 000 that a fit used to stop at."""
    n = 200_500
    mails = spark.range(n).selectExpr("id AS mail_id", "CAST(id % 2 AS INT) AS label")
    learned = model.learned_rows(mails)
    assert learned.select("mail_id").distinct().count() == learned.count() == n
    assert {(r.fold, r.y) for r in learned.groupBy("fold", "y").count().collect() if abs(r["count"] - n / 6) <= 1} == {(k, y) for k in range(3) for y in (0, 1)}


def test_design_matrix_holds_its_blocks_in_order(mail, space, rows):
    got = space.transform(mail, ("mail_id",)).where("mail_id = 7").first()
    assert got.x.size == space.width == len(FEATURES) + len(space.texts["word"].terms)
    word = got.x.toArray()[len(FEATURES):]
    assert math.isclose(float(word @ word), 1.0, rel_tol=1e-9)


@pytest.mark.parametrize("position", range(3))
def test_calibration_is_the_sigmoid_of_the_fold_left_out(table, models, position):
    """The slope and intercept minimise the log loss against smoothed targets."""
    kind, (member, slope, intercept) = models[position].kind, models[position].members[0]
    held = model.with_margins(table.where("fold = 0"), kind, [member]).select("y", F.col("margins")[0].alias("m")).collect()
    m, y = np.array([r.m for r in held]), np.array([r.y for r in held])
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    error = 1 / (1 + np.exp(-(slope * m + intercept))) - target
    scale = np.abs(m).mean()
    assert abs(error.mean()) < 2e-3 and abs((error * m).mean()) < 2e-3 * max(scale, 1)


@pytest.mark.parametrize("position", range(3))
def test_scores_survive_save_and_load(spark, table, models, position, tmp_path):
    path = str(tmp_path / "m")
    models[position].save(spark, path)
    again = model.CalibratedModel.load(spark, path)
    assert again.history == models[position].history and again.space.width == models[position].space.width
    key = lambda m: sorted((r.mail_id, r.score) for r in m.score_vectors(table).collect())
    assert key(models[position]) == key(again)


def test_a_torn_save_is_refused(spark, models, tmp_path, monkeypatch):
    path = str(tmp_path / "torn")
    monkeypatch.setattr(model, "json", SimpleNamespace(dumps=lambda _: 1 / 0, loads=json.loads))
    with pytest.raises(ZeroDivisionError):
        models[0].save(spark, path)
    with pytest.raises(ValueError, match="no published model"):
        model.CalibratedModel.load(spark, path)


def test_exported_weights_are_the_mean_of_the_folds(models, space):
    scorer = models[0].linear_scorer()
    mean = np.mean([m.coefficients for m, _, _ in models[0].members], axis=0)
    assert math.isclose(scorer.tab["url_count"][0], mean[0])
    term = space.texts["word"].terms[3]
    assert math.isclose(scorer.terms[term][0], mean[len(FEATURES) + 3])


def test_the_best_model_is_chosen(spark, mail):
    specs = [model.ModelSpec("rf", trees=2), model.ModelSpec("logreg")]
    report = model.compare_models(mail, mail, specs, ("tab",)).collect()
    f1 = {r.model: r.value for r in report if r.metric == "f1" and r.label_kind == "noisy"}
    best = max(("rf", "logreg"), key=lambda k: f1[k])
    assert {r.model for r in report if r.chosen} == {best} and len(report) == 24
