"""Streams that meet copies, late rows and restarts; documents; any scorer."""

import json
import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lurewatch.functions import lexicon_scan
from lurewatch import lexicons as lex
from lurewatch.operators import documents, evaluate, explain, model, robustness, scoring, trend
from lurewatch.schema import FEATURES, MAIL_COLUMNS
from lurewatch.sources import reports, weights
from lurewatch.streaming import jobs

DAY = datetime(2024, 3, 1)


def put(spark, folder, number, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{folder}/in_{number}")


def times(spark, folder):
    return spark.readStream.schema("received_at timestamp, score double").json(f"{folder}/in_*")


def test_windows_close_behind_the_watermark_and_survive_a_restart(spark, tmp_path):
    schema = "received_at timestamp, score double"
    scores = [(DAY + timedelta(hours=h), (h % 10) / 10) for h in range(0, 96, 3)]
    baseline = jobs.baseline_histogram(spark.createDataFrame(scores[:8], schema))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        jobs.start_drift(times(spark, tmp_path), baseline, out, checkpoint, late="1 day").awaitTermination()

    put(spark, tmp_path, 0, scores, schema)
    run()
    late = [(DAY + timedelta(hours=73), 0.95)]  # day 3 is still open
    too_late = [(DAY + timedelta(hours=1), 0.95)] * 3
    put(spark, tmp_path, 1, late + too_late, schema)
    run()
    put(spark, tmp_path, 2, [(DAY + timedelta(days=9), 0.5)], schema)
    run()
    put(spark, tmp_path, 3, [(DAY + timedelta(days=9, hours=1), 0.5)], schema)
    run()
    def rounded(table):
        return {r.window_start: [round(v, 9) if isinstance(v, float) else v for v in r] for r in table.collect()}

    got = rounded(spark.read.parquet(out))
    whole = jobs.population_stability(jobs.drift_windows(spark.createDataFrame(scores + late, schema)), baseline)
    assert got == rounded(whole) and sorted(got) == [DAY + timedelta(days=d) for d in range(4)]


def test_stability_index(spark):
    rows = spark.createDataFrame([(DAY, s) for s in [0.05] * 6 + [0.95] * 2], "received_at timestamp, score double")
    base = jobs.baseline_histogram(spark.createDataFrame([(0.05,), (0.95,), (1.0,), (0.0,)], "score double"))
    assert {r.bin: r.share for r in base.collect() if r.share} == {0: 0.5, 9: 0.5}
    psi = jobs.population_stability(jobs.drift_windows(rows), base).first().psi
    assert math.isclose(psi, 0.25 * math.log(1.5) + -0.25 * math.log(0.5), rel_tol=1e-9)
    empty = jobs.baseline_histogram(rows.where("false").select("score"))
    assert [r.share for r in empty.collect()] == [0.0] * 10


def test_a_payload_delivered_twice_is_scored_once(spark, mail, tmp_path):
    payload = mail.select(*MAIL_COLUMNS).limit(20).withColumn("received_at", F.lit(DAY)).cache()
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    payload.union(payload.limit(5)).coalesce(1).write.json(str(folder / "a"))
    scorer = weights.LinearScorer()

    def run():
        stream = jobs.mail_stream(spark, f"{folder}/*")
        jobs.start_scoring(stream, scorer, out, checkpoint, late="2 days").awaitTermination()

    run()
    payload.limit(7).withColumn("received_at", F.lit(DAY + timedelta(hours=2))).write.json(str(folder / "b"))
    run()
    got = spark.read.parquet(out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, jobs.scored_stream(payload, scorer).collect()))


def test_a_batch_that_runs_again_leaves_one_copy(spark, mail, tmp_path):
    payload = mail.select(*MAIL_COLUMNS).limit(10)
    payload.write.json(str(tmp_path / "in"))
    for checkpoint in ("one", "two"):  # a lost checkpoint runs batch 0 again
        stream = jobs.mail_stream(spark, str(tmp_path / "in"))
        jobs.start_scoring(stream, weights.LinearScorer(), str(tmp_path / "out"), str(tmp_path / checkpoint)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


@pytest.fixture(scope="module")
def fitted(spark, mail):
    rows = model.learned_rows(mail)
    space = model.DesignSpace.fit(rows, ("tab", "word"))
    return model.fit_all(model.fit_vectors(rows, space), space, [model.ModelSpec(), model.ModelSpec("rf", trees=4)])


@pytest.mark.parametrize("position", [0, 1])
def test_a_fitted_model_serves_robustness_reasons_and_streams(spark, mail, fitted, position, tmp_path):
    scorer = fitted[position]
    some = mail.where("mail_id between 0 and 40")
    plain = {r.mail_id: r.score for r in scorer.score_mail(some).collect()}
    got = {r.mail_id: r for r in explain.explain_mail(some, scorer).collect()}
    assert set(got) == set(plain) and all(abs(got[k].score - plain[k]) < 1e-4 for k in plain)
    feats = {r.mail_id: r for r in scorer.score_features(some).collect()}
    for k, r in got.items():
        if position == 0:
            # attributions are the mean over the folds
            for reason in r.reasons:
                i = FEATURES.index(reason.feature)
                mean, scale = scorer.space.scaler[reason.feature]
                each = [m.coefficients[i] * (feats[k][reason.feature] - mean) / scale for m, _, _ in scorer.members]
                assert math.isclose(reason.weight, sum(each) / len(each), abs_tol=1e-9)
        else:
            assert all(feats[k][reason.feature] != 0 for reason in r.reasons) and not r.protective
    matrix = robustness.robustness_matrix(some, scorer, ["leetspeak", "url_obfuscation"]).collect()
    n = sum(s >= 0.7 for s in plain.values())
    assert len(matrix) == 2 and all(r.n == n for r in matrix)
    batch = jobs.scored_stream(some, scorer)
    some.select(*MAIL_COLUMNS).write.json(str(tmp_path / "in"))
    stream = jobs.mail_stream(spark, str(tmp_path / "in"))
    jobs.start_scoring(stream, scorer, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))


def test_metrics_document(spark, mail, tmp_path):
    keep = ("mail_id", "label", "noisy_label", "family")
    scored = scoring.linear_score(mail, weights.LinearScorer(), keep).select(*keep, "score").cache()
    worse = scored.withColumn("score", 1 - F.col("score"))
    gains = spark.createDataFrame([(f, 1.0 / (i + 1)) for i, f in enumerate(FEATURES)], "feature string, importance double")
    reports.write_report(documents.metrics_document(mail, mail, {"worse": worse, "logreg": scored}, gains), str(tmp_path / "m"))
    text = [line for f in (tmp_path / "m").glob("part-*") for line in f.read_text().splitlines()]
    got = json.loads(text[0])
    assert len(text) == 1 and got["best_model"] == "logreg" and got["dataset"]["total"] == 2 * mail.count()
    flat = {r.label_kind: r for r in evaluate.binary_metrics(scored).collect()}
    assert math.isclose(got["models"]["logreg"]["f1"], flat["noisy"].f1) and math.isclose(got["intrinsic_clean"]["logreg"]["brier"], flat["clean"].brier)
    assert got["models"]["logreg"]["confusion_matrix"] == [[flat["noisy"].tn, flat["noisy"].fp], [flat["noisy"].fn, flat["noisy"].tp]]
    families = {r.family: r for r in evaluate.family_report(scored).collect()}
    assert {f: v["n"] for f, v in got["models"]["logreg"]["per_family"].items()} == {f: r.n for f, r in families.items()}
    assert len(got["feature_importance_top"]) == 15 and reports.read_report(spark, str(tmp_path / "m")).count() == 1


def test_robustness_and_forecast_documents(spark, tmp_path):
    matrix = spark.createDataFrame(
        [("b", 1.0, 0.5, 0.9, 0.5, 0.4, 8), ("a", 1.0, 0.25, 0.25, 0.75, 0.0, 8)],
        "variant string, detection_clean double, detection_attacked double, detection_defended double, drop double, recovered double, n long",
    )
    baseline = spark.createDataFrame([(0.98765, 8, 0.7)], "baseline_detection double, n_detected long, threshold double")
    got = json.loads(documents.robustness_document(baseline, matrix).toJSON().first())
    assert (got["baseline_detection"], got["n_phishing_detected"], got["threshold"]) == (0.988, 8, 0.7)
    assert [a["attack"] for a in got["attacks"]] == ["a", "b"] and got["attacks"][1]["recovered"] == 0.4
    history = spark.createDataFrame([("homoglyph", p, 0.1 * p, 5) for p in (1, 2, 3)], "technique string, period int, prevalence double, n long")
    series = trend.technique_forecast(history)
    reports.write_report(documents.forecast_document(series, baseline, matrix), str(tmp_path / "f"))
    back = reports.read_report(spark, str(tmp_path / "f")).first()
    assert back.projections[0].technique == "homoglyph" and len(back.future_robustness.variants) == 2
    flat = {str(r.period): r.prevalence for r in series.where("kind = 'forecast'").collect()}
    assert back.projections[0].forecast.asDict() == flat and len(flat) == 3


def test_a_lexicon_table_decides_what_is_counted(spark):
    mail = spark.createDataFrame([(1, "Urgent", "cvcvc aa"), (2, "", "URGENT urgent ümlaut"), (3, "x", "")], "mail_id long, subject string, body string")
    table = spark.createDataFrame([("mine", 0, "urgent", "urgent"), ("mine", 1, "cvc", "cvc"), ("other", 0, "aa", "aa"), ("two", 0, "urgent", "urgent")],
                                  "kind string, pos int, term string, term_norm string")
    got = sorted(map(tuple, lexicon_scan.coverage(mail, table, ("mine", "two")).collect()))
    assert got == [("mine", "cvc", 1, 1), ("mine", "urgent", 2, 3), ("two", "urgent", 2, 3)]
    assert lexicon_scan.coverage(mail, table, ("none",)).collect() == []
    assert {r.kind for r in lex.lexicon_dim(spark).select("kind").distinct().collect()} >= set(lex.FOLDED)
