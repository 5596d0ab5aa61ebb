"""Whole jobs: golden tables, invariants, sources and sinks, streaming against batch."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lurewatch.operators import (
    campaign, evaluate, explain, features, highlight, perturb, robustness, sampling,
    scoring, trend,
)
from lurewatch.schema import FEATURES, MAIL_COLUMNS
from lurewatch.sources import mail as sources, reports, weights
from lurewatch.streaming import jobs


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# Prevalence of techniques by year, from 2019 on.
HISTORY = {
    "url_shortener": [0.20, 0.27, 0.33, 0.38, 0.42, 0.45, 0.47],
    "lookalike_domain": [0.35, 0.40, 0.46, 0.52, 0.57, 0.61, 0.64],
    "homoglyph": [0.05, 0.08, 0.12, 0.18, 0.24, 0.30, 0.35],
    "ai_polished": [0.02, 0.03, 0.05, 0.10, 0.22, 0.38, 0.52],
    "qr_code": [0.01, 0.02, 0.04, 0.09, 0.17, 0.27, 0.36],
    "mfa_bypass": [0.02, 0.04, 0.08, 0.14, 0.22, 0.31, 0.40],
}
# Levers of the scenarios.
SCENARIOS = {
    "facture": ["urgence", "autorite", "peur_financiere"],
    "reinit_mdp": ["urgence", "autorite", "peur"],
    "rh_paie": ["autorite", "appat_financier"],
    "livraison": ["curiosite", "urgence", "preuve_sociale"],
    "compte_bloque": ["peur", "urgence", "autorite"],
    "fraude_president": ["autorite", "urgence", "confidentialite"],
    "gain_loterie": ["appat_financier", "urgence"],
    "support_it": ["autorite", "serviabilite"],
}


def test_forecast_golden(spark):
    series = [(t, 2019 + i, v) for t, vs in HISTORY.items() for i, v in enumerate(vs)]
    history = spark.createDataFrame(series, "technique string, period int, prevalence double")
    got = trend.technique_forecast(history, 2028)
    assert rows(trend.technique_forecast(history)) == rows(got)
    table = {
        (r.technique, r.period): r.prevalence for r in got.collect() if r.kind == "forecast"
    }
    want = {
        "ai_polished": (0.670, 0.788, 0.862), "homoglyph": (0.477, 0.570, 0.656),
        "lookalike_domain": (0.696, 0.734, 0.768), "mfa_bypass": (0.582, 0.703, 0.796),
        "qr_code": (0.571, 0.715, 0.816), "url_shortener": (0.552, 0.600, 0.646),
    }
    for name, values in want.items():
        assert [table[name, y] for y in (2026, 2027, 2028)] == list(values)
    assert {r.direction for r in trend.trend_direction(got).collect()} == {"up"}


def test_campaign_golden(spark):
    levers = spark.createDataFrame(list(SCENARIOS.items()), "scenario string, levers array<string>")
    got = {(r.scenario, r.training): r for r in campaign.campaign_risk(levers).collect()}
    base = {
        "facture": 0.533, "compte_bloque": 0.518, "livraison": 0.413, "rh_paie": 0.365,
        "gain_loterie": 0.346, "support_it": 0.317,
    }
    for name, rate in base.items():
        assert round(got[name, "aucune"].base_rate, 3) == rate
    assert round(got["facture", "simulations_repetees"].adjusted_rate, 3) == 0.096


def test_attributions_sum_to_the_tabular_logit(mail):
    feats, scorer = features.mail_features(mail), weights.LinearScorer()
    total = scoring.attributions(feats, scorer).groupBy("mail_id").agg(F.sum("phi").alias("s"))
    both = feats.withColumn("l", scoring.tabular_logit(scorer)).join(total, "mail_id")
    assert both.where(F.abs(F.col("s") - F.col("l")) > 1e-9).count() == 0


def test_result_does_not_depend_on_partitions(mail):
    one = perturb.perturb_mail(mail.repartition(1), "composite_2026").select("mail_id", "body")
    many = perturb.perturb_mail(mail.repartition(13), "composite_2026").select("mail_id", "body")
    assert rows(one) == rows(many)


def test_split_folds_noise_are_exact(mail):
    labels = mail.select("mail_id", "label")
    n = labels.groupBy("label").count().collect()
    split = sampling.stratified_split(labels)
    for r in n:
        test = split.where((F.col("label") == r.label) & (F.col("split") == "test")).count()
        assert test == -(-r["count"] // 4)
    assert sampling.inject_label_noise(labels).where("label <> noisy_label").count() == 6
    sizes = [r["count"] for r in sampling.kfold_assign(labels).groupBy("label", "fold").count().collect()]
    assert len(sizes) == 6 and sum(sizes) == labels.count()
    skew = labels.withColumn("label", F.lit(1))
    assert sampling.stratified_split(skew).where("split = 'test'").count() == -(-labels.count() // 4)


def test_ranking_against_brute_force(spark):
    pairs = [(i, (i * 7919 % 37) / 37.0, int(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(pairs, "mail_id long, score double, label int")
    pos, neg = ([s for _, s, y in pairs if y == k] for k in (1, 0))
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    got = evaluate.ranking_metrics(df).first()
    assert abs(got.roc_auc - auc) < 1e-12
    monotone = evaluate.ranking_metrics(df.withColumn("score", F.pow("score", 3))).first()
    assert abs(monotone.roc_auc - auc) < 1e-12
    assert sum(r.n for r in evaluate.calibration_bins(df).collect()) == 300


def test_csv_round_trip_and_defaults(spark, mail, tmp_path):
    sources.write_mail_csv(mail, str(tmp_path / "c"))
    back = sources.read_mail(spark, str(tmp_path / "c"))
    cols = ["subject", "body", "sender_email", "spf", "attachments", "has_html", "label", "family"]
    assert rows(back.select(*cols)) == rows(mail.select(*cols))
    (tmp_path / "d.csv").write_text("subject,body\nhi,\n")
    payload = tmp_path / "p.json"
    payload.write_text(json.dumps({"subject": "x", "num_recipients": 0}) + "\n")
    r = sources.read_mail_json(spark, str(payload)).first()
    assert (r.body, r.spf, r.attachments, r.has_html, r.num_recipients) == ("", "none", [], False, 1)


def test_deployed_scorer_holds_every_exported_term(spark):
    scorer = weights.LinearScorer()
    assert len(scorer.terms) == 400
    # light terms too: a mail of one of them is scored with it, once and twice
    got = spark.createDataFrame([(0, "martin"), (1, "martin et martin"), (2, "personne")], "i int, t string")
    logits = [r[1] for r in sorted(got.select("i", scoring.term_logit(scorer, F.col("t"))).collect())]
    w, idf = -0.300751189423982, 6.704085459054823
    assert logits[0] == pytest.approx(w * idf)
    assert logits[1] == pytest.approx(w * idf * 1.6931471805599454)
    assert logits[2] == 0


def test_registered_fits_are_full_size(spark, monkeypatch):
    """The queries fit all blocks at the sizes of ModelSpec."""
    from inspect import signature

    from conftest import SF
    from lurewatch.operators import model
    from lurewatch.plans.catalog import CATALOG

    seen = {}

    def noted(fn):
        def run(*args, **named):
            bound = signature(fn).bind(*args, **named)
            bound.apply_defaults()
            seen.update(bound.arguments)
            raise InterruptedError

        return run

    for name in ("train", "compare_models", "feature_importance"):
        monkeypatch.setattr(model, name, noted(getattr(model, name)))
    for query in ("fit_calibrated", "export_weights", "compare_models", "feature_importance"):
        seen.clear()
        with pytest.raises(InterruptedError):
            CATALOG[query][0](spark, SF)
        assert seen.get("blocks", model.ALL_BLOCKS) == ("tab", "word", "char")
        assert seen.get("trees", 250) == 250
        specs = seen.get("specs") or [seen.get("spec", model.ModelSpec())]
        assert all((s.trees, s.rounds, s.max_iter) == (300, 400, 2000) for s in specs)


def test_reports_and_weights_round_trip(spark, tmp_path):
    scorer = weights.LinearScorer()
    weights.write_scorer(spark, scorer, str(tmp_path / "w"))
    assert weights.read_scorer(spark, str(tmp_path / "w")) == scorer
    report = spark.createDataFrame([("a", 0.5)], "model string, f1 double")
    reports.write_report(report, str(tmp_path / "r"))
    assert rows(reports.read_report(spark, str(tmp_path / "r"))) == [(0.5, "a")]
    with pytest.raises(AnalysisException):
        reports.read_report(spark, str(tmp_path / "missing"))


def test_empty_input(mail):
    none = mail.where("false")
    scorer = weights.LinearScorer()
    assert features.mail_features(none).count() == 0
    assert highlight.highlight_spans(none).count() == 0
    matrix = robustness.robustness_matrix(none, scorer, ["leetspeak"]).first()
    assert (matrix.n, matrix.detection_attacked, matrix.detection_clean) == (0, 0.0, 1.0)


def test_highlight_offsets_point_at_their_text(mail):
    spans = highlight.highlight_spans(mail).join(mail, "mail_id")
    text = F.concat("subject", F.lit("\n"), "body")
    cut = F.substring(text, F.col("start") + 1, F.col("end") - F.col("start"))
    assert spans.where(cut != F.col("snippet")).count() == 0
    assert {r.kind for r in spans.select("kind").distinct().collect()} >= {"url", "urgency", "homoglyph"}


def test_highlights_are_whole_and_in_order(spark):
    """Characters that fold to none or several keep later spans in place."""
    body = "urgent\u2026 \ufb01n e\u0301t\u00e9: Confirmez, cli\u0301ck http://a.tk now urg\u0065\u0301nt"
    mail = spark.createDataFrame([(1, "\ufb01n", body)], "mail_id long, subject string, body string")
    got = highlight.highlight_spans(mail).orderBy("pos").collect()
    text = "\ufb01n\n" + body
    assert [r.pos for r in got] == list(range(1, len(got) + 1))
    assert [(r.start, -r.end) for r in got] == sorted((r.start, -r.end) for r in got)
    assert all(text[r.start : r.end] == r.snippet for r in got)
    found = {r.snippet for r in got}
    assert {"urgent", "now", "urg\u0065\u0301nt", "http://a.tk"} <= found


def test_explanations(mail):
    got = explain.explain_mail(mail, weights.LinearScorer()).collect()
    for r in got:
        assert len(r.reasons) <= 6 and len(r.protective) <= 3
        assert [x.weight for x in r.reasons] == sorted((x.weight for x in r.reasons), reverse=True)
        assert all(x.weight < -0.05 for x in r.protective)


def test_stream_equals_batch(spark, mail, tmp_path):
    payload = mail.select(*MAIL_COLUMNS)
    payload.write.json(str(tmp_path / "in"))
    scorer = weights.LinearScorer()
    stream = jobs.mail_stream(spark, str(tmp_path / "in"))
    query = jobs.start_scoring(stream, scorer, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    batch = jobs.scored_stream(mail, scorer)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch)


def test_equal_mails_keep_their_rows(spark, tmp_path):
    row = '"hi","same",,,,,,,,0,1,{},"account"\n'
    head = "subject,body,sender_display,sender_email,reply_to,spf,dkim,dmarc,attachments,has_html,num_recipients,label,family\n"
    (tmp_path / "c.csv").write_text(head + "".join(row.format(x) for x in ("1", "1.0", " 1e0 ", "", "0.0")) + row.format("1") * 7)
    mail = sources.read_mail(spark, str(tmp_path / "c.csv")).cache()
    assert mail.count() == mail.select("mail_id").distinct().count() == 12
    assert mail.where("label = 1").count() == 10
    assert sampling.stratified_split(mail).count() == sampling.kfold_assign(mail).count() == 12
    (tmp_path / "bad.csv").write_text(head + row.format("spam"))
    with pytest.raises(Exception, match="unreadable label"):
        sources.read_mail(spark, str(tmp_path / "bad.csv")).collect()


def test_whole_record_of_a_mail(mail):
    scorer = weights.LinearScorer()
    got = {r.mail_id: r for r in explain.analyze_mail(mail, scorer).collect()}
    plain = {r.mail_id: r for r in explain.explain_mail(mail, scorer).collect()}
    spans = highlight.highlight_spans(mail).groupBy("mail_id").count().collect()
    assert set(got) == set(plain)
    assert all((got[k].score, got[k].summary, got[k].reasons) == (plain[k].score, plain[k].summary, plain[k].reasons) for k in got)
    assert all(len(got[r.mail_id].highlights) == r["count"] for r in spans)
    for r in got.values():
        assert len(r.nlp_terms) <= 8
        assert [abs(t.weight) for t in r.nlp_terms] == sorted((abs(t.weight) for t in r.nlp_terms), reverse=True)
