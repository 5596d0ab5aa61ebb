"""Ranked reasons, protective factors, rule fallback and the full explanation record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lurewatch import lexicons as lex
from lurewatch.functions.text import clean_text, full_text
from lurewatch.operators import highlight
from lurewatch.operators.scoring import attribution_array, Scorer, score_mail, strongest_terms, triage
from lurewatch.schema import FEATURES
from lurewatch.sources.weights import LinearScorer

#: Contributions at or below this size explain nothing.
MIN_CONTRIBUTION = 0.05
_LABELLED = [f for f in FEATURES if f in lex.HUMAN_LABELS]


def _text_map(texts: dict[str, str]) -> Column:
    return F.map_from_arrays(
        F.split(F.lit("\x01".join(texts)), "\x01"),
        F.split(F.lit("\x01".join(texts.values())), "\x01"),
    )


def _ranked(phi: Column) -> Column:
    """Labelled attributions, largest first, ties in feature order."""
    labelled = F.filter(phi, lambda p: p["feature"].isin(*_LABELLED))
    keyed = F.transform(
        labelled,
        lambda p: F.struct(
            (-F.round(p["phi"], 9)).alias("o"), p["feature_idx"], p["feature"], p["phi"]
        ),
    )
    return F.sort_array(keyed)


def reasons(phi: Column, limit: int = 6) -> Column:
    """Up to ``limit`` factors that raise the risk, strongest first."""
    labels = _text_map(lex.HUMAN_LABELS)
    up = F.slice(F.filter(_ranked(phi), lambda p: p["phi"] > MIN_CONTRIBUTION), 1, limit)
    return F.transform(
        up,
        lambda p: F.struct(
            p["feature"].alias("feature"),
            F.element_at(labels, p["feature"]).alias("text"),
            p["phi"].alias("weight"),
            F.lit("augmente").alias("direction"),
        ),
    )


def protective(phi: Column, limit: int = 3) -> Column:
    """First ``limit`` lowering factors of the same descending order: the weakest ones."""
    texts = _text_map(
        {f: lex.PROTECTIVE_TEXTS.get(f, lex.PROTECTIVE_DEFAULT + f) for f in _LABELLED}
    )
    down = F.slice(F.filter(_ranked(phi), lambda p: p["phi"] < -MIN_CONTRIBUTION), 1, limit)
    return F.transform(
        down,
        lambda p: F.struct(
            p["feature"].alias("feature"),
            F.element_at(texts, p["feature"]).alias("text"),
            p["phi"].alias("weight"),
            F.lit("diminue").alias("direction"),
        ),
    )


def rule_reasons(limit: int = 6) -> Column:
    """Without a linear model: the first ``limit`` active labelled features."""
    active = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.lit(lex.HUMAN_LABELS[f]).alias("text"),
                F.col(f).alias("weight"),
                F.lit("augmente").alias("direction"),
            )
            for f in _LABELLED
        ]
    )
    return F.slice(F.filter(active, lambda r: r["weight"] != 0), 1, limit)


def summary(score: Column, label: Column, why: Column) -> Column:
    """Verdict sentence with the two strongest reasons."""
    pct = F.bround(score * 100).cast("int").cast("string")
    head = (
        F.when(
            label == "phishing",
            F.concat(
                F.lit("⚠️ Risque élevé ("), pct,
                F.lit("%) - ce message présente plusieurs signaux d'attaque."),
            ),
        )
        .when(
            label == "suspect",
            F.concat(
                F.lit("Prudence ("), pct,
                F.lit("%) - ce message présente des éléments ambigus."),
            ),
        )
        .otherwise(
            F.concat(
                F.lit("Risque faible ("), pct,
                F.lit("%) - aucun signal fort de phishing détecté."),
            )
        )
    )
    first = F.array_join(F.transform(F.slice(why, 1, 2), lambda r: r["text"]), " ; ")
    tail = F.concat(F.lit(" Principaux signaux : "), first, F.lit("."))
    return F.concat(head, F.when(F.size(why) > 0, tail).otherwise(F.lit("")))


def explain_reasons(features: DataFrame, scorer: LinearScorer) -> DataFrame:
    """Risk-raising reasons as rows ``(mail_id, rank, feature, text, weight, direction)``."""
    return _as_rows(features.select("mail_id", reasons(attribution_array(scorer)).alias("r")))


def explain_protective(features: DataFrame, scorer: LinearScorer) -> DataFrame:
    return _as_rows(features.select("mail_id", protective(attribution_array(scorer)).alias("r")))


def explain_rules(features: DataFrame) -> DataFrame:
    return _as_rows(features.select("mail_id", rule_reasons().alias("r")))


def _as_rows(df: DataFrame) -> DataFrame:
    # Outer + not-null: an inner explode would evaluate the array a second time as a filter.
    rows = df.select("mail_id", F.posexplode_outer("r").alias("pos", "x"))
    return rows.where(F.col("x").isNotNull()).select("mail_id", (F.col("pos") + 1).alias("rank"), "x.*")


def explain_mail(
    mail: DataFrame, scorer: Scorer, keep: tuple[str, ...] = ("mail_id",)
) -> DataFrame:
    """One record per mail: ``keep``, score, verdict, summary, reasons and protective factors.

    Attributions of a fitted linear model are those of its fold-averaged coefficients.
    Ensembles have none: the active features are the reasons, and nothing protects.
    """
    linear = scorer if isinstance(scorer, LinearScorer) else scorer.linear_scorer() if scorer.kind == "logreg" else None
    scored = triage(score_mail(mail, scorer, keep), scorer)
    if linear is None:
        why = rule_reasons()
        eased = F.slice(why, 1, 0)
    else:
        scored = scored.withColumn("_phi", attribution_array(linear))
        why, eased = reasons(F.col("_phi")), protective(F.col("_phi"))
    parts = scored.select(*keep, "score", F.col("verdict").alias("label"), why.alias("reasons"), eased.alias("protective"))
    text = summary(F.col("score"), F.col("label"), F.col("reasons"))
    return parts.select(
        *keep, F.round("score", 4).alias("score"), "label", text.alias("summary"),
        "reasons", "protective",
    )


def analyze_mail(mail: DataFrame, scorer: LinearScorer, terms: int = 8) -> DataFrame:
    """The whole record of a mail in one row, without a shuffle.

    Score, verdict, summary, reasons, protective factors, highlights in order, and
    the ``terms`` strongest terms of the scorer with their contributions.
    """
    wide = mail.select(
        "*", highlight.highlight_array(full_text()).alias("highlights"),
        strongest_terms(scorer, clean_text(full_text()), terms).alias("nlp_terms"),
    )
    return explain_mail(wide, scorer, ("mail_id", "highlights", "nlp_terms")).select(
        "mail_id", "score", "label", "summary", "reasons", "protective", "highlights", "nlp_terms"
    )
