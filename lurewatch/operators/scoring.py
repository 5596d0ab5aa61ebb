"""Scoring with a linear scorer, verdicts, and exact per-feature attributions.

A fitted scorer is thirty numbers plus at most 400 terms, so it travels as
literals: scoring a table of mails is one map-only pass.
"""

from __future__ import annotations

from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lurewatch.functions.grams import Vocabulary
from lurewatch.functions.lexicon_scan import longest_of
from lurewatch.functions.plan import let, pinned
from lurewatch.functions.text import clean_text, full_text
from lurewatch.operators.features import mail_features
from lurewatch.operators.textvec import words
from lurewatch.schema import FEATURES, PHISH_THRESHOLD, SUSPECT_THRESHOLD
from lurewatch.sources.weights import LinearScorer


def fit_scaler(features: DataFrame) -> DataFrame:
    """Mean and population deviation of every feature; constant columns scale by 1."""
    row = features.agg(
        *[F.avg(f).alias(f"m_{f}") for f in FEATURES],
        *[F.stddev_pop(f).alias(f"s_{f}") for f in FEATURES],
    )
    entries = [
        F.struct(
            F.lit(i).alias("feature_idx"),
            F.lit(f).alias("feature"),
            F.col(f"m_{f}").alias("mean"),
            F.when(F.col(f"s_{f}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{f}")).alias("scale"),
        )
        for i, f in enumerate(FEATURES)
    ]
    return row.select(F.inline(F.array(*entries)))


def fitted_scorer(features: DataFrame, base: LinearScorer | None = None) -> LinearScorer:
    """Scorer whose tabular block is standardised on ``features`` (thirty rows come back)."""
    scaler = {r["feature"]: (r["mean"], r["scale"]) for r in fit_scaler(features).collect()}
    return (base or LinearScorer()).with_scaler(scaler)


def contribution(scorer: LinearScorer, feature: str) -> Column:
    """coef * (x - mean) / scale."""
    coef, mean, scale = scorer.tab[feature]
    return F.lit(coef) * ((F.col(feature) - F.lit(mean)) / F.lit(scale))


def tabular_logit(scorer: LinearScorer) -> Column:
    total = F.lit(0.0)
    for f in FEATURES:
        total = total + contribution(scorer, f)
    return total


def _known_terms(scorer: LinearScorer, clean: Column) -> Column:
    """The text's occurrences of the scorer's terms, one- and two-word ones.

    One pattern stops at words that a term begins and tells the longest; no other word or
    pair is built. A pair's first word counts too if it is a term.
    """
    terms = list(scorer.terms)
    hits = F.regexp_extract_all(
        F.array_join(words(clean), " "), F.lit(f"(?<![^ ])(?=({longest_of(terms)})(?![^ ]))"), F.lit(1)
    )
    begun = [t for t in terms if " " in t and t.split(" ")[0] in scorer.terms]
    if not begun:
        return hits
    return let(hits, lambda found: F.concat(
        found, F.transform(F.filter(found, lambda t: t.isin(*begun)), lambda t: F.substring_index(t, " ", 1))
    ))


def _term_value(scorer: LinearScorer, known: Column):
    """term -> weight * idf * (1 + ln tf), counted among ``known``."""
    value = {t: w * idf for t, (w, idf) in scorer.terms.items()}
    table = F.map_from_arrays(
        F.split(F.lit("\x01".join(value)), "\x01"),
        F.split(F.lit(",".join(map(repr, value.values()))), ",").cast("array<double>"),
    )
    return lambda term: F.element_at(table, term) * (
        1 + F.log(F.size(F.filter(known, lambda other: other == term)).cast("double"))
    )


def term_logit(scorer: LinearScorer, clean: Column) -> Column:
    """Sum of weight * idf * (1 + ln tf) over the scorer's terms present in the text.

    An approximation by design: no character block, no length normalisation.
    """
    if not scorer.terms:
        return F.lit(0.0)

    known = Vocabulary("word", tuple(scorer.terms))
    value = np.array([w * idf for w, idf in scorer.terms.values()])

    @F.arrow_udf("double")
    def total(texts: pa.Array) -> pa.Array:
        row, term, count = known.counts(texts)
        sums = np.bincount(row, weights=value[term] * (1 + np.log(count)), minlength=len(texts))
        return pa.array(sums, mask=texts.is_null().to_numpy(zero_copy_only=False))

    return total(clean)


def strongest_terms(scorer: LinearScorer, clean: Column, n: int = 8) -> Column:
    """The ``n`` terms of the text that weigh most either way: array of (term, weight)."""
    kind = "array<struct<term:string,weight:double>>"
    if not scorer.terms:
        return F.array().cast(kind)

    def ranked(known):
        value = _term_value(scorer, known)
        weighed = F.transform(
            F.array_distinct(known),
            lambda t: let(F.round(value(t), 9), lambda v: F.struct((-F.abs(v)).alias("k"), t.alias("term"), v.alias("weight"))),
        )
        top = F.slice(F.array_sort(weighed), 1, n)
        return F.transform(top, lambda x: F.struct(x["term"].alias("term"), x["weight"].alias("weight")))

    return let(_known_terms(scorer, clean), ranked).cast(kind)


def sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def verdict(
    score: Column, phish: float = PHISH_THRESHOLD, suspect: float = SUSPECT_THRESHOLD
) -> Column:
    return (
        F.when(score >= phish, "phishing").when(score >= suspect, "suspect").otherwise("benin")
    )


def uncertainty_band(score: Column, low: float = 0.35, high: float = 0.65) -> Column:
    return F.when(score.between(low, high), "incertain").otherwise("confiant")


def linear_score(
    mail: DataFrame, scorer: LinearScorer, keep: tuple[str, ...] = ("mail_id",)
) -> DataFrame:
    """``keep`` + thirty features + ``logit`` and ``score``, in one pass over the mails."""
    wide = mail.withColumn("_clean", clean_text(full_text()))
    terms = mail_features(wide, (*keep, "_clean")).withColumn(
        "_terms", term_logit(scorer, F.col("_clean"))
    )
    # Rounding the logit keeps threshold decisions equal across summation orders.
    logit = F.round(F.lit(scorer.intercept) + tabular_logit(scorer) + F.col("_terms"), 9)
    scored = pinned(terms.withColumn("_logit", logit), {
        "logit": F.col("_logit"), "score": F.round(sigmoid(F.col("_logit")), 9),
    })
    return scored.drop("_clean", "_terms", "_logit")


class Scorer(Protocol):
    """What scores mails: the coefficients of an export, or a fitted model."""

    phish_threshold: float
    suspect_threshold: float


def score_mail(mail: DataFrame, scorer: Scorer, keep: tuple[str, ...] = ("mail_id",)) -> DataFrame:
    """``keep``, thirty features and ``score`` under a linear export or any fitted model."""
    if isinstance(scorer, LinearScorer):
        return linear_score(mail, scorer, keep)
    return scorer.score_features(mail, keep)


def triage(scored: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Add the verdict, the 0.5 decision and the uncertainty band to a score table."""
    s = scorer or LinearScorer()
    return scored.select(
        "*",
        verdict(F.col("score"), s.phish_threshold, s.suspect_threshold).alias("verdict"),
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        uncertainty_band(F.col("score")).alias("confidence"),
    )


def attribution_array(scorer: LinearScorer) -> Column:
    """Array of ``(phi, feature_idx, feature)`` over the tabular block, feature order."""
    return F.array(
        *[
            F.struct(
                contribution(scorer, f).alias("phi"),
                F.lit(i).alias("feature_idx"),
                F.lit(f).alias("feature"),
            )
            for i, f in enumerate(FEATURES)
        ]
    )


def attributions(features: DataFrame, scorer: LinearScorer) -> DataFrame:
    """Exact linear attributions, one row per mail and feature."""
    return features.select("mail_id", F.inline(attribution_array(scorer))).select(
        "mail_id", "feature_idx", "feature", "phi"
    )
