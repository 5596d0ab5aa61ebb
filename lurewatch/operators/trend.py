"""Technique prevalence, logistic trend fit and forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CEILING = 0.95

# --- Fixed values: display names. ---
TECHNIQUE_LABELS = {
    "url_shortener": "Raccourcisseurs d'URL",
    "lookalike_domain": "Domaines sosies (typosquat)",
    "homoglyph": "Homoglyphes Unicode",
    "ai_polished": "Texte poli par IA générative",
    "qr_code": "QR-codes (quishing)",
    "mfa_bypass": "Contournement MFA / OAuth",
}
# --- End of fixed values. ---


def _period(stamp: Column, unit: str) -> Column:
    """Running number of a calendar period."""
    if unit == "year":
        return F.year(stamp)
    if unit == "month":
        return F.year(stamp) * 12 + F.month(stamp) - 1
    if unit == "day":
        return F.date_diff(stamp.cast("date"), F.lit("1970-01-01").cast("date"))
    raise ValueError(f"unknown period: {unit}")


def technique_prevalence(features: DataFrame, unit: str = "month") -> DataFrame:
    """Share of mails per period that use a technique, from their own features.

    ``features`` holds the feature columns and ``received_at``. Groups are few
    (periods x techniques) and combine map-side.
    """
    flags = {
        "url_shortener": F.col("url_uses_shortener"),
        "lookalike_domain": F.col("lookalike_brand_distance").between(1, 2).cast("double"),
        "homoglyph": F.col("has_homoglyph"),
    }
    long = features.select(
        _period(F.col("received_at"), unit).alias("period"),
        F.inline(
            F.array(*[F.struct(F.lit(t).alias("technique"), v.alias("v")) for t, v in flags.items()])
        ),
    )
    return long.groupBy("technique", "period").agg(
        F.avg("v").alias("prevalence"), F.count("*").alias("n")
    )


def technique_trend(history: DataFrame) -> DataFrame:
    """Least-squares line through the logit of each series, ceiling 0.95."""
    v = F.greatest(F.lit(1e-3), F.least(F.lit(CEILING - 1e-3), F.col("prevalence")))
    logit = F.log(v / (F.lit(CEILING) - v))
    t = F.col("period").cast("double")
    fit = history.groupBy("technique").agg(
        F.coalesce(F.regr_slope(logit, t), F.lit(0.0)).alias("k"),
        F.avg(logit).alias("mean_logit"),
        F.avg(t).alias("mean_period"),
        F.max("period").alias("last_period"),
        F.max_by("prevalence", "period").alias("last_prevalence"),
    )
    return fit.select(
        "technique", "k",
        (F.col("mean_logit") - F.col("k") * F.col("mean_period")).alias("b"),
        "last_period", "last_prevalence",
    )


def technique_forecast(
    history: DataFrame, horizon: int | None = None, ahead: int = 3
) -> DataFrame:
    """History and forecast in one table, with labels.

    Forecasts reach period ``horizon``, or ``ahead`` periods beyond the last one of
    any series; that maximum is a window over one row for each technique.
    """
    names = F.map_from_arrays(
        F.split(F.lit("\x01".join(TECHNIQUE_LABELS)), "\x01"),
        F.split(F.lit("\x01".join(TECHNIQUE_LABELS.values())), "\x01"),
    )
    last = F.max("last_period").over(Window.partitionBy()) + F.lit(ahead)
    end = last if horizon is None else F.lit(horizon)
    future = technique_trend(history).withColumn("end", end.cast("int")).where("last_period < end").withColumn(
        "period", F.explode(F.sequence(F.col("last_period") + 1, F.col("end")))
    )
    p = F.lit(CEILING) / (1 + F.exp(-(F.col("k") * F.col("period") + F.col("b"))))
    forecast = future.select(
        "technique", "period",
        F.round(F.least(F.greatest(p, F.lit(0.0)), F.lit(0.99)), 3).alias("prevalence"),
        F.lit("forecast").alias("kind"),
    )
    past = history.select("technique", "period", "prevalence", F.lit("history").alias("kind"))
    both = past.unionByName(forecast)
    return both.withColumn(
        "label", F.coalesce(F.element_at(names, F.col("technique")), F.col("technique"))
    )


def trend_direction(series: DataFrame) -> DataFrame:
    """``up`` when the last forecast exceeds the last observation, else ``down``."""
    last = lambda kind: F.max_by(
        F.when(F.col("kind") == kind, F.col("prevalence")),
        F.when(F.col("kind") == kind, F.col("period")),
    )
    ends = series.groupBy("technique").agg(
        last("history").alias("last_history"), last("forecast").alias("last_forecast")
    )
    up = F.col("last_forecast") > F.col("last_history")
    return ends.withColumn("direction", F.when(up, "up").otherwise("down"))
