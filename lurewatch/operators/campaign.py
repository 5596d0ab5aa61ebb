"""Lever-weighted risk, before and after training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- Fixed values: lever weights, training effects. ---
LEVER_WEIGHTS = {
    "urgence": 0.55, "autorite": 0.60, "peur": 0.45, "peur_financiere": 0.50,
    "appat_financier": 0.50, "curiosite": 0.40, "preuve_sociale": 0.35, "confidentialite": 0.45,
    "serviabilite": 0.35, "peur_": 0.40,
}
TRAINING_LEVELS = {
    "aucune": 0.0, "sensibilisation_de_base": 0.45, "formation_reguliere": 0.70,
    "simulations_repetees": 0.82,
}
# --- End of fixed values. ---

DEFAULT_WEIGHT, DISCOUNT, MIDPOINT, STEEPNESS = 0.3, 0.85, 1.35, 1.7

def _double_map(values: dict[str, float]) -> Column:
    return F.map_from_arrays(
        F.split(F.lit(",".join(values)), ","),
        F.split(F.lit(",".join(map(repr, values.values()))), ",").cast("array<double>"),
    )


def persuasion(levers: Column) -> Column:
    """Discounted sum of lever weights, heaviest lever first, unknown levers 0.3."""
    table = _double_map(LEVER_WEIGHTS)
    weights = F.transform(
        levers, lambda lever: F.coalesce(F.element_at(table, lever), F.lit(DEFAULT_WEIGHT))
    )
    heaviest_first = F.sort_array(weights, asc=False)
    discounted = F.transform(heaviest_first, lambda w, i: w * F.pow(F.lit(DISCOUNT), i))
    return F.aggregate(discounted, F.lit(0.0), lambda acc, x: acc + x)


def campaign_risk(table: DataFrame, levels: tuple[str, ...] = tuple(TRAINING_LEVELS)) -> DataFrame:
    """Expected click rate of every row with a ``levers`` array, per training level.

    The lever table is ten literals and a row emits one line per level, so the job
    is map-only; whoever wants a ranking orders the rows that they show.
    """
    score = persuasion(F.col("levers"))
    base = 1 / (1 + F.exp(-F.lit(STEEPNESS) * (score - F.lit(MIDPOINT))))
    reductions = F.array(
        *[
            F.struct(F.lit(n).alias("training"), F.lit(TRAINING_LEVELS.get(n, 0.0)).alias("cut"))
            for n in levels
        ]
    )
    rated = table.withColumn("persuasion", score).withColumn("base_rate", base)
    return (
        rated.select("*", F.inline(reductions))
        .withColumn("adjusted_rate", F.col("base_rate") * (1 - F.col("cut")))
        .drop("cut")
    )


def mail_levers(features: DataFrame) -> DataFrame:
    """Levers a mail pulls, read off its own features, as input of ``campaign_risk``."""
    pulled = {
        "urgence": F.col("urgency_term_count") > 0,
        "autorite": F.col("sender_display_domain_mismatch") > 0,
        "peur": F.col("credential_term_count") > 0,
        "appat_financier": F.col("lure_term_count") > 0,
        "curiosite": F.col("url_uses_shortener") > 0,
    }
    names = F.array(*[F.when(cond, F.lit(name)) for name, cond in pulled.items()])
    return features.withColumn("levers", F.array_compact(names))
