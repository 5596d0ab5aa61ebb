"""Text augmentation of training mails, with draws that hash the mail id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lurewatch.functions.draws import row_chance, row_choice, row_draw


def augment_text(mail: DataFrame) -> DataFrame:
    """Vary greetings, swap two letters in some mails, squeeze blank lines in some."""
    key = F.col("mail_id")
    greetings = ["Bonjour,", "Bonjour, ", "Madame, Monsieur,", "Cher client,", "Hello,"]
    body = F.replace(F.col("body"), F.lit("Bonjour,"), row_choice("hello", greetings, key))
    out = mail.withColumn("body", body).withColumn("_w", F.split("body", " "))
    at = (row_draw("typo_word", key) % F.greatest(F.size("_w"), F.lit(1))).cast("int")
    word = F.get("_w", at)
    j = (row_draw("typo_at", key) % F.greatest(F.length(word) - 2, F.lit(1))).cast("int") + 1
    swapped = F.concat(
        F.substring(word, F.lit(1), j), F.substring(word, j + 2, F.lit(1)),
        F.substring(word, j + 1, F.lit(1)), F.substring(word, j + 3, F.length(word)),
    )
    # Replaced by position and glued back: the rest of the mail stays byte for byte.
    typo = F.array_join(
        F.concat(
            F.slice("_w", F.lit(1), at), F.array(swapped),
            F.slice("_w", at + 2, F.greatest(F.size("_w") - at - 1, F.lit(0))),
        ),
        " ",
    )
    fits = (F.size("_w") > 8) & (F.length(word) > 4) & word.rlike(r"^\p{L}+$")
    body = F.when(row_chance("typo", 0.3, key) & fits, typo).otherwise(F.col("body"))
    tight = F.btrim(F.replace(body, F.lit("\n\n"), F.lit("\n")), F.lit(" \n\t\r"))
    squeezed = F.when(row_chance("squeeze", 0.25, key), tight).otherwise(body)
    return out.withColumn("body", squeezed).drop("_w")
