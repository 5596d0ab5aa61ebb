"""Mail sources and sinks: CSV corpus, JSON payloads, parquet, all coerced alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lurewatch.functions.text import strip
from lurewatch.schema import MAIL_CSV_SCHEMA, MAIL_JSON_SCHEMA
from lurewatch.sources import records

_TEXT_DEFAULTS = {
    "subject": "", "body": "", "sender_display": "", "sender_email": "", "reply_to": "",
    "spf": "none", "dkim": "none", "dmarc": "none",
}


def attachment_list(joined: Column) -> Column:
    """``;``-joined file names to an array; blank text means no attachment."""
    empty = F.array().cast("array<string>")
    return F.when(strip(F.coalesce(joined, F.lit(""))) == "", empty).otherwise(F.split(joined, ";"))


def _or_default(name: str, default: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default)).alias(name)


def _with_row_id(df: DataFrame) -> DataFrame:
    """Number rows that have no id, so that equal mails stay apart.

    A batch row's id follows from its content and a running number among equal rows, the
    same in every scan; a stream has no equal rows to count, so its ids are random.
    Readers of files number rows by their place instead.
    """
    if df.isStreaming:
        return df.select(F.shiftrightunsigned(F.xxhash64(F.uuid()), 1).alias("mail_id"), "*")
    return records.numbered_copies(df, "mail_id")


def _number(name: str, default: int) -> Column:
    """``3``, ``3.0`` and ``3e0`` are three; blank or unreadable text is the default."""
    value = F.col(name).cast("string").try_cast("double").try_cast("int")
    return F.coalesce(value, F.lit(default))


def _label(name: str) -> Column:
    """A blank label is zero; one that is no number fails rather than turn benign."""
    text = strip(F.coalesce(F.col(name).cast("string"), F.lit("")))
    value = text.try_cast("double").try_cast("int")
    wrong = F.raise_error(F.concat(F.lit(f"unreadable {name}: "), text)).cast("int")
    return F.when(text == "", 0).when(value.isNull(), wrong).otherwise(value)


def coerce_csv(df: DataFrame) -> DataFrame:
    """Typed mail rows from all-string CSV rows, blanks replaced by the field defaults."""
    recipients = _number("num_recipients", 1)
    out = df.select(
        *([F.col("mail_id").cast("bigint")] if "mail_id" in df.columns else []),
        *[_or_default(c, d) for c, d in _TEXT_DEFAULTS.items()],
        attachment_list(F.col("attachments")).alias("attachments"),
        (_number("has_html", 0) != 0).alias("has_html"),
        F.when(recipients == 0, 1).otherwise(recipients).alias("num_recipients"),
        *[_label(c).alias(c) for c in ("label", "noisy_label") if c in df.columns],
        *([_or_default("family", "")] if "family" in df.columns else []),
    )
    return out if "mail_id" in out.columns else _with_row_id(out)


def read_mail(spark: SparkSession, path: str) -> DataFrame:
    """CSV corpus scan. Bodies hold quotes and line breaks, so records span lines.

    Many tasks read one big file. ``mail_id`` is the place of the record in the files,
    the same in every scan of them (``records.read_records``).
    """
    raw = records.read_csv(spark, path, MAIL_CSV_SCHEMA)
    return coerce_csv(raw.withColumnRenamed("record_id", "mail_id"))


def write_mail_csv(df: DataFrame, path: str) -> None:
    """Corpus sink in the same layout ``read_mail`` reads."""
    flat = df.select(
        "subject", "body", "sender_display", "sender_email", "reply_to", "spf", "dkim", "dmarc",
        F.array_join("attachments", ";").alias("attachments"),
        F.col("has_html").cast("int").alias("has_html"),
        "num_recipients", "label", "family", "noisy_label",
    )
    (
        flat.write.mode("errorifexists")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def coerce_json(df: DataFrame) -> DataFrame:
    """Payload rows with the same defaults; missing recipients or zero become one."""
    out = df.select(
        *(["mail_id"] if "mail_id" in df.columns else []),
        *[_or_default(c, d) for c, d in _TEXT_DEFAULTS.items()],
        F.coalesce("attachments", F.array().cast("array<string>")).alias("attachments"),
        F.coalesce("has_html", F.lit(False)).alias("has_html"),
        F.coalesce(F.nullif(F.col("num_recipients"), F.lit(0)), F.lit(1)).alias("num_recipients"),
        *(["received_at"] if "received_at" in df.columns else []),
    )
    if "mail_id" not in out.columns:
        return _with_row_id(out)
    if out.isStreaming:
        return out.withColumn("mail_id", F.coalesce("mail_id", -1 - F.shiftrightunsigned(F.xxhash64(F.uuid()), 1)))
    # below zero, where given ids are not
    unnamed = _with_row_id(out.where("mail_id IS NULL").drop("mail_id"))
    return out.where("mail_id IS NOT NULL").unionByName(unnamed.withColumn("mail_id", -1 - F.col("mail_id")))


def read_mail_json(spark: SparkSession, path: str) -> DataFrame:
    """One payload per line; a payload without an id gets one below zero from its place in the files."""
    lines = records.read_records(spark, path, quoted=False)
    parsed = lines.select("record_id", F.from_json("record", MAIL_JSON_SCHEMA).alias("p")).select("record_id", "p.*")
    return coerce_json(parsed.withColumn("mail_id", F.coalesce("mail_id", -1 - F.col("record_id"))).drop("record_id"))


def parse_payloads(df: DataFrame, column: str = "value") -> DataFrame:
    """Payloads held as JSON text in a column (a message topic, a request log)."""
    parsed = F.from_json(F.col(column), MAIL_JSON_SCHEMA).alias("p")
    return coerce_json(df.select(parsed).select("p.*"))
