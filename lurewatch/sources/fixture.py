"""The ``mail`` view over the plain ``documents`` / ``events`` tables.

Documents carry no mail headers, so signals are injected by integer arithmetic on
``doc_id``. The text is plain SQL shared by Spark and any ANSI engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lurewatch.sources.mail import attachment_list

# ``{documents}`` is the table name (or a DataFrame parameter in Spark). Every text is the
# body of one mail; every 17th document gives a second, image-only mail under a negative id.
MAIL_SQL = """
SELECT
  mail_id,
  CASE doc_id % 6
    WHEN 0 THEN 'URGENT: verify your account' WHEN 1 THEN 'Re: meeting notes'
    WHEN 2 THEN 'Your parcel is waiting' WHEN 3 THEN 'Invoice'
    WHEN 4 THEN 'Congratulations winner' ELSE 'Weekly newsletter' END AS subject,
  CASE WHEN mail_id < 0 THEN '' ELSE
    text || ' ' ||
    CASE doc_id % 9
      WHEN 0 THEN 'Dear customer, confirm your password now!!!'
      WHEN 1 THEN 'Last chance: your account is locked'
      WHEN 2 THEN 'You won a gift voucher' WHEN 3 THEN 'See the attached minutes'
      WHEN 4 THEN 'blocked card number expired' WHEN 5 THEN ''
      WHEN 6 THEN 'Bonus refund today' WHEN 7 THEN 'p a s s w o r d reset'
      ELSE 'Verify your card number asap' END || ' ' ||
    CASE WHEN doc_id % 7 = 0 THEN ''
      WHEN doc_id % 5 < 2 THEN CASE doc_id % 8
        WHEN 0 THEN 'http://paypa1.tk/login'
        WHEN 1 THEN 'https://secure-paypal.xyz/verify'
        WHEN 2 THEN 'http://192.0.2.10/login'
        WHEN 3 THEN 'https://bit.ly/a1234'
        WHEN 4 THEN 'http://paypal.secure-1.tk/account'
        WHEN 5 THEN 'http://user@evil.example.top/x'
        WHEN 6 THEN 'http://www.micros0ft.com/reset'
        ELSE 'https://amazonn.click/pay' END
      ELSE CASE doc_id % 4
        WHEN 0 THEN 'https://www.amazon.fr/orders'
        WHEN 1 THEN 'https://example.org/help'
        WHEN 2 THEN 'https://paypal.com/account'
        ELSE 'https://mail.example.com:8443/a/b' END END ||
    CASE WHEN doc_id % 13 = 4 THEN ' pаypal' ELSE '' END ||
    CASE WHEN doc_id % 11 = 3
      THEN ' <a href="http://evil.tk/x">https://paypal.com</a>' ELSE '' END
  END AS body,
  CASE doc_id % 4 WHEN 0 THEN 'PayPal Service' WHEN 1 THEN 'Amazon'
    WHEN 2 THEN 'Marie Martin' ELSE 'Microsoft Support' END AS sender_display,
  CASE WHEN doc_id % 5 < 2 THEN
    CASE doc_id % 3 WHEN 0 THEN 'service@paypa1.tk' WHEN 1 THEN 'support@gmail.com'
      ELSE 'noreply@mail-7.xyz' END
    ELSE CASE doc_id % 3 WHEN 0 THEN 'orders@amazon.fr' WHEN 1 THEN 'news@example.org'
      ELSE 'contact@paypal.com' END END AS sender_email,
  CASE WHEN doc_id % 3 = 0 THEN ''
    WHEN doc_id % 5 < 2 AND doc_id % 2 = 0 THEN 'reply@other.top'
    WHEN doc_id % 5 < 2 THEN
      CASE doc_id % 3 WHEN 1 THEN 'support@gmail.com' ELSE 'noreply@mail-7.xyz' END
    ELSE CASE doc_id % 3 WHEN 1 THEN 'news@example.org' ELSE 'contact@paypal.com' END
  END AS reply_to,
  CASE WHEN doc_id % 5 < 2 THEN
    CASE doc_id % 4 WHEN 0 THEN 'fail' WHEN 1 THEN 'softfail' WHEN 2 THEN 'none' ELSE 'pass' END
    WHEN doc_id % 20 = 4 THEN 'none' ELSE 'pass' END AS spf,
  CASE WHEN doc_id % 5 < 2 THEN
    CASE doc_id % 3 WHEN 0 THEN 'fail' WHEN 1 THEN 'none' ELSE 'pass' END
    WHEN doc_id % 20 = 4 THEN 'none' ELSE 'pass' END AS dkim,
  CASE WHEN doc_id % 5 < 2 THEN CASE WHEN doc_id % 5 = 0 THEN 'fail' ELSE 'none' END
    WHEN doc_id % 20 = 4 THEN 'none' ELSE 'pass' END AS dmarc,
  CASE WHEN mail_id < 0 THEN 'message.png'
    WHEN doc_id % 12 = 0 THEN 'invoice.pdf.exe' WHEN doc_id % 12 = 5 THEN 'report.pdf'
    WHEN doc_id % 12 = 7 THEN 'scan.png;notes.txt' ELSE '' END AS attachment_names,
  doc_id % 3 = 0 AS has_html,
  1 AS num_recipients,
  CASE WHEN doc_id % 5 < 2 THEN 1 ELSE 0 END AS label,
  CASE WHEN (doc_id % 33 = 0) = (doc_id % 5 < 2) THEN 0 ELSE 1 END AS noisy_label,
  CASE WHEN doc_id % 5 < 2 THEN
    CASE doc_id % 4 WHEN 0 THEN 'account' WHEN 1 THEN 'invoice' WHEN 2 THEN 'reset'
      ELSE 'delivery' END
    ELSE CASE doc_id % 4 WHEN 0 THEN 'newsletter' WHEN 1 THEN 'receipt'
      WHEN 2 THEN 'shipping' ELSE 'colleague' END END AS family
FROM (
  SELECT doc_id, doc_id AS mail_id, text FROM {documents} UNION ALL
  SELECT doc_id, -1 - doc_id AS mail_id, '' AS text FROM {documents} WHERE doc_id % 17 = 5) d
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_mail(documents: DataFrame) -> DataFrame:
    """Mail rows of a (batch or streaming) ``documents`` frame."""
    mail = documents.sparkSession.sql(MAIL_SQL, documents=documents)
    return mail.withColumn("attachments", attachment_list(F.col("attachment_names"))).drop(
        "attachment_names"
    )


def mail_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_mail(table(spark, sf_dir, "documents").select("doc_id", "text"))


def mail_stream_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows arriving as a file stream."""
    schema = table(spark, sf_dir, "documents").schema
    files = f"{sf_dir.rstrip('/')}/documents*.parquet"
    return as_mail(spark.readStream.schema(schema).parquet(files).select("doc_id", "text"))


#: Seconds from the first event after which a mail came in, before they wrap at the last one.
RECEIVED_STEP = 7919


def with_event_times(mail: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add ``received_at``: every mail, whatever its id, falls between the first and the last event."""
    events = table(spark, sf_dir, "events")
    first, last = F.date_trunc("second", F.min("ts")), F.max("ts")
    span = events.agg(first.alias("a"), last.alias("b")).select(F.timestamp_diff("SECOND", F.col("a"), F.col("b")) + 1)
    start = events.agg(first).scalar()
    after = F.pmod(F.col("mail_id") * RECEIVED_STEP, span.scalar())
    return mail.withColumn("received_at", F.timestamp_add("SECOND", after, start))


def with_events(mail: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mail`` with ``received_at`` once for each event dealt to it.

    Events go to the documents in turn, by their ids, so both mails of a document get all
    of its events. A mail that no event falls to keeps the time that its own id gives.
    """
    documents = table(spark, sf_dir, "documents").agg(F.greatest(F.count("*"), F.lit(1)))
    events = table(spark, sf_dir, "events").select(
        (F.col("event_id") % documents.scalar()).alias("_place"), F.col("ts").alias("_ts")
    )
    timed = with_event_times(mail, spark, sf_dir).withColumn("_place", F.greatest("mail_id", -1 - F.col("mail_id")))
    dealt = timed.join(events, "_place", "left")
    return dealt.withColumn("received_at", F.coalesce("_ts", "received_at")).drop("_place", "_ts")
