"""Declared schemas and fixed column orders shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values, a contract with files and models: field and feature names in order,
# families and thresholds. ---

#: Fields of a raw mail, in file order. ``attachments`` is ``;``-joined in CSV.
MAIL_CSV_SCHEMA = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("sender_display", T.StringType()),
        T.StructField("sender_email", T.StringType()),
        T.StructField("reply_to", T.StringType()),
        T.StructField("spf", T.StringType()),
        T.StructField("dkim", T.StringType()),
        T.StructField("dmarc", T.StringType()),
        T.StructField("attachments", T.StringType()),
        T.StructField("has_html", T.StringType()),
        T.StructField("num_recipients", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("noisy_label", T.StringType()),
    ]
)

#: JSON payload of one mail; every field is optional.
MAIL_JSON_SCHEMA = T.StructType(
    [
        T.StructField("mail_id", T.LongType()),
        T.StructField("subject", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("sender_display", T.StringType()),
        T.StructField("sender_email", T.StringType()),
        T.StructField("reply_to", T.StringType()),
        T.StructField("spf", T.StringType()),
        T.StructField("dkim", T.StringType()),
        T.StructField("dmarc", T.StringType()),
        T.StructField("attachments", T.ArrayType(T.StringType())),
        T.StructField("has_html", T.BooleanType()),
        T.StructField("num_recipients", T.IntegerType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

#: The columns feature extraction reads (``mail_id`` identifies the row).
MAIL_COLUMNS = [
    "mail_id", "subject", "body", "sender_display", "sender_email", "reply_to",
    "spf", "dkim", "dmarc", "attachments", "has_html", "num_recipients",
]

#: Canonical order of the tabular block; weights are aligned on it.
FEATURES = [
    "url_count", "url_has_ip", "url_max_len", "url_max_subdomains", "url_has_at_symbol",
    "url_uses_shortener", "url_suspicious_tld", "url_https_ratio", "url_max_entropy",
    "lookalike_brand_distance", "digit_letter_substitution", "has_homoglyph",
    "sender_display_domain_mismatch", "reply_to_mismatch", "free_provider_official_claim",
    "sender_suspicious_tld", "urgency_term_count", "credential_term_count", "lure_term_count",
    "generic_greeting", "exclamation_ratio", "uppercase_ratio", "spf_fail", "dkim_fail",
    "dmarc_fail", "auth_missing", "has_attachment", "dangerous_attachment", "body_length",
    "link_text_mismatch",
]

PHISHING_FAMILIES = ["invoice", "reset", "hr", "delivery", "account", "prize", "ceo", "support"]
BENIGN_FAMILIES = [
    "newsletter", "receipt", "shipping", "colleague", "calendar", "notification", "marketing",
    "legit_security", "legit_invoice", "legit_reset", "legit_account", "legit_delivery",
]

PHISH_THRESHOLD = 0.70
SUSPECT_THRESHOLD = 0.40
DECISION_THRESHOLD = 0.50

# --- End of fixed values. ---
