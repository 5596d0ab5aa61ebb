"""The thirty tabular features of a mail, as map-only column expressions.

No block shuffles: URL facts are higher-order functions over the row's own URL
array and the look-alike distance runs against the literal brand list, so a host
that a third of all mails share costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lurewatch import lexicons as lex
from lurewatch.functions import text as tx
from lurewatch.functions.lexicon_scan import lexicon_hits
from lurewatch.schema import FEATURES

DISTANCE_CAP = 9

_BLOCK_COLUMNS = {
    "url": FEATURES[0:9],
    "lookalike": FEATURES[9:11],
    "homoglyph": FEATURES[11:12],
    "sender": FEATURES[12:16],
    "text": FEATURES[16:22],
    "auth": FEATURES[22:26],
    "attachment": FEATURES[26:28],
    "length": FEATURES[28:29],
    "link": FEATURES[29:30],
}


def brand_array() -> Column:
    return F.split(F.lit(",".join(lex.BRANDS)), ",")


def entropy(label: Column) -> Column:
    """Shannon entropy (bits) of the characters of a string, 0 for the empty one."""
    n = F.length(label)

    def minus_term(acc, ch):
        p = (n - F.length(F.replace(label, ch, F.lit("")))) / n
        return acc - p * F.log2(p)

    chars = F.array_distinct(F.split(label, ""))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.aggregate(chars, F.lit(0.0), minus_term))


def brand_distance(host: Column) -> Column:
    """Smallest non-zero edit distance of the registered label to a brand, capped."""
    label = F.regexp_replace(tx.registered_label(host), "[^a-z0-9]", "")
    distances = F.transform(
        brand_array(), lambda b: F.levenshtein(label, b, DISTANCE_CAP)
    )
    nearest = F.array_min(F.filter(distances, lambda d: d > 0))
    return F.when(label == "", F.lit(DISTANCE_CAP)).otherwise(
        F.coalesce(nearest, F.lit(DISTANCE_CAP))
    )


def digit_fold_hit(host: Column) -> Column:
    """First label equals a brand once digits are folded, registered label does not."""
    base = F.regexp_replace(tx.registered_label(host), "[^a-z]", "")
    folded = F.translate(F.substring_index(host, ".", 1), "01345", "oleas")
    folded = F.regexp_replace(folded, "[^a-z]", "")
    return folded.isin(*lex.BRANDS) & (base != folded)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def _url_block(urls: Column, hosts: Column) -> dict[str, Column]:
    n = F.size(urls)
    dots = lambda h: F.length(h) - F.length(F.replace(h, F.lit("."), F.lit("")))
    https = F.size(F.filter(urls, lambda u: F.lower(u).startswith("https")))
    best = lambda arr: F.coalesce(F.array_max(arr), F.lit(0)).cast("double")
    return {
        "url_count": n.cast("double"),
        "url_has_ip": _flag(
            F.exists(urls, lambda u: u.rlike(r"(?i)^https?://(\p{Nd}{1,3}\.){3}\p{Nd}{1,3}"))
        ),
        "url_max_len": best(F.transform(urls, F.length)),
        "url_max_subdomains": best(F.transform(hosts, dots)),
        "url_has_at_symbol": _flag(
            F.exists(urls, lambda u: F.split_part(u, F.lit("/"), F.lit(3)).contains("@"))
        ),
        "url_uses_shortener": _flag(
            F.exists(hosts, lambda h: tx.last_two_labels(h).isin(*lex.SHORTENERS))
        ),
        "url_suspicious_tld": _flag(
            F.exists(hosts, lambda h: tx.tld_of(h).isin(*lex.RISKY_TLDS))
        ),
        "url_https_ratio": F.when(n == 0, F.lit(1.0)).otherwise(https / n),
        "url_max_entropy": F.coalesce(
            F.array_max(F.transform(hosts, lambda h: entropy(F.substring_index(h, ".", 1)))),
            F.lit(0.0),
        ),
    }


def _lookalike_block(hosts: Column) -> dict[str, Column]:
    return {
        "lookalike_brand_distance": F.coalesce(
            F.array_min(F.transform(hosts, brand_distance)), F.lit(DISTANCE_CAP)
        ).cast("double"),
        "digit_letter_substitution": _flag(F.exists(hosts, digit_fold_hit)),
    }


def _homoglyph_block(hosts: Column) -> dict[str, Column]:
    hit = F.col("hits.homoglyph") | F.exists(hosts, tx.has_homoglyph)
    return {"has_homoglyph": _flag(hit)}


def _sender_block(sender: Column, reply: Column, display: Column) -> dict[str, Column]:
    mismatch = F.exists(
        brand_array(), lambda b: display.contains(b) & (sender != "") & ~sender.contains(b)
    )
    named = F.exists(brand_array(), lambda b: display.contains(b))
    claim = sender.isin(*lex.FREE_PROVIDERS) & (named | F.col("hits.brand"))
    return {
        "sender_display_domain_mismatch": _flag(mismatch),
        "reply_to_mismatch": _flag(
            (reply != "") & (sender != "")
            & (tx.last_two_labels(reply) != tx.last_two_labels(sender))
        ),
        "free_provider_official_claim": _flag(claim),
        "sender_suspicious_tld": _flag(tx.tld_of(sender).isin(*lex.RISKY_TLDS)),
    }


def _text_block(text: Column) -> dict[str, Column]:
    n = F.length(text)
    letters = F.coalesce("hits.letters", n - F.length(F.regexp_replace(text, r"\p{L}+", "")))
    upper = F.coalesce("hits.capitals", n - F.length(F.regexp_replace(text, r"\p{Lu}+", "")))
    counts = {
        f"{kind}_term_count": F.col(f"hits.{kind}").cast("double")
        for kind in ("urgency", "credential", "lure")
    }
    return counts | {
        "generic_greeting": _flag(F.col("hits.greeting")),
        "exclamation_ratio": tx.count_of(text, "!") / F.greatest(n, F.lit(1)),
        "uppercase_ratio": F.when(letters == 0, F.lit(0.0)).otherwise(upper / letters),
    }


def _auth_block() -> dict[str, Column]:
    spf, dkim, dmarc = (F.lower(c) for c in ("spf", "dkim", "dmarc"))
    return {
        "spf_fail": _flag(spf.isin("fail", "softfail")),
        "dkim_fail": _flag(dkim == "fail"),
        "dmarc_fail": _flag(dmarc == "fail"),
        "auth_missing": _flag((spf == "none") & (dkim == "none") & (dmarc == "none")),
    }


def _attachment_block() -> dict[str, Column]:
    risky = lambda f: f.contains(".") & F.lower(
        F.substring_index(f, ".", -1)
    ).isin(*lex.DANGEROUS_EXTENSIONS)
    return {
        "has_attachment": _flag(F.size("attachments") > 0),
        "dangerous_attachment": _flag(F.exists("attachments", risky)),
    }


def anchor_mismatch(html: Column) -> Column:
    """Some ``<a href>`` shows a web address of another registered domain."""
    hrefs = F.regexp_extract_all(html, F.lit(tx.ANCHOR), F.lit(1))
    shown = F.regexp_extract_all(html, F.lit(tx.ANCHOR), F.lit(2))

    def differs(href, inner):
        text = F.regexp_replace(inner, "<[^>]+>", "")
        seen, real = tx.domain_of(text), tx.domain_of(href)
        return (
            F.lower(text).contains("http") & (seen != "") & (real != "")
            & (tx.last_two_labels(seen) != tx.last_two_labels(real))
        )

    return F.exists(F.zip_with(hrefs, shown, differs), lambda x: x)


def _link_block() -> dict[str, Column]:
    maybe = F.col("has_html") & (F.col("body").contains("<a") | F.col("body").contains("<A"))
    return {"link_text_mismatch": _flag(maybe & anchor_mismatch(F.col("body")))}


def extract_urls(text: Column) -> Column:
    return F.when(
        text.contains("://"), F.regexp_extract_all(text, F.lit(tx.URL), F.lit(0))
    ).otherwise(F.array().cast("array<string>"))


def _prepared(mail: DataFrame, keep: list[str]) -> DataFrame:
    """Shared intermediates, each computed once and referenced by many features."""
    raw = [
        "subject", "body", "sender_display", "sender_email", "reply_to",
        "spf", "dkim", "dmarc", "attachments", "has_html",
    ]
    held = [c for c in keep if c not in raw]
    base = mail.select(*held, *raw, tx.full_text().alias("text"))
    base = base.select("*", extract_urls(F.col("text")).alias("urls"))
    return base.select(
        "*",
        F.transform("urls", tx.host_of_url).alias("hosts"),
        lexicon_hits(F.col("text"), letters=True).alias("hits"),
        tx.domain_of(F.col("sender_email")).alias("sender_domain"),
        tx.domain_of(F.col("reply_to")).alias("reply_domain"),
        tx.fold(F.col("sender_display")).alias("display_norm"),
    )


def _blocks(names: list[str]) -> dict[str, Column]:
    text, urls, hosts = F.col("text"), F.col("urls"), F.col("hosts")
    builders = {
        "url": lambda: _url_block(urls, hosts),
        "lookalike": lambda: _lookalike_block(hosts),
        "homoglyph": lambda: _homoglyph_block(hosts),
        "sender": lambda: _sender_block(
            F.col("sender_domain"), F.col("reply_domain"), F.col("display_norm")
        ),
        "text": lambda: _text_block(text),
        "auth": _auth_block,
        "attachment": _attachment_block,
        "length": lambda: {"body_length": F.length("body").cast("double")},
        "link": _link_block,
    }
    out: dict[str, Column] = {}
    for name in names:
        out |= builders[name]()
    return out


def feature_blocks(
    mail: DataFrame, blocks: list[str], keep: tuple[str, ...] = ("mail_id",)
) -> DataFrame:
    """Selected feature blocks next to the ``keep`` columns; the rest is pruned away."""
    keep = list(keep)
    exprs = _blocks(blocks)
    return _prepared(mail, keep).select(*keep, *[c.alias(n) for n, c in exprs.items()])


def mail_features(mail: DataFrame, keep: tuple[str, ...] = ("mail_id",)) -> DataFrame:
    """All thirty features in canonical order next to the ``keep`` columns."""
    return feature_blocks(mail, list(_BLOCK_COLUMNS), keep).select(*keep, *FEATURES)


def host_lookalike(hosts: DataFrame) -> DataFrame:
    """Distinct hosts of a ``host`` column with their distance and digit-fold flag.

    ``distinct`` combines map-side first, so a dominant host shrinks to one row per
    task before the shuffle.
    """
    h = F.col("host")
    return hosts.select("host").distinct().select(
        h,
        brand_distance(h).alias("lookalike_brand_distance"),
        digit_fold_hit(h).cast("int").alias("digit_letter_substitution"),
    )
