"""ANSI-style SQL building blocks of the equivalence checks (mail view, features, tokens)."""

from __future__ import annotations

from lurewatch import lexicons as lex
from lurewatch.schema import FEATURES
from lurewatch.sources.fixture import MAIL_SQL

URL_RE = r"(?i)https?://[^\s<>\"'')]+"


def text_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def in_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


MAIL = (
    "mail AS (SELECT * EXCLUDE (attachment_names), CASE WHEN trim(attachment_names) = '' "
    "THEN []::VARCHAR[] ELSE string_split(attachment_names, ';') END AS attachments FROM ("
    + MAIL_SQL.replace("{documents}", "documents")
    + "))"
)

BRANDS = text_list(lex.BRANDS)


def host_expr(url: str) -> str:
    return (
        rf"regexp_replace(regexp_extract(lower({url}), 'https?://([^/\s:]+)', 1), '^www\.', '')"
    )


def domain_expr(value: str) -> str:
    s = f"lower(trim({value}))"
    return (
        f"CASE WHEN contains({s}, '@') AND NOT contains({s}, '://') "
        f"THEN trim(string_split({s}, '@')[-1], '> ') ELSE {host_expr(s)} END"
    )


def last_two(host: str) -> str:
    return f"array_to_string(string_split({host}, '.')[-2:], '.')"


def tld(host: str) -> str:
    return f"CASE WHEN contains({host}, '.') THEN string_split({host}, '.')[-1] ELSE '' END"


def first_label(host: str) -> str:
    return f"string_split({host}, '.')[1]"


def term_sum(text: str, terms) -> str:
    return (
        f"list_sum(list_transform({text_list(terms)}, lambda t: "
        f"((length({text}) - length(replace({text}, t, ''))) // length(t))))"
    )


def distance(host: str) -> str:
    label = f"regexp_replace({first_label(last_two(host))}, '[^a-z0-9]', '', 'g')"
    return (
        f"CASE WHEN {label} = '' THEN 9 ELSE least(9, list_min(list_filter(list_transform("
        f"{BRANDS}, lambda b: levenshtein({label}, b)), lambda d: d > 0))) END"
    )


def digit_fold(host: str) -> str:
    base = f"regexp_replace({first_label(last_two(host))}, '[^a-z]', '', 'g')"
    folded = (
        f"regexp_replace({first_label(f'translate({host}, ' + chr(39) + '01345' + chr(39) + ', ' + chr(39) + 'oleas' + chr(39) + ')')}, '[^a-z]', '', 'g')"
    )
    return f"({folded} IN {in_list(lex.BRANDS)} AND {base} <> {folded})"


def entropy(label: str) -> str:
    p = f"((length({label}) - length(replace({label}, c, ''))) / length({label}))"
    return (
        f"CASE WHEN {label} = '' THEN 0.0 ELSE -list_sum(list_transform("
        f"list_distinct(string_split({label}, '')), lambda c: {p} * log2({p}))) END"
    )


def _any(arr: str, var: str, cond: str) -> str:
    return f"(len(list_filter({arr}, lambda {var}: {cond})) > 0)::INT::DOUBLE"


_GLYPHS = "[" + "".join(lex.HOMOGLYPHS) + "]"
_ANCHOR = r"(?is)<a[^>]+href=[\"'']([^\"'']+)[\"''][^>]*>(.*?)</a>"


def features_ctes(src: str, prefix: str = "f", keys: str = "mail_id", exact: bool = False) -> str:
    """CTEs ending in ``{prefix}`` = (keys, 30 features) over a mail-shaped relation."""
    rnd = (lambda x: x) if exact else (lambda x: f"round({x}, 6)")
    upper = (
        r"coalesce(length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) / "
        r"nullif(length(regexp_replace(text, '[^\p{L}]', '', 'g')), 0), 0.0)"
    )
    shown = "regexp_replace(a.t, '<[^>]+>', '', 'g')"
    return rf"""
{prefix}_0 AS (SELECT *, subject || chr(10) || body AS text FROM {src}),
{prefix}_1 AS (SELECT *, regexp_extract_all(text, '{URL_RE}') AS urls,
  strip_accents(lower(text)) AS norm, strip_accents(lower(sender_display)) AS disp,
  {domain_expr('sender_email')} AS sdom, {domain_expr('reply_to')} AS rdom FROM {prefix}_0),
{prefix}_2 AS (SELECT *, list_transform(urls, lambda u: {host_expr('u')}) AS hosts
  FROM {prefix}_1),
{prefix} AS (SELECT {keys},
  len(urls)::DOUBLE AS url_count,
  {_any('urls', 'u', r"regexp_matches(u, '(?i)^https?://(\d{1,3}\.){3}\d{1,3}')")} AS url_has_ip,
  coalesce(list_max(list_transform(urls, lambda u: length(u))), 0)::DOUBLE AS url_max_len,
  coalesce(list_max(list_transform(hosts, lambda h: length(h) - length(replace(h, '.', '')))), 0)::DOUBLE AS url_max_subdomains,
  {_any('urls', 'u', "contains(split_part(u, '/', 3), '@')")} AS url_has_at_symbol,
  {_any('hosts', 'h', f"{last_two('h')} IN {in_list(lex.SHORTENERS)}")} AS url_uses_shortener,
  {_any('hosts', 'h', f"{tld('h')} IN {in_list(lex.RISKY_TLDS)}")} AS url_suspicious_tld,
  {rnd("CASE WHEN len(urls) = 0 THEN 1.0 ELSE len(list_filter(urls, lambda u: starts_with(lower(u), 'https'))) / len(urls) END")} AS url_https_ratio,
  {rnd(f"coalesce(list_max(list_transform(hosts, lambda h: {entropy(first_label('h'))})), 0.0)")} AS url_max_entropy,
  coalesce(list_min(list_transform(hosts, lambda h: {distance('h')})), 9)::DOUBLE AS lookalike_brand_distance,
  {_any('hosts', 'h', digit_fold('h'))} AS digit_letter_substitution,
  (regexp_matches(text, '{_GLYPHS}') OR len(list_filter(hosts, lambda h: regexp_matches(h, '{_GLYPHS}'))) > 0)::INT::DOUBLE AS has_homoglyph,
  {_any(BRANDS, 'b', "contains(disp, b) AND sdom <> '' AND NOT contains(sdom, b)")} AS sender_display_domain_mismatch,
  (rdom <> '' AND sdom <> '' AND {last_two('rdom')} <> {last_two('sdom')})::INT::DOUBLE AS reply_to_mismatch,
  (sdom IN {in_list(lex.FREE_PROVIDERS)} AND len(list_filter({BRANDS}, lambda b: contains(disp, b) OR contains(norm, b))) > 0)::INT::DOUBLE AS free_provider_official_claim,
  (({tld('sdom')}) IN {in_list(lex.RISKY_TLDS)})::INT::DOUBLE AS sender_suspicious_tld,
  {term_sum('norm', lex.FOLDED['urgency'])}::DOUBLE AS urgency_term_count,
  {term_sum('norm', lex.FOLDED['credential'])}::DOUBLE AS credential_term_count,
  {term_sum('norm', lex.FOLDED['lure'])}::DOUBLE AS lure_term_count,
  {_any(text_list(lex.FOLDED['greeting']), 'g', 'contains(norm, g)')} AS generic_greeting,
  {rnd("(length(text) - length(replace(text, '!', ''))) / greatest(length(text), 1)")} AS exclamation_ratio,
  {rnd(upper)} AS uppercase_ratio,
  (lower(spf) IN ('fail', 'softfail'))::INT::DOUBLE AS spf_fail,
  (lower(dkim) = 'fail')::INT::DOUBLE AS dkim_fail,
  (lower(dmarc) = 'fail')::INT::DOUBLE AS dmarc_fail,
  (lower(spf) = 'none' AND lower(dkim) = 'none' AND lower(dmarc) = 'none')::INT::DOUBLE AS auth_missing,
  (len(attachments) > 0)::INT::DOUBLE AS has_attachment,
  {_any('attachments', 'x', f"contains(x, '.') AND lower(string_split(x, '.')[-1]) IN {in_list(lex.DANGEROUS_EXTENSIONS)}")} AS dangerous_attachment,
  length(body)::DOUBLE AS body_length,
  (has_html AND len(list_filter(list_transform(list_zip(regexp_extract_all(body, '{_ANCHOR}', 1), regexp_extract_all(body, '{_ANCHOR}', 2)), lambda z: {{'h': z[1], 't': z[2]}}), lambda a: contains(lower({shown}), 'http') AND ({domain_expr(shown)}) <> '' AND ({domain_expr('a.h')}) <> '' AND {last_two(f'({domain_expr(shown)})')} <> {last_two(f"({domain_expr('a.h')})")})) > 0)::INT::DOUBLE AS link_text_mismatch
  FROM {prefix}_2)"""


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def mail_query(select: str, *ctes: str) -> str:
    return with_ctes(MAIL, *ctes, select=select)


FEATURE_COLS = ", ".join(FEATURES)
