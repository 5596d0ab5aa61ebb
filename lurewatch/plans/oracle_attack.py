"""SQL of the perturbation, canonicalisation and robustness checks."""

from __future__ import annotations

from lurewatch import lexicons as lex
from lurewatch.functions.draws import PRIME, below
from lurewatch.operators.perturb import VARIANTS, _both_cases
from lurewatch.plans import oracle_base as ob, oracle_model as om
from lurewatch.schema import PHISHING_FAMILIES

_OTHERS = (
    "sender_display, sender_email, reply_to, spf, dkim, dmarc, num_recipients, label, "
    "noisy_label, family"
)
W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"


def _seed(stream: int) -> str:
    return f"((mail_id % {PRIME}) * 48271 + {stream * 69621 + 11}) % {PRIME}"


def _draw(stream: int, k: str) -> str:
    s = f"({_seed(stream)})"
    a = f"((({s} + {k}) * 16807 + 12345) % {PRIME})"
    return f"((((({a} * {a}) + {s}) % {PRIME}) * 48271 + {k}) % {PRIME})"


def _chars(text: str, body: str) -> str:
    return f"array_to_string(list_transform(string_split({text}, ''), lambda c, k: {body}), '')"


def _swap(text: str, stream: int, p: float, pairs: tuple[str, str]) -> str:
    src, dst = pairs
    return _chars(
        text,
        f"CASE WHEN c IN {ob.in_list(src)} AND {_draw(stream, '(k - 1)')} < {below(p)} "
        f"THEN translate(c, '{src}', '{dst}') ELSE c END",
    )


def _homoglyph(text: str, stream: int, p: float) -> str:
    return _swap(text, stream, p, _both_cases(lex.LATIN_TO_HOMOGLYPH, str.upper))


def _zero_width(text: str, stream: int, p: float) -> str:
    marks = "[" + ", ".join(f"chr({ord(z)})" for z in lex.ZERO_WIDTH) + "]"
    d = _draw(stream, "(k - 1)")
    return _chars(
        text,
        f"CASE WHEN {d} < {below(p)} AND regexp_matches(c, '\\p{{L}}') "
        f"THEN c || {marks}[({d} % 5)::INT + 1] ELSE c END",
    )


def _spacing(text: str, stream: int) -> str:
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), lambda w, k: CASE WHEN "
        f"length(w) >= 4 AND {_draw(stream, '(k - 1)')} < {below(0.75)} "
        f"THEN array_to_string(string_split(w, ''), ' ') ELSE w END), ' ')"
    )


def _pct(text: str, extra: str = "") -> str:
    return _chars(
        text,
        f"CASE WHEN regexp_matches(c, '\\p{{L}}'){extra} THEN '%' || format('{{:x}}', ord(c)) ELSE c END",
    )


def _on_urls(text: str, rewrite) -> str:
    parts, urls = f"string_split_regex({text}, '{ob.URL_RE}')", f"regexp_extract_all({text}, '{ob.URL_RE}')"
    return (
        f"CASE WHEN len({urls}) = 0 THEN {text} ELSE array_to_string(list_transform("
        f"list_zip({parts}, {urls}), lambda z, i: z[1] || CASE WHEN z[2] IS NULL THEN '' "
        f"ELSE {rewrite('z[2]', '(i - 1)')} END), '') END"
    )


def _obfuscate(url: str, i: str) -> str:
    part = lambda n: f"regexp_extract({url}, '^(https?://)([^/]+)(.*)', {n})"
    scheme, host, rest = part(1), part(2), part(3)
    keep = f" AND {_draw(3, '(k - 1 + 2000)')} < {below(0.5)}"
    return (
        f"CASE {_draw(3, i)} % 4 WHEN 0 THEN {scheme} || {_pct(host)} || {rest} "
        f"WHEN 1 THEN {scheme} || {host} || '@evil-' || ({_draw(3, f'({i} + 1000)')} % 99 + 1) || '.tk' || {rest} "
        f"WHEN 2 THEN {scheme} || 'secure-login.' || {host} || '.verify-account.xyz' || {rest} "
        f"ELSE {scheme} || {_pct(host)} || {_pct(rest, keep)} END"
    )


_PRESSURE = r"(?i)\b(?:urgent|immédiatement|tout de suite|sous 24h|maintenant)\b"
_GREETING = r"(?i)\b(?:cher|chère)\s+(?:client|utilisateur|membre|abonné)e?\b[ ,:]*"
_POLISHED = (
    f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '{_GREETING}', "
    f"'Bonjour Camille, ', 'g'), '{_PRESSURE}', 'dans les meilleurs délais', 'g'), '!{{2,}}', '.', 'g'), "
    r"'\s+', ' ', 'g'))"
)
_BODY = (
    f"CASE WHEN contains(lower({_POLISHED}), 'cordialement') THEN {_POLISHED} "
    f"ELSE {_POLISHED} || ' Cordialement, le service client.' END"
)
_SUBJECT = f"coalesce(nullif(trim(regexp_replace(subject, '{_PRESSURE}', '', 'g'), ' :-'), ''), subject)"

_FORMS: dict[str, dict[str, str]] = {
    "char_spacing": {"subject": _spacing("subject", 1), "body": _spacing("body", 2)},
    "homoglyph": {"subject": _homoglyph("subject", 1, 0.6), "body": _homoglyph("body", 2, 0.6)},
    "leetspeak": {
        "subject": _swap("subject", 1, 0.5, _both_cases(lex.LEET, str)),
        "body": _swap("body", 2, 0.5, _both_cases(lex.LEET, str)),
    },
    "zero_width": {"subject": _zero_width("subject", 1, 0.3), "body": _zero_width("body", 2, 0.3)},
    "url_obfuscation": {"body": _on_urls("body", _obfuscate)},
    "image_only": {
        "subject": f"CASE WHEN {_draw(4, '0')} < {below(0.5)} THEN subject ELSE '' END",
        "body": f"['', 'Voir l''image ci-jointe.', '[image]'][({_draw(4, '1')} % 3)::INT + 1]",
        "attachments": "list_append(attachments, 'message.png')",
        "has_html": "true",
    },
    "ia_polie": {"subject": _SUBJECT, "body": _BODY},
}


def variant_ctes(variant: str, src: str, name: str) -> str:
    if variant == "composite_2026":
        return f"""{name}_0 AS (SELECT mail_id, {_OTHERS}, attachments, has_html,
  {_SUBJECT} AS subject, {_BODY} AS body FROM {src}),
{name}_1 AS (SELECT * EXCLUDE (subject, body), {_homoglyph('subject', 6, 0.35)} AS subject,
  {_homoglyph('body', 5, 0.35)} AS body FROM {name}_0),
{name} AS (SELECT mail_id, {_OTHERS}, attachments, has_html, subject, {_zero_width('body', 7, 0.15)} AS body FROM {name}_1)"""
    form = _FORMS[variant]
    cols = ", ".join(
        f"{form.get(c, c)} AS {c}" for c in ("attachments", "has_html", "subject", "body")
    )
    return f"{name} AS (SELECT mail_id, {_OTHERS}, {cols} FROM {src})"


def _canonical_url(url: str, _i: str) -> str:
    plain = f"url_decode({url})"
    part = lambda n: f"regexp_extract({plain}, '^(https?://)([^/]+)(.*)', {n})"
    return (
        f"CASE WHEN regexp_matches({plain}, '^(https?://)([^/]+)(.*)') THEN {part(1)} || "
        f"string_split({part(2)}, '@')[-1] || {part(3)} ELSE {plain} END"
    )


def canonical_ctes(src: str, name: str) -> str:
    """(mail_id, subject, body, ...) canonicalised; spaced letters are joined token by token."""
    table = {k: v for k, v in (lex.HOMOGLYPHS | lex.HOMOGLYPH_CAPITALS).items() if len(v) == 1}
    marks = " || ".join(f"chr({ord(z)})" for z in lex.ZERO_WIDTH)
    single = f"regexp_matches(tok[i], '^{W}$')"
    valid = (
        f"(regexp_matches(tok[i], '(^|{NW}){W}$') AND regexp_matches(tok[i + 1], '^{W}({NW}|$)'))"
    )
    return f"""{name}_0 AS (SELECT mail_id, 'subject' AS part, subject AS t FROM {src} UNION ALL
  SELECT mail_id, 'body', {_on_urls('body', _canonical_url)} FROM {src}),
{name}_1 AS (SELECT mail_id, part, string_split(translate(translate(t, {marks}, ''),
  '{''.join(table)}', '{''.join(table.values())}'), ' ') AS tok FROM {name}_0),
{name}_2 AS (SELECT *, list_transform(range(1, len(tok)), lambda i: {valid}) AS v,
  list_transform(range(1, len(tok) + 1), lambda i: {single}) AS one FROM {name}_1),
{name}_3 AS (SELECT mail_id, part, array_to_string(list_transform(range(1, len(tok) + 1), lambda i:
  tok[i] || CASE WHEN i = len(tok) THEN '' WHEN v[i] AND ((i > 1 AND v[i - 1] AND one[i]) OR
  (i + 1 < len(tok) AND v[i + 1] AND one[i + 1])) THEN '' ELSE ' ' END), '') AS t FROM {name}_2),
{name}_4 AS (SELECT mail_id, part, array_to_string(list_transform(string_split(t, ' '), lambda w:
  CASE WHEN length(regexp_replace(w, '[^\\p{{L}}]', '', 'g')) >= greatest(2, length(w) - 2)
  THEN translate(w, '{''.join(lex.DELEET)}', '{''.join(lex.DELEET.values())}') ELSE w END), ' ') AS t FROM {name}_3),
{name} AS (SELECT * REPLACE (s.t AS subject, b.t AS body) FROM {src}
  JOIN (SELECT mail_id, t FROM {name}_4 WHERE part = 'subject') s USING (mail_id)
  JOIN (SELECT mail_id, t FROM {name}_4 WHERE part = 'body') b USING (mail_id))"""


GUARD = (
    "(len(list_filter(attachments, lambda x: regexp_matches(lower(x), "
    r"'\.(png|jpg|jpeg|gif|svg)$'))) > 0 AND length(regexp_replace(trim(subject || ' ' || body), "
    f"'{NW}', '', 'g')) < 25)"
)


def robustness_sql(variants: list[str] = VARIANTS) -> str:
    """Attacked and defended copies stacked under fresh ids, scored by the same scorer."""
    n = len(variants)
    ctes = [*om.SCORED]
    ctes.append(
        f"detected AS (SELECT mail.* FROM mail JOIN scored USING (mail_id) WHERE score >= 0.7 "
        f"AND family IN {ob.in_list(PHISHING_FAMILIES)})"
    )
    cols = f"{_OTHERS}, attachments, has_html, subject, body"
    for i, v in enumerate(variants):
        ctes.append(variant_ctes(v, "detected", f"v{i}"))
    ctes.append(
        "attacked AS ("
        + " UNION ALL ".join(
            f"SELECT mail_id * {n} + {i} AS mail_id, {cols} FROM v{i}" for i in range(n)
        )
        + ")"
    )
    ctes.append(canonical_ctes("attacked", "defended"))
    ctes.append(
        f"stacked AS (SELECT mail_id * 2 AS mail_id, {cols} FROM attacked UNION ALL "
        f"SELECT mail_id * 2 + 1, {cols} FROM defended)"
    )
    second = [
        ob.features_ctes("stacked", "g", exact=True),
        om.clean_cte("stacked", "gclean"),
        om.word_token_cte("gclean", "gtokens"),
        om.score_ctes("g", "gtokens", "gscored", "g"),
    ]
    names = ob.text_list(variants)
    select = f"""SELECT variant, 1.0::DOUBLE AS detection_clean, round(coalesce(a, 0), 3) AS detection_attacked,
  round(coalesce(d, 0), 3) AS detection_defended, round(1.0 - coalesce(a, 0), 3) AS "drop",
  round(coalesce(d, 0) - coalesce(a, 0), 3) AS recovered, coalesce(n, 0) AS n
FROM (SELECT unnest({names}) AS variant) LEFT JOIN (
  SELECT {names}[((mail_id // 2) % {n})::INT + 1] AS variant, avg(hit) FILTER (WHERE mail_id % 2 = 0) AS a,
    avg(hit) FILTER (WHERE mail_id % 2 = 1) AS d, count(*) FILTER (WHERE mail_id % 2 = 0) AS n
  FROM (SELECT mail_id, (score >= 0.7 OR ({names}[((mail_id // 2) % {n})::INT + 1] = 'image_only'
    AND mail_id % 2 = 1 AND {GUARD}))::INT AS hit FROM gscored JOIN stacked USING (mail_id))
  GROUP BY 1) USING (variant)"""
    return ob.mail_query(select, *ctes, *second)
