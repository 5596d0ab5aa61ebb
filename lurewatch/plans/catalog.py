"""Query catalogue: name -> (Spark callable, equivalent SQL or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lurewatch import lexicons as lex, ship
from lurewatch.functions import lexicon_scan
from lurewatch.functions.text import host_of_url
from lurewatch.operators import (
    augment, campaign, canonicalize, evaluate, explain, features as feat, highlight, model, perturb,
    robustness, sampling, scoring, textvec, trend,
)
from lurewatch.plans import oracle_attack as oa, oracle_base as ob, oracle_model as om
from lurewatch.schema import FEATURES, PHISHING_FAMILIES
from lurewatch.sources import mail as mail_source, weights
from lurewatch.sources.fixture import RECEIVED_STEP, mail_stream_view, mail_view, table, with_event_times, with_events
from lurewatch.sources.reports import stored, work_folder
from lurewatch.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Query, str | None]] = {}

_ROUNDED = {"url_https_ratio", "url_max_entropy", "exclamation_ratio", "uppercase_ratio"}


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        CATALOG[name] = (run, sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6, only: set[str] | None = None) -> DataFrame:
    """Round double columns: engines add in different orders."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if t == "double" and (only is None or c in only) else F.col(c)
            for c, t in df.dtypes
        ]
    )


def _blocks(*blocks: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(feat.feature_blocks(mail_view(spark, sf_dir), list(blocks)), only=_ROUNDED)

    return run


def _features_sql(columns: list[str]) -> str:
    return ob.mail_query(f"SELECT mail_id, {', '.join(columns)} FROM f", ob.features_ctes("mail"))


for _name, _parts in {
    "mail_url_features": ["url"],
    "mail_lookalike": ["lookalike"],
    "mail_homoglyph": ["homoglyph"],
    "mail_sender_features": ["sender"],
    "mail_text_features": ["text", "length"],
    "mail_auth_features": ["auth"],
    "mail_attachment_features": ["attachment"],
    "mail_link_mismatch": ["link"],
}.items():
    _cols = [c for p in _parts for c in feat._BLOCK_COLUMNS[p]]
    register(_name, _features_sql(_cols))(_blocks(*_parts))


@register("mail_features", _features_sql(FEATURES))
def mail_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feat.mail_features(mail_view(spark, sf_dir)), only=_ROUNDED)


# --- Text block ---------------------------------------------------------------------------


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textvec.with_clean_text(mail_view(spark, sf_dir)).select("mail_id", "clean")


@register("clean_text", ob.mail_query("SELECT * FROM clean", om.clean_cte("mail")))
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


def _text_sql(kind: str, select: str) -> str:
    tokens = om.word_token_cte() if kind == "word" else om.char_token_cte()
    return ob.mail_query(select, om.clean_cte("mail"), tokens, om.tfidf_ctes(textvec.LIMITS[kind]))


def _register_text(kind: str) -> None:
    @register(f"term_document_frequency_{kind}", _text_sql(kind, "SELECT * FROM tdf"))
    def frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
        return textvec.term_document_frequency(_clean(spark, sf_dir), kind)

    @register(
        f"vocabulary_{kind}",
        _text_sql(kind, "SELECT term, df, total_tf, round(idf, 6) AS idf FROM vocab"),
    )
    def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(textvec.vocabulary(_clean(spark, sf_dir), kind))

    @register(
        f"tfidf_{kind}",
        _text_sql(kind, "SELECT mail_id, term, tf::INT AS tf, round(weight, 6) AS weight FROM tfidf"),
    )
    def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
        clean = _clean(spark, sf_dir)
        return rounded(textvec.fit_text_space(clean, kind).long_weights(clean))


_register_text("word")
_register_text("char")

_TOP_SQL = """SELECT mail_id, rank::INT AS rank, term, round(c, 6) AS contribution FROM (
  SELECT mail_id, term, c, row_number() OVER (PARTITION BY mail_id ORDER BY abs(c) DESC, term) AS rank
  FROM (SELECT mail_id, term, round(weight * {w}, 9) AS c FROM tfidf {join})) WHERE rank <= 8"""


@register("top_terms", _text_sql("word", _TOP_SQL.format(w="1", join="")))
def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    return rounded(textvec.fit_text_space(clean).top_terms(clean))


@register(
    "term_contributions",
    ob.mail_query(
        _TOP_SQL.format(w="coalesce(tw.w, 0)", join="LEFT JOIN tw USING (term)"),
        om.clean_cte("mail"), om.word_token_cte(), om.tfidf_ctes(textvec.LIMITS["word"]),
        om.term_values(),
    ),
)
def term_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    learnt = {t: w for t, (w, _) in weights.TERM_WEIGHTS.items()}
    return rounded(textvec.fit_text_space(clean).top_terms(clean, learnt))


_LEX_ROWS = ", ".join(
    "('{}', '{}', '{}')".format(k, t.replace("'", "''"), lex.HIGHLIGHT_NOTES[k].replace("'", "''"))
    for k, ts in lex.FOLDED.items() for t in ts
)
_GLYPH_ROWS = ", ".join(f"('{c}', '{v}')" for c, v in lex.HOMOGLYPHS.items())
_URL_HOST = "string_split(string_split(regexp_replace(url, '^https?://', ''), '/')[1], ':')[1]"
_HIGHLIGHT_SQL = rf"""SELECT mail_id, row_number() OVER (PARTITION BY mail_id ORDER BY start, stop DESC, kind)::INT AS pos,
  start::INT AS "start", stop::INT AS "end", kind, snippet, note FROM (
SELECT DISTINCT mail_id, start, start + length(term) AS stop, kind, substr(text, start + 1, length(term)) AS snippet, note FROM (
  SELECT mail_id, text, term, kind, note, list_sum(list_transform(parts[1:k], lambda p: length(p)))::BIGINT + (k - 1) * length(term) AS start
  FROM (SELECT *, unnest(range(1, len(parts))) AS k FROM (
    SELECT mail_id, text, term, kind, note, string_split(strip_accents(lower(text)), term) AS parts
    FROM t, (VALUES {_LEX_ROWS}) l(kind, term, note))))
UNION ALL SELECT mail_id, k - 1, k, 'homoglyph', c, 'Caractère trompeur ''' || c || ''' imitant ''' || latin || '''' FROM (
  SELECT mail_id, unnest(string_split(text, '')) AS c, unnest(range(1, length(text) + 1)) AS k FROM t)
  JOIN (VALUES {_GLYPH_ROWS}) g(c, latin) USING (c)
UNION ALL SELECT mail_id, start, start + length(url), 'url', url, CASE
  WHEN {ob.distance('host')} <= 2 THEN 'Domaine très proche d''une marque connue (' || dom || ') - possible typosquatting'
  WHEN regexp_matches(dom, '\.({'|'.join(lex.NOTE_TLDS)})$') THEN 'Extension de domaine à risque (' || dom || ')'
  WHEN regexp_matches(host, '^(\d{{1,3}}\.){{3}}\d{{1,3}}') THEN 'L''URL pointe vers une adresse IP brute'
  WHEN starts_with(lower(url), 'http://') THEN 'Lien non chiffré (http) - destination à vérifier'
  ELSE 'Lien présent dans le message' END FROM (SELECT *, {ob.last_two('host')} AS dom FROM (
  SELECT mail_id, urls[k] AS url, {_URL_HOST.replace('url', 'urls[k]')} AS host, list_sum(list_transform(parts[1:k], lambda p: length(p))) +
    coalesce(list_sum(list_transform(urls[1:k - 1], lambda p: length(p))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(urls) + 1)) AS k FROM (SELECT mail_id, regexp_extract_all(text, '{ob.URL_RE}') AS urls,
    string_split_regex(text, '{ob.URL_RE}') AS parts FROM t)))))"""
_TEXTS = "t AS (SELECT mail_id, subject || chr(10) || body AS text FROM mail)"


# --- Linear scorer and explanations ---------------------------------------------------------


#: The deployed scorer with its own mean and scale: a mail has one score in every table.
DEPLOYED = weights.LinearScorer()


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = mail_view(spark, sf_dir)
    keep = ("mail_id", "label", "noisy_label", "family")
    return scoring.linear_score(mail, DEPLOYED, keep).select(*keep, "score", "logit")


@register(
    "fit_scaler",
    ob.mail_query(
        " UNION ALL ".join(
            f"SELECT {i} AS feature_idx, '{f}' AS feature, round(m_{f}, 6) AS mean, "
            f"round(s_{f}, 6) AS scale FROM sc"
            for i, f in enumerate(FEATURES)
        ),
        ob.features_ctes("mail", exact=True), om.FIT,
    ),
)
def fit_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.fit_scaler(feat.mail_features(mail_view(spark, sf_dir))))


@register(
    "linear_score",
    ob.mail_query(
        "SELECT mail_id, round(logit, 6) AS logit, round(score, 6) AS score FROM scored", *om.SCORED
    ),
)
def linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scores(spark, sf_dir).select("mail_id", "logit", "score"))


@register(
    "triage",
    ob.mail_query(
        """SELECT mail_id, round(score, 6) AS score,
  CASE WHEN score >= 0.7 THEN 'phishing' WHEN score >= 0.4 THEN 'suspect' ELSE 'benin' END AS verdict,
  (score >= 0.5)::INT AS predicted,
  CASE WHEN score BETWEEN 0.35 AND 0.65 THEN 'incertain' ELSE 'confiant' END AS confidence
FROM scored""",
        *om.SCORED,
    ),
)
def triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.triage(_scores(spark, sf_dir).select("mail_id", "score")))


def _explained(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        mail = mail_view(spark, sf_dir)
        return rounded(fn(feat.mail_features(mail), DEPLOYED))

    return run


_PHI_CTES = (ob.features_ctes("mail", exact=True), om.DEPLOYED, om.PHI)
register(
    "attributions",
    ob.mail_query("SELECT mail_id, feature_idx, feature, round(phi, 6) AS phi FROM phi", *_PHI_CTES),
)(_explained(scoring.attributions))
_REASON_SQL = (
    "SELECT mail_id, rank::INT AS rank, feature, text, round(weight, 6) AS weight, "
    "'{d}' AS direction FROM {t}"
)
register(
    "explain_reasons",
    ob.mail_query(_REASON_SQL.format(d="augmente", t="reasons"), *_PHI_CTES, om.HUMAN, om.REASONS),
)(_explained(explain.explain_reasons))
register(
    "explain_protective",
    ob.mail_query(
        _REASON_SQL.format(d="diminue", t="protective"), *_PHI_CTES, om.CALM, om.PROTECTIVE
    ),
)(_explained(explain.explain_protective))


@register(
    "explain_rules",
    ob.mail_query(
        _REASON_SQL.format(d="augmente", t="""(SELECT *, row_number() OVER (PARTITION BY mail_id
  ORDER BY feature_idx) AS rank FROM v JOIN human USING (feature) WHERE weight <> 0) WHERE rank <= 6"""),
        ob.features_ctes("mail"), om.HUMAN,
        "v AS (" + " UNION ALL ".join(
            f"SELECT mail_id, {i} AS feature_idx, '{f}' AS feature, {f} AS weight FROM f"
            for i, f in enumerate(FEATURES)
        ) + ")",
    ),
)
def explain_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.explain_rules(feat.mail_features(mail_view(spark, sf_dir))))


@register(
    "explain_mail",
    ob.mail_query(
        om.EXPLAIN, *om.SCORED, om.PHI, om.HUMAN, om.REASONS, om.CALM, om.PROTECTIVE
    ),
)
def explain_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.explain_mail(mail_view(spark, sf_dir), DEPLOYED).select(
        "mail_id", "score", "label", "summary", _listed("reasons", "feature"), _listed("protective", "feature"),
    )


def _listed(array: str, field: str):
    return F.array_join(F.transform(array, lambda x: x[field]), ",").alias(array)


@register(
    "analyze_mail",
    ob.mail_query(
        f"""SELECT x.*, coalesce(h.highlights, '') AS highlights, coalesce(nt.nlp_terms, '') AS nlp_terms FROM ({om.EXPLAIN}) x
LEFT JOIN (SELECT mail_id, string_agg("start" || '-' || "end" || ':' || kind || ':' || snippet, ',' ORDER BY pos) AS highlights
  FROM spans GROUP BY mail_id) h USING (mail_id)
LEFT JOIN (SELECT mail_id, string_agg(term, ',' ORDER BY abs(v) DESC, term) AS nlp_terms FROM (SELECT *,
  row_number() OVER (PARTITION BY mail_id ORDER BY abs(v) DESC, term) AS k FROM (
  SELECT mail_id, term, round(w * idf * (1 + ln(count(*))), 9) AS v FROM tokens JOIN tw USING (term) GROUP BY mail_id, term, w, idf))
  WHERE k <= 8 GROUP BY mail_id) nt USING (mail_id)""",
        *om.SCORED, om.PHI, om.HUMAN, om.REASONS, om.CALM, om.PROTECTIVE, _TEXTS, f"spans AS ({_HIGHLIGHT_SQL})",
    ),
)
def analyze_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main call: everything about a mail in one row (lists as text, for comparison)."""
    mark = lambda h: F.concat(h["start"].cast("string"), F.lit("-"), h["end"].cast("string"), F.lit(":"), h["kind"], F.lit(":"), h["snippet"])
    return explain.analyze_mail(mail_view(spark, sf_dir), DEPLOYED).select(
        "mail_id", "score", "label", "summary", _listed("reasons", "feature"), _listed("protective", "feature"),
        F.array_join(F.transform("highlights", mark), ",").alias("highlights"), _listed("nlp_terms", "term"),
    )


@register(
    "parse_payloads",
    """SELECT doc_id AS mail_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE text END AS body,
  CASE doc_id % 3 WHEN 0 THEN 'fail' ELSE 'none' END AS spf, doc_id % 2 = 1 AS has_html,
  CASE WHEN doc_id % 4 = 3 THEN 3 ELSE 1 END AS num_recipients, CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 0 END AS n_attachments
FROM documents""",
)
def parse_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON payloads with fields left out, null, blank or zero, and read back."""
    i, none = F.col("doc_id"), F.lit(None)
    fields = F.struct(
        i.alias("mail_id"), F.when(i % 5 != 0, F.col("text")).alias("body"),
        F.when(i % 3 == 0, "fail").when(i % 3 == 1, "").alias("spf"),
        F.when(i % 2 == 1, True).otherwise(none).alias("has_html"),
        F.when(i % 4 == 3, 3).when(i % 4 == 2, 0).alias("num_recipients"),
        F.when(i % 7 == 0, F.array(F.lit("a.pdf"), F.lit("b.exe"))).alias("attachments"),
    )
    payloads = table(spark, sf_dir, "documents").select(F.to_json(fields).alias("value"))
    return mail_source.parse_payloads(payloads).select(
        "mail_id", "body", "spf", "has_html", "num_recipients", F.size("attachments").alias("n_attachments")
    )


@register(
    "coerce_csv",
    """SELECT doc_id AS mail_id, text AS body, CASE WHEN doc_id % 3 = 0 THEN 'softfail' ELSE 'none' END AS dkim,
  doc_id % 4 = 1 AS has_html, CASE doc_id % 5 WHEN 0 THEN 7 WHEN 1 THEN 2 ELSE 1 END AS num_recipients,
  CASE WHEN doc_id % 6 < 3 THEN 1 ELSE 0 END AS label, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 0 END AS n_attachments FROM documents""",
)
def coerce_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as all-text rows with numbers in every spelling, made typed mails."""
    i = F.col("doc_id")
    pick = lambda n, *values: F.get(F.array(*map(F.lit, values)), (i % n).cast("int"))
    text = {c: F.lit("") for c in ("subject", "sender_display", "sender_email", "reply_to", "spf", "dmarc")}
    raw = table(spark, sf_dir, "documents").select(
        i.cast("string").alias("mail_id"), F.col("text").alias("body"), *[v.alias(c) for c, v in text.items()],
        pick(3, "softfail", "", None).alias("dkim"), pick(4, "0", "1.0", "", "no").alias("has_html"),
        pick(5, "7", " 2.0 ", "0", "", None).alias("num_recipients"),
        pick(6, "1", "1.0", " 1e0", "0.0", "", None).alias("label"), pick(2, "a.png;b.txt", " ").alias("attachments"),
    )
    return mail_source.coerce_csv(raw).select(
        "mail_id", "body", "dkim", "has_html", "num_recipients", "label", F.size("attachments").alias("n_attachments")
    )


# --- Evaluation ------------------------------------------------------------------------------


def _evaluated(name: str, sql: str, fn, *ctes: str) -> None:
    @register(name, ob.mail_query(sql, *om.SCORES, *ctes))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = fn(_scores(spark, sf_dir).drop("logit"))
        return rounded(report, only=set(report.columns) - {"threshold"})


_evaluated("binary_metrics", om.BINARY, evaluate.binary_metrics)
_evaluated("family_report", om.FAMILY, evaluate.family_report)
_evaluated("ranking_metrics", om.RANKING, evaluate.ranking_metrics, om.CUMULATIVE)
_evaluated("roc_points", om.ROC, evaluate.roc_points, om.CUMULATIVE)
_evaluated("pr_points", om.PR, evaluate.pr_points, om.CUMULATIVE)
_evaluated("calibration_bins", om.CALIBRATION, evaluate.calibration_bins)


@register(
    "corpus_profile",
    ob.mail_query(
        "SELECT count(*) AS total, sum(label)::BIGINT AS phishing, sum(1 - label)::BIGINT AS benign, "
        "count(*) FILTER (WHERE label <> noisy_label) AS noisy, "
        "round(count(*) FILTER (WHERE label <> noisy_label) / count(*), 6) AS noise_rate FROM mail"
    ),
)
def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.corpus_profile(mail_view(spark, sf_dir)))


@register(
    "class_weights",
    ob.mail_query(
        "SELECT label, count(*) AS n_class, round((SELECT count(*) FROM mail) / "
        "((SELECT count(DISTINCT label) FROM mail) * count(*)), 6) AS class_weight FROM mail GROUP BY label"
    ),
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.class_weights(mail_view(spark, sf_dir)))


# --- Splits, noise, samples --------------------------------------------------------------------


@register("stratified_split", ob.mail_query(om.SPLIT))
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = mail_view(spark, sf_dir).select("mail_id", "label")
    return sampling.stratified_split(mail)


@register("content_split", ob.mail_query(om.CONTENT_SPLIT))
def content_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = mail_view(spark, sf_dir)
    return sampling.threshold_split(mail, F.col("body")).select("mail_id", "split")


@register("kfold_assign", ob.mail_query(om.FOLDS))
def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.kfold_assign(mail_view(spark, sf_dir).select("mail_id", "label"))


@register("inject_label_noise", ob.mail_query(om.NOISE))
def inject_label_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.inject_label_noise(mail_view(spark, sf_dir).select("mail_id", "label"))


@register("sample_n", ob.mail_query(om.SAMPLE))
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    attacks = mail_view(spark, sf_dir).where(F.col("family").isin(*PHISHING_FAMILIES))
    return sampling.sample_n(attacks.select("mail_id", "family", "subject"), 300)


@register("sample_per_group", ob.mail_query(om.PER_GROUP))
def sample_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = mail_view(spark, sf_dir).select("mail_id", "family", "subject")
    return sampling.sample_per_group(mail, 2)


# --- Evasion, canonicalisation, robustness ---------------------------------------------------------


def _register_variant(variant: str) -> None:
    @register(
        f"perturb_{variant}",
        ob.mail_query(
            "SELECT mail_id, subject, body, array_to_string(attachments, ';') AS attachments, has_html FROM p",
            oa.variant_ctes(variant, "mail", "p"),
        ),
    )
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return perturb.perturb_mail(mail_view(spark, sf_dir), variant).select(
            "mail_id", "subject", "body",
            F.array_join("attachments", ";").alias("attachments"), "has_html",
        )


for _variant in perturb.VARIANTS:
    _register_variant(_variant)


@register(
    "canonicalize_mail",
    ob.mail_query("SELECT mail_id, subject, body FROM z", oa.canonical_ctes("mail", "z")),
)
def canonicalize_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonicalize.canonicalize_mail(mail_view(spark, sf_dir)).select(
        "mail_id", "subject", "body"
    )


@register("image_only_guard", ob.mail_query(f"SELECT mail_id, {oa.GUARD} AS guard FROM mail"))
def image_only_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_view(spark, sf_dir).select(
        "mail_id", canonicalize.image_only_guard().alias("guard")
    )


def _attacks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, weights.LinearScorer]:
    mail = mail_view(spark, sf_dir)
    return mail.where(F.col("family").isin(*PHISHING_FAMILIES)), DEPLOYED


@register("robustness_matrix", oa.robustness_sql())
def robustness_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robustness.robustness_matrix(*_attacks(spark, sf_dir))


@register(
    "baseline_detection",
    ob.mail_query(
        f"""SELECT round(count(*) FILTER (WHERE score >= 0.7) / count(*), 6) AS baseline_detection,
  count(*) FILTER (WHERE score >= 0.7) AS n_detected, 0.7::DOUBLE AS threshold
FROM scored JOIN mail USING (mail_id) WHERE family IN {ob.in_list(PHISHING_FAMILIES)}""",
        *om.SCORED,
    ),
)
def baseline_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(robustness.baseline_detection(*_attacks(spark, sf_dir)))


_TERM_ROWS = ", ".join(
    f"('{kind}', '{term.replace(chr(39), chr(39) * 2)}')" for kind, terms in lex.FOLDED.items() for term in dict.fromkeys(terms)
)


@register(
    "lexicon_coverage",
    ob.mail_query(
        f"""SELECT kind, term_norm, count(*) AS mails, sum((length(folded) - length(replace(folded, term_norm, ''))) // length(term_norm))::BIGINT AS hits
FROM (SELECT strip_accents(lower(subject || chr(10) || body)) AS folded FROM mail) t, (VALUES {_TERM_ROWS}) AS l(kind, term_norm)
WHERE contains(folded, term_norm) GROUP BY kind, term_norm""",
    ),
)
def lexicon_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many mails hold each term of the lexicon table, and how often."""
    return lexicon_scan.coverage(mail_view(spark, sf_dir), lex.lexicon_dim(spark))


# --- Hosts, prevalence, risk -------------------------------------------------------------------------


@register(
    "host_lookalike",
    f"""WITH hosts AS (SELECT DISTINCT {ob.host_expr('url')} AS host FROM pages)
SELECT host, {ob.distance('host')} AS lookalike_brand_distance,
  ({ob.digit_fold('host')})::INT AS digit_letter_substitution FROM hosts""",
)
def host_lookalike(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return feat.host_lookalike(pages.select(host_of_url(F.col("url")).alias("host")))


@register(
    "page_host_entropy",
    f"""SELECT page_id, host, round({ob.entropy("string_split(host, '.')[1]")}, 6) AS entropy
FROM (SELECT page_id, {ob.host_expr('url')} AS host FROM pages)""",
)
def page_host_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", host_of_url(F.col("url")).alias("host"))
    label = F.substring_index("host", ".", 1)
    return pages.select("page_id", "host", F.round(feat.entropy(label), 6).alias("entropy"))


def _prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = feat.mail_features(mail_view(spark, sf_dir))
    return trend.technique_prevalence(with_events(features, spark, sf_dir), "day")


_RECEIVED = f"""received AS (SELECT mail_id, a + to_seconds(((mail_id * {RECEIVED_STEP}) % span + span) % span) AS ts FROM mail,
  (SELECT date_trunc('second', min(ts)) AS a, date_diff('second', date_trunc('second', min(ts)), max(ts)) + 1 AS span FROM events))"""
# Every event is dealt to the mails of a document; a mail without one keeps the time of its id.
_DEALT = f"""span AS (SELECT date_trunc('second', min(ts)) AS a, date_diff('second', date_trunc('second', min(ts)), max(ts)) + 1 AS span FROM events),
dealt AS (SELECT event_id % (SELECT greatest(count(*), 1) FROM documents) AS place, ts FROM events),
received AS (SELECT mail_id, coalesce(ts, a + to_seconds(((mail_id * {RECEIVED_STEP}) % span + span) % span)) AS ts
  FROM (SELECT DISTINCT mail_id FROM mail) CROSS JOIN span LEFT JOIN dealt ON place = greatest(mail_id, -1 - mail_id))"""
_TIMED = (
    _DEALT + """, timed AS (SELECT mail_id, date_diff('day', DATE '1970-01-01', ts::DATE)::INT AS period FROM received)""",
    ob.features_ctes("mail"),
    """prev AS (SELECT technique, period, avg(v) AS prevalence, count(*) AS n FROM (
  SELECT period, 'url_shortener' AS technique, url_uses_shortener AS v FROM f JOIN timed USING (mail_id)
  UNION ALL SELECT period, 'lookalike_domain', (lookalike_brand_distance BETWEEN 1 AND 2)::INT FROM f JOIN timed USING (mail_id)
  UNION ALL SELECT period, 'homoglyph', has_homoglyph FROM f JOIN timed USING (mail_id))
  GROUP BY technique, period)""",
    """fit AS (SELECT technique, coalesce(regr_slope(y, period), 0) AS k,
  avg(y) - coalesce(regr_slope(y, period), 0) * avg(period) AS b, max(period) AS last_period,
  arg_max(prevalence, period) AS last_prevalence FROM (SELECT *, ln(v / (0.95::DOUBLE - v)) AS y FROM (
  SELECT *, greatest(0.001::DOUBLE, least(0.949::DOUBLE, prevalence)) AS v FROM prev)) GROUP BY technique)""",
    """future AS (SELECT technique, period, round(least(greatest(0.95::DOUBLE / (1 + exp(-(k * period + b))), 0), 0.99), 3) AS prevalence
  FROM (SELECT *, unnest(range(last_period + 1, (SELECT max(period) FROM prev) + 4)) AS period FROM fit))""",
)
_NAMED = (
    "CASE technique WHEN 'url_shortener' THEN 'Raccourcisseurs d''URL' "
    "WHEN 'lookalike_domain' THEN 'Domaines sosies (typosquat)' ELSE 'Homoglyphes Unicode' END AS label"
)


@register(
    "technique_prevalence",
    ob.mail_query(
        "SELECT technique, period, round(prevalence, 6) AS prevalence, n FROM prev", *_TIMED[:3]
    ),
)
def technique_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_prevalence(spark, sf_dir))


@register(
    "technique_trend",
    ob.mail_query(
        "SELECT technique, round(k, 6) AS k, round(b, 2) AS b, last_period, "
        "round(last_prevalence, 6) AS last_prevalence FROM fit",
        *_TIMED[:4],
    ),
)
def technique_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = rounded(trend.technique_trend(_prevalence(spark, sf_dir)))
    return fit.withColumn("b", F.round("b", 2))


def _forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    # three periods beyond the last one of any series
    return trend.technique_forecast(_prevalence(spark, sf_dir), ahead=3)


@register(
    "technique_forecast",
    ob.mail_query(
        f"SELECT technique, period, round(prevalence, 3) AS prevalence, kind, {_NAMED} FROM ("
        "SELECT technique, period, prevalence, 'history' AS kind FROM prev UNION ALL "
        "SELECT technique, period, prevalence, 'forecast' FROM future)",
        *_TIMED,
    ),
)
def technique_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_forecast(spark, sf_dir), 3)


@register(
    "trend_direction",
    ob.mail_query(
        """SELECT technique, round(h, 3) AS last_history, round(p, 3) AS last_forecast,
  CASE WHEN p > h THEN 'up' ELSE 'down' END AS direction FROM (
  SELECT technique, arg_max(prevalence, period) AS p FROM future GROUP BY technique) JOIN (
  SELECT technique, arg_max(prevalence, period) AS h FROM prev GROUP BY technique) USING (technique)""",
        *_TIMED,
    ),
)
def trend_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trend.trend_direction(_forecast(spark, sf_dir)), 3)


_LEVERS = """levers AS (SELECT mail_id, unnest(list_filter([
  CASE WHEN urgency_term_count > 0 THEN 0.55 END, CASE WHEN sender_display_domain_mismatch > 0 THEN 0.60 END,
  CASE WHEN credential_term_count > 0 THEN 0.45 END, CASE WHEN lure_term_count > 0 THEN 0.50 END,
  CASE WHEN url_uses_shortener > 0 THEN 0.40 END], lambda x: x IS NOT NULL))::DOUBLE AS w FROM f),
persuasion AS (SELECT mail_id, coalesce(sum(w * pow(0.85::DOUBLE, rank - 1)), 0) AS p FROM f LEFT JOIN (
  SELECT mail_id, w, row_number() OVER (PARTITION BY mail_id ORDER BY w DESC) AS rank FROM levers) USING (mail_id) GROUP BY mail_id),
risk AS (SELECT mail_id, p, 1 / (1 + exp(-1.7::DOUBLE * (p - 1.35::DOUBLE))) AS base FROM persuasion)"""


@register(
    "campaign_risk",
    ob.mail_query(
        """SELECT mail_id, training, round(p, 6) AS persuasion, round(base, 6) AS base_rate,
  round(base * (1 - cut), 6) AS adjusted_rate FROM risk CROSS JOIN (VALUES ('aucune', 0.0::DOUBLE),
  ('sensibilisation_de_base', 0.45), ('formation_reguliere', 0.70), ('simulations_repetees', 0.82)) l(training, cut)""",
        ob.features_ctes("mail"), _LEVERS,
    ),
)
def campaign_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = campaign.mail_levers(feat.mail_features(mail_view(spark, sf_dir)))
    scenarios = mails.select("mail_id", F.col("mail_id").alias("scenario"), "levers")
    return rounded(campaign.campaign_risk(scenarios).drop("scenario", "levers"))


@register(
    "top_weights",
    _text_sql("word", "SELECT term, round(w, 6) AS w, round(idf, 6) AS idf FROM (SELECT vocab.term, "
              "tw.w, vocab.idf FROM vocab JOIN tw USING (term)) ORDER BY abs(w) DESC, term LIMIT 400").replace(
        "WITH ", "WITH " + om.term_values() + ",\n", 1),
)
def top_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = textvec.vocabulary(_clean(spark, sf_dir)).select("term", "idf")
    learnt = weights.LinearScorer().term_frame(spark).select("term", "w")
    return rounded(weights.top_weights(vocab.join(F.broadcast(learnt), "term")))


# --- Highlights ---------------------------------------------------------------------------------------

@register(
    "highlight_spans",
    ob.mail_query(
        _HIGHLIGHT_SQL, _TEXTS
    ),
)
def highlight_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return highlight.highlight_spans(mail_view(spark, sf_dir))


# --- Training (rows-only: iterative fits) ---------------------------------------------------------------


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # the rows carry their side; joining it back would multiply equal ids
    joined = stored(sampling.stratified_split(mail_view(spark, sf_dir)), "split")
    return tuple(joined.where(F.col("split") == s).drop("split") for s in ("train", "test"))


@register("fit_calibrated")
def fit_calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic model on all three blocks; scores of the test side."""
    train, test = _split(spark, sf_dir)
    scored = model.train(train, model.ModelSpec("logreg")).score_mail(test, ("mail_id", "label"))
    return rounded(scored, 4)


@register("export_weights")
def export_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 400 heaviest word weights of the linear model fitted on all three blocks."""
    train, _ = _split(spark, sf_dir)
    scorer = model.train(train, model.ModelSpec("logreg")).linear_scorer()
    return rounded(weights.top_weights(scorer.term_frame(spark), 400), 4)


@register("compare_models")
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three model kinds on all three blocks."""
    specs = [model.ModelSpec(k) for k in ("logreg", "rf", "gbt")]
    return rounded(model.compare_models(*_split(spark, sf_dir), specs), 4)


@register("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(model.feature_importance(mail_view(spark, sf_dir)), 4)


# --- Streaming and corpus ---------------------------------------------------------------------------------


@register(
    "drift_windows",
    ob.mail_query(
        "SELECT date_trunc('day', ts) AS window_start, count(*) AS n, round(avg(score), 6) AS mean_score, "
        "round(avg((score >= 0.7)::INT), 6) AS alert_rate, "
        + ", ".join(
            f"count(*) FILTER (WHERE least(floor(score * 10), 9) = {b}) AS bin_{b}" for b in range(10)
        )
        + " FROM scored JOIN received USING (mail_id) GROUP BY 1",
        *om.SCORED, _DEALT,
    ),
)
def drift_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scoring.linear_score(mail_view(spark, sf_dir), DEPLOYED).select("mail_id", "score")
    return rounded(jobs.drift_windows(with_events(scores, spark, sf_dir)))


def _timed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = with_event_times(mail_view(spark, sf_dir), spark, sf_dir)
    return scoring.linear_score(mail, DEPLOYED, ("mail_id", "received_at")).select("mail_id", "received_at", "score")


_BINS = ", ".join(f"count(*) FILTER (WHERE bin = {b}) AS n{b}" for b in range(10))


@register(
    "drift_psi",
    ob.mail_query(
        "SELECT window_start, n, round(" + " + ".join(
            f"(greatest(n{b} / n, 1e-4::DOUBLE) - greatest(e{b}, 1e-4::DOUBLE)) "
            f"* ln(greatest(n{b} / n, 1e-4::DOUBLE) / greatest(e{b}, 1e-4::DOUBLE))" for b in range(10)
        ) + ", 6) AS psi FROM days, base",
        *om.SCORED, _RECEIVED,
        "binned AS (SELECT date_trunc('day', ts) AS window_start, least(floor(score * 10), 9) AS bin FROM scored JOIN received USING (mail_id))",
        f"days AS (SELECT window_start, count(*) AS n, {_BINS} FROM binned GROUP BY 1)",
        "base AS (SELECT " + ", ".join(f"avg((bin = {b})::INT) AS e{b}" for b in range(10))
        + " FROM binned WHERE window_start < (SELECT min(window_start) + INTERVAL 7 DAY FROM binned))",
    ),
)
def drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day against the first week."""
    scores = stored(_timed_scores(spark, sf_dir), "timed_scores")
    day = F.date_trunc("day", F.col("received_at"))
    week = scores.agg(F.min(day)).scalar() + F.make_interval(days=F.lit(7))
    baseline = jobs.baseline_histogram(scores.where(day < week))
    return rounded(jobs.population_stability(jobs.drift_windows(scores), baseline).select("window_start", "n", "psi"))


@register(
    "score_stream",
    ob.mail_query(
        """SELECT mail_id, round(score, 6) AS score,
  CASE WHEN score >= 0.7 THEN 'phishing' WHEN score >= 0.4 THEN 'suspect' ELSE 'benin' END AS verdict,
  (score >= 0.5)::INT AS predicted,
  CASE WHEN score BETWEEN 0.35 AND 0.65 THEN 'incertain' ELSE 'confiant' END AS confidence
FROM scored""",
        *om.SCORED,
    ),
)
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents read as a file stream, scored into parquet, read back."""
    folder = f"{work_folder(spark)}/score_stream_{uuid.uuid4().hex}"
    query = jobs.start_scoring(mail_stream_view(spark, sf_dir), DEPLOYED, f"{folder}/out", f"{folder}/cp")
    query.awaitTermination()
    return rounded(spark.read.parquet(f"{folder}/out"))


_AUGMENTED = f"""w AS (SELECT mail_id, string_split(body, ' ') AS w, body FROM (SELECT mail_id, replace(body, 'Bonjour,',
  ['Bonjour,', 'Bonjour, ', 'Madame, Monsieur,', 'Cher client,', 'Hello,'][{om.draw('hello', 'mail_id')} % 5 + 1]) AS body FROM mail)),
spots AS (SELECT *, {om.draw('typo_word', 'mail_id')} % greatest(len(w), 1) AS k FROM w),
picked AS (SELECT *, w[k + 1] AS word, {om.draw('typo_at', 'mail_id')} % greatest(length(w[k + 1]) - 2, 1) + 1 AS j FROM spots),
typo AS (SELECT mail_id, CASE WHEN {om.draw('typo', 'mail_id')} < {int(0.3 * (1 << 32))} AND len(w) > 8 AND length(word) > 4
  AND regexp_full_match(word, '\\p{{L}}+') THEN array_to_string(list_concat(w[1:k], [substr(word, 1, j) || substr(word, j + 2, 1)
  || substr(word, j + 1, 1) || substr(word, j + 3)], w[k + 2:]), ' ') ELSE body END AS body FROM picked)"""


@register(
    "augment_text",
    ob.mail_query(
        f"""SELECT mail_id, CASE WHEN {om.draw('squeeze', 'mail_id')} < {int(0.25 * (1 << 32))}
  THEN trim(replace(body, chr(10) || chr(10), chr(10)), ' ' || chr(10) || chr(9) || chr(13)) ELSE body END AS body FROM typo""",
        _AUGMENTED,
    ),
)
def augment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return augment.augment_text(mail_view(spark, sf_dir)).select("mail_id", "body")
