"""SQL of the scorer, text vectors, evaluation and sampling checks."""

from __future__ import annotations

from lurewatch import lexicons as lex
from lurewatch.plans import oracle_base as ob
from lurewatch.schema import FEATURES, PHISHING_FAMILIES
from lurewatch.sources import weights as wt


def clean_cte(src: str, name: str = "clean") -> str:
    return rf"""{name} AS (SELECT mail_id, trim(regexp_replace(strip_accents(lower(
  regexp_replace(regexp_replace(subject || chr(10) || body, '{ob.URL_RE}', ' URL_TOKEN ', 'g'),
  '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}', ' EMAIL_TOKEN ', 'g'))),
  '[^a-z0-9_]+', ' ', 'g')) AS clean FROM {src})"""


def word_token_cte(src: str = "clean", name: str = "tokens") -> str:
    return f"""{name}_l AS (SELECT mail_id, list_filter(string_split(clean, ' '),
  lambda w: length(w) >= 2) AS l FROM {src}),
{name} AS (SELECT mail_id, unnest(l) AS term FROM {name}_l UNION ALL
  SELECT mail_id, unnest(list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1])) AS term
  FROM {name}_l)"""


def char_token_cte(src: str = "clean", name: str = "tokens") -> str:
    return f"""{name}_w AS (SELECT mail_id, ' ' || unnest(string_split(clean, ' ')) || ' ' AS w FROM {src}),
{name} AS (SELECT mail_id, substr(w, k::INT, n::INT) AS term FROM (
  SELECT mail_id, w, n, unnest(range(1, greatest(length(w) - n + 1, 1) + 1)) AS k FROM (
    SELECT mail_id, w, unnest(list_filter([3, 4, 5], lambda n: n = 3 OR length(w) >= n)) AS n
    FROM {name}_w WHERE length(w) > 2)))"""


def tfidf_ctes(limits: tuple[int, float, int]) -> str:
    min_df, share, cap = limits
    return f"""tf AS (SELECT mail_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
n AS (SELECT count(*) AS n FROM clean),
tdf AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf FROM tf GROUP BY term),
vocab AS (SELECT term, df, total_tf, ln((1 + n) / (1 + df)) + 1 AS idf FROM tdf, n
  WHERE df >= {min_df} AND df <= {share} * n ORDER BY total_tf DESC, term LIMIT {cap}),
raw AS (SELECT mail_id, term, tf, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term)),
tfidf AS (SELECT mail_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY mail_id)) AS weight
  FROM raw)"""


FIT = (
    "sc AS (SELECT "
    + ", ".join(
        f"avg({f}) AS m_{f}, coalesce(nullif(stddev_pop({f}), 0), 1.0) AS s_{f}" for f in FEATURES
    )
    + " FROM f)"
)


DEPLOYED = (
    "sc AS (SELECT "
    + ", ".join(f"{m!r}::DOUBLE AS m_{f}, {s!r}::DOUBLE AS s_{f}" for f, (_, m, s) in wt.TAB_WEIGHTS.items())
    + ")"
)


def _phi(feature: str) -> str:
    return f"({wt.TAB_WEIGHTS[feature][0]!r}::DOUBLE * ((f.{feature} - m_{feature}) / s_{feature}))"


def term_values() -> str:
    rows = ", ".join(f"('{t}', {w!r}::DOUBLE, {i!r}::DOUBLE)" for t, (w, i) in wt.TERM_WEIGHTS.items())
    return f"tw(term, w, idf) AS (VALUES {rows})"


def score_ctes(feat: str = "f", tokens: str = "tokens", name: str = "scored", tag: str = "") -> str:
    """Needs ``sc``; ``feat`` and ``tokens`` built from the same relation."""
    total = " + ".join(_phi(f) for f in FEATURES)
    return f"""{tag}{term_values()},
{tag}tl AS (SELECT mail_id, sum(w * idf * (1 + ln(tf))) AS tl FROM (
  SELECT mail_id, term, count(*) AS tf FROM {tokens} GROUP BY ALL) JOIN {tag}tw USING (term) GROUP BY mail_id),
{name}_l AS (SELECT f.mail_id, round({wt.INTERCEPT!r}::DOUBLE + {total} + coalesce(tl.tl, 0), 9) AS logit
  FROM {feat} f CROSS JOIN sc LEFT JOIN {tag}tl tl ON tl.mail_id = f.mail_id),
{name} AS (SELECT mail_id, logit, round(1 / (1 + exp(-logit)), 9) AS score FROM {name}_l)"""


SCORED = (ob.features_ctes("mail", exact=True), DEPLOYED, clean_cte("mail"), word_token_cte(), score_ctes())
SCORES = (*SCORED, """scores AS (SELECT scored.mail_id, score, label, noisy_label, family
  FROM scored JOIN mail USING (mail_id))""")

PHI = "phi AS (" + " UNION ALL ".join(
    f"SELECT f.mail_id, {i} AS feature_idx, '{f}' AS feature, {_phi(f)} AS phi FROM f CROSS JOIN sc"
    for i, f in enumerate(FEATURES)
) + ")"


def labels_cte(name: str, texts: dict[str, str]) -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in texts.items())
    return f"{name}(feature, text) AS (VALUES {rows})"


HUMAN = labels_cte("human", lex.HUMAN_LABELS)
CALM = labels_cte(
    "calm",
    {f: lex.PROTECTIVE_TEXTS.get(f, lex.PROTECTIVE_DEFAULT + f) for f in lex.HUMAN_LABELS},
)
REASONS = """reasons AS (SELECT * FROM (SELECT mail_id, feature, text, phi AS weight,
  row_number() OVER (PARTITION BY mail_id ORDER BY round(phi, 9) DESC, feature_idx) AS rank
  FROM phi JOIN human USING (feature) WHERE phi > 0.05) WHERE rank <= 6)"""
PROTECTIVE = """protective AS (SELECT * FROM (SELECT mail_id, feature, text, phi AS weight,
  row_number() OVER (PARTITION BY mail_id ORDER BY round(phi, 9) DESC, feature_idx) AS rank
  FROM phi JOIN calm USING (feature) WHERE phi < -0.05) WHERE rank <= 3)"""

EXPLAIN = """SELECT s.mail_id, round(score, 4) AS score, label,
  CASE label WHEN 'phishing' THEN '⚠️ Risque élevé (' || pct || '%) - ce message présente plusieurs signaux d''attaque.'
   WHEN 'suspect' THEN 'Prudence (' || pct || '%) - ce message présente des éléments ambigus.'
   ELSE 'Risque faible (' || pct || '%) - aucun signal fort de phishing détecté.' END
  || coalesce(' Principaux signaux : ' || t || '.', '') AS summary, coalesce(nr, '') AS reasons,
  coalesce(np, '') AS protective
FROM (SELECT mail_id, score, round_even(score * 100, 0)::INT::VARCHAR AS pct,
  CASE WHEN score >= 0.7 THEN 'phishing' WHEN score >= 0.4 THEN 'suspect' ELSE 'benin' END AS label
  FROM scored) s
LEFT JOIN (SELECT mail_id, string_agg(text, ' ; ' ORDER BY rank) FILTER (WHERE rank <= 2) AS t,
  string_agg(feature, ',' ORDER BY rank) AS nr FROM reasons GROUP BY mail_id) r USING (mail_id)
LEFT JOIN (SELECT mail_id, string_agg(feature, ',' ORDER BY rank) AS np FROM protective GROUP BY mail_id) p USING (mail_id)"""

BINARY = """SELECT label_kind, tn::BIGINT AS tn, fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp,
  round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1, round(brier, 6) AS brier
FROM (SELECT label_kind, count(*) FILTER (WHERE score >= 0.5 AND y = 1) AS tp,
  count(*) FILTER (WHERE score >= 0.5 AND y = 0) AS fp,
  count(*) FILTER (WHERE score < 0.5 AND y = 1) AS fn,
  count(*) FILTER (WHERE score < 0.5 AND y = 0) AS tn, avg((score - y) * (score - y)) AS brier
  FROM (SELECT 'clean' AS label_kind, label AS y, score FROM scores
        UNION ALL SELECT 'noisy', noisy_label, score FROM scores) GROUP BY label_kind)"""

FAMILY = f"""SELECT family, CASE WHEN family IN {ob.in_list(PHISHING_FAMILIES)} THEN 'phishing' ELSE 'benign' END AS type,
  CASE WHEN family IN {ob.in_list(PHISHING_FAMILIES)} THEN round(avg((score >= 0.5)::INT), 6) END AS detection_rate,
  CASE WHEN family NOT IN {ob.in_list(PHISHING_FAMILIES)} THEN round(avg((score >= 0.5)::INT), 6) END AS false_positive_rate,
  count(*) AS n, round(avg(score), 6) AS mean_score FROM scores GROUP BY family"""

CUMULATIVE = """by_score AS (SELECT score, sum(label) AS tp_here, count(*) AS n_here FROM scores GROUP BY score),
cum AS (SELECT *, sum(tp_here) OVER w AS tp, sum(n_here) OVER w AS n, sum(tp_here) OVER () AS positives,
  sum(n_here) OVER () AS total FROM by_score
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""
# Straight from the definitions, not from the running sums.
RANKING = """SELECT round((SELECT avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END)
  FROM scores a, scores b WHERE a.label = 1 AND b.label = 0), 6) AS roc_auc,
  round(sum(tp_here / positives * tp / n), 6) AS pr_auc,
  max(positives)::BIGINT AS positives, max(total - positives)::BIGINT AS negatives FROM cum"""
ROC = """SELECT score AS threshold, round((n - tp) / (total - positives), 6) AS fpr,
  round(tp / positives, 6) AS tpr FROM cum"""
PR = """SELECT score AS threshold, round(tp / n, 6) AS precision, round(tp / positives, 6) AS recall FROM cum"""
CALIBRATION = """SELECT bin, count(*) AS n, round(avg(label), 6) AS fraction_positive, round(avg(score), 6) AS mean_predicted
FROM (SELECT s.score, s.label, len(list_filter(e.q, lambda x: x < s.score))::INT AS bin FROM scores s,
  (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM scores) e)
GROUP BY bin"""


def draw(salt: str, key: str) -> str:
    return f"('0x' || substr(md5('{salt}|' || {key}), 1, 8))::BIGINT"


SPLIT = f"""SELECT mail_id, label, CASE WHEN rn <= ceil(size * 0.25) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT mail_id, label, row_number() OVER (PARTITION BY label ORDER BY {draw('split', 'mail_id')}, mail_id) AS rn,
  count(*) OVER (PARTITION BY label) AS size FROM mail)"""
FOLDS = f"""SELECT mail_id, label, ((row_number() OVER (PARTITION BY label
  ORDER BY {draw('fold', 'mail_id')}, mail_id) - 1) % 3)::INT AS fold FROM mail"""
NOISE = f"""SELECT mail_id, label, CASE WHEN rn <= floor(size * 0.03) THEN 1 - label ELSE label END AS noisy_label FROM (
  SELECT mail_id, label, row_number() OVER (ORDER BY {draw('noise', 'mail_id')}, mail_id) AS rn,
  count(*) OVER () AS size FROM mail)"""
SAMPLE = f"""SELECT mail_id, family, subject FROM mail WHERE family IN {ob.in_list(PHISHING_FAMILIES)}
  ORDER BY {draw('sample', 'mail_id')}, mail_id LIMIT 300"""
PER_GROUP = f"""SELECT mail_id, family, subject, rank::INT AS rank FROM (SELECT mail_id, family, subject,
  row_number() OVER (PARTITION BY family ORDER BY {draw('inbox', 'mail_id')}, mail_id) AS rank FROM mail)
  WHERE rank <= 2"""
CONTENT_SPLIT = f"""SELECT mail_id, CASE WHEN {draw('split', 'md5(body)')} < {int(0.25 * (1 << 32))}
  THEN 'test' ELSE 'train' END AS split FROM mail"""
