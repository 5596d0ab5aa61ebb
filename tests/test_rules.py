"""Hand-derived golden values and brute-force checks of single rules."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lurewatch import lexicons as lex
from lurewatch.functions import lexicon_scan, text as tx
from lurewatch.operators import canonicalize, features, perturb, textvec

T = None  # the text column; needs a running session


@pytest.fixture(autouse=True, scope="module")
def text_column(spark):
    global T
    T = F.col("t")


# url -> host, dots, shortener, tld, entropy, distance, digit fold
URLS = {
    "http://paypa1.tk/login": ("paypa1.tk", 1, 0, 1, 1.9183, 1, 1),
    "https://secure-paypal.xyz/verify": ("secure-paypal.xyz", 1, 0, 1, 3.2389, 6, 0),
    "http://192.0.2.10/login": ("192.0.2.10", 3, 0, 0, 1.585, 2, 0),
    "https://bit.ly/a1234": ("bit.ly", 1, 1, 0, 1.585, 3, 0),
    "http://paypal.secure-1.tk/account": ("paypal.secure-1.tk", 2, 0, 1, 1.9183, 5, 1),
    "http://user@evil.example.top/x": ("user@evil.example.top", 2, 0, 1, 2.9477, 3, 0),
    "http://www.micros0ft.com/reset": ("micros0ft.com", 1, 0, 0, 3.1699, 1, 1),
    "https://mail.example.com:8443/a/b": ("mail.example.com", 2, 0, 0, 2.0, 3, 0),
}


def test_host_goldens(texts):
    host = tx.host_of_url(T)
    assert texts(URLS, host) == [v[0] for v in URLS.values()]
    assert texts(URLS, features.brand_distance(host)) == [v[5] for v in URLS.values()]
    assert texts(URLS, features.digit_fold_hit(host).cast("int")) == [v[6] for v in URLS.values()]
    entropy = F.round(features.entropy(F.substring_index(host, ".", 1)), 4)
    assert texts(URLS, entropy) == [v[4] for v in URLS.values()]


def test_url_feature_goldens(spark):
    rows = [(i, "", u, "", "", "", "none", "none", "none", [], False) for i, u in enumerate(URLS)]
    mail = spark.createDataFrame(
        rows,
        "mail_id long, subject string, body string, sender_display string, sender_email string, "
        "reply_to string, spf string, dkim string, dmarc string, attachments array<string>, "
        "has_html boolean",
    )
    got = features.mail_features(mail).orderBy("mail_id").collect()
    for r, (url, v) in zip(got, URLS.items()):
        assert (r.url_count, r.url_max_len, r.url_max_subdomains) == (1, len(url), v[1])
        assert (r.url_uses_shortener, r.url_suspicious_tld) == (v[2], v[3])
    empty = features.mail_features(mail.withColumn("body", F.lit(""))).first()
    assert (empty.url_https_ratio, empty.lookalike_brand_distance, empty.url_max_entropy) == (1, 9, 0)


def test_small_rules(texts):
    assert texts(["v é r i f", "a b", "m o t d e"], canonicalize.despace_words(T)) == [
        "vérif", "a b", "motde"
    ]
    assert texts(["paypa1", "24h", "p4ssw0rd now"], canonicalize.deleet(T)) == [
        "paypai", "24h", "password now"
    ]
    assert texts(["a+b%2fc", "%zz", "x%41%zz"], canonicalize.percent_decode(T)) == [
        "a+b/c", "%zz", "xA%zz"
    ]
    urls = ["http://a@b@evil.tk/x", "http://%65vil.tk/%41", "HTTP://a@b/x"]
    assert texts(urls, canonicalize.canonical_url(T)) == [
        "http://evil.tk/x", "http://evil.tk/A", "HTTP://a@b/x"
    ]


def test_despace_matches_run_rule(texts):
    rng = random.Random(5)
    values = ["".join(rng.choice("ab é1_,.\n") for _ in range(rng.randint(0, 30))) for _ in range(800)]
    run = re.compile(r"(?:\b\w\b[ ]){2,}\b\w\b")
    want = [run.sub(lambda m: m.group(0).replace(" ", ""), v) for v in values]
    assert texts(values, canonicalize.despace_words(T)) == want


def test_nfkc_and_homoglyphs_are_exact(texts):
    rng = random.Random(6)
    pool = "ab éèﬁ…½ｏ①𝐚аеΑ가각é한ệ́Å™ ²"
    values = ["".join(rng.choice(pool) for _ in range(12)) for _ in range(400)]
    table = {k: v for k, v in (lex.HOMOGLYPHS | lex.HOMOGLYPH_CAPITALS).items()}
    want = ["".join(table.get(c, c) for c in unicodedata.normalize("NFKC", v)) for v in values]
    assert texts(values, canonicalize.normalize_homoglyphs(T)) == want


def test_folding_agrees_where_it_can_matter(texts):
    values = ["Éléphant ﬁn ½ ①", "ÇA VA… №5", "naïve ＡＢＣ", "Straße İstanbul", "plain ASCII"]
    ascii_only = lambda s: re.sub(r"[^a-z0-9_]+", " ", s)
    got = texts(values, tx.fold(T))
    assert [ascii_only(g) for g in got] == [ascii_only(lex.fold(v)) for v in values]


def lexicon_texts():
    rng = random.Random(7)
    terms = [t for ts in lex.FOLDED.values() for t in ts] + ["expirexpire", "cvcvc", "cvcvcvcvc", "Immédiat", " ", "paypal", "\U0001f600"]
    return ["".join(rng.choice(terms) for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["know", "immediat", "blocked", ""]


def test_lexicon_scan_is_plain_counting(texts):
    values = lexicon_texts()
    for text, got in zip(values, texts(values, lexicon_scan.lexicon_hits(T))):
        folded = lex.fold(text)
        want = [sum(folded.count(t) for t in lex.FOLDED.get(k, lex.BRANDS)) for k in lexicon_scan.KINDS]
        assert list(got) == want[:3] + [w > 0 for w in want[3:]], text
    got = texts([None, "immediat"], lexicon_scan.lexicon_hits(T))
    assert got[0].urgency == 0 and got[1].urgency == 2


def test_occurrences_are_those_from_left_to_right(texts):
    terms = [*lex.FOLDED["urgency"], *lex.FOLDED["credential"], "cvc", "aa", "aab", "a"]
    values = [lex.fold(t) for t in lexicon_texts()] + ["aaaaab", "cvc" * 700]
    for text, got in zip(values, texts(values, lexicon_scan.occurrences(T, terms))):
        want = set()
        for term in terms:
            at = text.find(term)
            while at >= 0:
                want.add((term, at))
                at = text.find(term, at + len(term))
        assert sorted((x.term, x.start) for x in got) == sorted(want)


def test_ngrams_match_brute_force(texts):
    def chars(text):
        out = []
        for word in text.split():
            padded = f" {word} "
            for n in (3, 4, 5):
                out += [padded[k : k + n] for k in range(max(1, len(padded) - n + 1))] if (
                    n == 3 or len(padded) >= n
                ) else []
        return sorted(out)

    values = ["a", "", "ab c", "hello url_token x yz", "a b c d"]
    assert [sorted(g) for g in texts(values, textvec.char_ngrams(T))] == [chars(v) for v in values]
    words = [[w for w in v.split() if len(w) > 1] for v in values]
    pairs = [w + [f"{a} {b}" for a, b in zip(w, w[1:])] for w in words]
    assert texts(values, textvec.word_ngrams(T)) == pairs


def test_zero_width_is_undone(texts):
    values = ["Bonjour, vérifiez", "", "a1b2", "été 𝐚"]
    seed = F.col("i") + 3
    noisy = perturb.zero_width(T, seed, 0.9)
    assert texts(values, noisy) != values
    assert texts(values, canonicalize.strip_zero_width(noisy)) == values


def test_polish(texts):
    body = "Cher client, URGENT!! payez   maintenant"
    assert texts([body], perturb.polish_body(T)) == [
        "Bonjour Camille, dans les meilleurs délais. payez dans les meilleurs délais "
        "Cordialement, le service client."
    ]
    assert texts(["URGENT: verify", "urgent"], perturb.polish_subject(T)) == ["verify", "urgent"]


def test_unknown_variant_fails_when_planning(mail):
    with pytest.raises(ValueError):
        perturb.perturb_mail(mail, "nope")
