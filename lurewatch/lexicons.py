"""Fixed vocabulary of the detector and the tables derived from it by rule."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: lexicons the scores depend on, in their canonical order. ---

BRANDS = [
    "paypal", "microsoft", "apple", "amazon", "google", "netflix", "facebook", "instagram",
    "linkedin", "dhl", "fedex", "ups", "laposte", "chronopost", "ameli", "impots", "caf", "orange",
    "free", "sfr", "bouygues", "sncf", "banque", "creditagricole", "bnpparibas", "societegenerale",
    "lcl", "office365", "outlook", "docusign", "dropbox", "wetransfer", "coinbase", "binance",
    "revolut", "n26", "boursorama", "spotify", "adobe",
]

URGENCY_TERMS = [
    "urgent", "immédiat", "immediat", "immediately", "maintenant", "now", "aujourd'hui", "today",
    "expire", "expired", "expiration", "dernier délai", "deadline", "24h", "48h",
    "dès que possible", "asap", "rapidement", "action requise", "action required", "attention",
    "warning", "alerte", "alert", "suspendu", "suspended", "bloqué", "blocked", "verrouillé",
    "locked", "limité", "limited", "dernière chance", "last chance", "ne tardez pas", "sans délai",
    "compte fermé", "définitivement",
]

CREDENTIAL_TERMS = [
    "mot de passe", "password", "identifiant", "login", "code pin", "pin code", "carte bancaire",
    "credit card", "numéro de carte", "card number", "cvv", "cvc", "iban", "rib",
    "code de sécurité", "security code", "vérifiez votre", "verify your", "confirmez votre",
    "confirm your", "mettez à jour", "update your", "réactiver", "reactivate",
    "valider votre compte", "validate your account", "coordonnées bancaires", "social security",
    "sécurité sociale", "numéro de sécurité", "se connecter", "sign in",
]

LURE_TERMS = [
    "gagné", "won", "gagnant", "winner", "félicitations", "congratulations", "remboursement",
    "refund", "cadeau", "gift", "bon d'achat", "voucher", "prime", "bonus", "loterie", "lottery",
    "héritage", "inheritance", "million", "récompense", "reward", "offre exclusive",
    "exclusive offer", "gratuit", "free", "cashback", "crypto", "bitcoin", "investissement",
]

GREETINGS = [
    "cher client", "dear customer", "dear user", "cher utilisateur", "bonjour cher", "dear valued",
    "dear member", "cher membre", "dear account holder", "to whom it may concern",
    "dear sir/madam",
]

FREE_PROVIDERS = [
    "gmail.com", "yahoo.com", "yahoo.fr", "hotmail.com", "hotmail.fr", "outlook.com", "outlook.fr",
    "live.com", "live.fr", "aol.com", "gmx.com", "gmx.fr", "protonmail.com", "yandex.com",
    "mail.ru", "icloud.com", "free.fr", "laposte.net", "orange.fr", "sfr.fr", "wanadoo.fr",
]

RISKY_TLDS = [
    "tk", "ml", "ga", "cf", "gq", "top", "xyz", "club", "online", "site", "work", "click", "link",
    "fit", "loan", "review", "country", "stream", "download", "racing", "win", "bid", "men",
    "date", "buzz", "icu", "cam", "rest", "zip", "mov", "support", "live", "monster", "su", "cc",
]

#: The shorter list the URL note of a highlight uses.
NOTE_TLDS = [
    "tk", "ml", "ga", "cf", "gq", "xyz", "top", "live", "icu", "online", "click", "link", "rest",
    "zip",
]

SHORTENERS = [
    "bit.ly", "tinyurl.com", "goo.gl", "ow.ly", "t.co", "is.gd", "buff.ly", "adf.ly", "cutt.ly",
    "rebrand.ly", "shorturl.at", "rb.gy", "t.ly", "tiny.cc", "lnkd.in", "soo.gd", "s2r.co",
]

DANGEROUS_EXTENSIONS = [
    "exe", "scr", "bat", "cmd", "com", "pif", "vbs", "js", "jar", "ps1", "msi", "hta", "iso",
    "img", "lnk", "html", "htm", "svg", "zip", "rar", "7z", "docm", "xlsm", "pptm", "ace",
]

IMAGE_EXTENSIONS = [".png", ".jpg", ".jpeg", ".gif", ".svg"]

HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i",
    "ј": "j", "ԁ": "d", "ɡ": "g", "ո": "n", "ա": "a", "ｏ": "o", "０": "0", "１": "1", "ⅼ": "l",
    "ℓ": "l", "𝐚": "a", "𝟎": "0", "ﬁ": "fi", "ν": "v", "ρ": "p", "α": "a", "ε": "e", "ο": "o",
    "τ": "t",
}

#: Greek capitals the inverse mapping also folds (Cyrillic capitals are not in it).
HOMOGLYPH_CAPITALS = {
    "Ι": "I", "Ο": "O", "Α": "A", "Ε": "E", "Ρ": "P", "Τ": "T", "Η": "H", "Κ": "K", "Μ": "M",
    "Ν": "N", "Β": "B", "Χ": "X",
}

#: Latin letter -> look-alike used by the homoglyph perturbation.
LATIN_TO_HOMOGLYPH = {
    "e": "е", "o": "о", "a": "а", "c": "с", "p": "р", "x": "х", "y": "у", "s": "ѕ", "i": "і",
    "d": "ԁ", "j": "ј", "g": "ɡ",
}

ZERO_WIDTH = ["\u200b", "\u200c", "\u200d", "\ufeff", "\u2060"]
LEET = {"a": "4", "e": "3", "i": "1", "o": "0", "s": "5", "t": "7"}
DELEET = {"4": "a", "3": "e", "0": "o", "5": "s", "7": "t", "@": "a", "$": "s", "1": "i"}

HUMAN_LABELS = {
    "url_has_ip": "L'URL pointe vers une adresse IP brute au lieu d'un nom de domaine",
    "url_uses_shortener": "Le lien utilise un raccourcisseur d'URL qui masque la vraie destination",
    "url_suspicious_tld": "Le domaine utilise une extension (TLD) souvent abusée par les attaquants",
    "lookalike_brand_distance": "Le domaine ressemble de très près à une marque connue (typosquatting)",
    "digit_letter_substitution": "Le domaine remplace des lettres par des chiffres pour imiter une marque (ex: paypa1.com)",
    "has_homoglyph": "Le texte contient des caractères Unicode visuellement identiques à des lettres latines (homoglyphes)",
    "sender_display_domain_mismatch": "Le nom affiché imite une marque mais le domaine d'envoi ne correspond pas",
    "reply_to_mismatch": "L'adresse de réponse (reply-to) diffère de l'expéditeur affiché",
    "free_provider_official_claim": "Un 'service officiel' vous écrit depuis une boîte mail gratuite (gmail, outlook...)",
    "sender_suspicious_tld": "Le domaine de l'expéditeur utilise une extension à risque",
    "urgency_term_count": "Le message crée un sentiment d'urgence pour vous faire agir vite",
    "credential_term_count": "Le message demande des identifiants ou des informations sensibles",
    "lure_term_count": "Le message promet un gain, un remboursement ou une récompense (appât)",
    "generic_greeting": "La formule d'appel est générique ('Cher client') typique d'un envoi de masse",
    "spf_fail": "L'authentification SPF a échoué (l'expéditeur n'est pas autorisé pour ce domaine)",
    "dkim_fail": "La signature DKIM a échoué (le message a pu être altéré ou usurpé)",
    "dmarc_fail": "La politique DMARC a échoué (forte présomption d'usurpation)",
    "auth_missing": "Aucune authentification email (SPF/DKIM/DMARC) n'est présente",
    "dangerous_attachment": "Une pièce jointe a une extension dangereuse (exécutable, script, archive...)",
    "link_text_mismatch": "Le texte d'un lien affiche un domaine différent de sa vraie destination",
    "url_has_at_symbol": "Une URL contient un symbole '@' qui peut détourner la destination réelle",
    "uppercase_ratio": "Usage excessif de majuscules (ton alarmiste)",
    "exclamation_ratio": "Usage excessif de points d'exclamation",
}

PROTECTIVE_TEXTS = {
    "spf_fail": "L'authentification SPF est valide (expéditeur autorisé)",
    "dkim_fail": "La signature DKIM est valide (message non altéré)",
    "dmarc_fail": "La politique DMARC est respectée",
    "auth_missing": "Le message est correctement authentifié (SPF/DKIM/DMARC)",
    "url_suspicious_tld": "Les liens pointent vers des domaines de confiance",
    "sender_display_domain_mismatch": "Le domaine d'envoi correspond au nom affiché",
    "urgency_term_count": "Ton neutre, sans pression temporelle",
    "credential_term_count": "Aucune demande d'identifiants",
}
PROTECTIVE_DEFAULT = "Facteur rassurant : "

HIGHLIGHT_NOTES = {
    "urgency": "Crée un sentiment d'urgence",
    "credential": "Demande d'identifiants / informations sensibles",
    "lure": "Promesse de gain / appât",
    "greeting": "Formule d'appel générique (envoi de masse)",
}

# --- End of fixed values. ---

LEXICONS = {
    "urgency": URGENCY_TERMS,
    "credential": CREDENTIAL_TERMS,
    "lure": LURE_TERMS,
    "greeting": GREETINGS,
}


def fold(text: str) -> str:
    """Lower-case, decompose (NFKD) and drop combining marks: the lexicon's own folding."""
    decomposed = unicodedata.normalize("NFKD", text.lower())
    return "".join(c for c in decomposed if not unicodedata.combining(c))


#: Lexicon terms folded once on the driver instead of once per mail.
FOLDED = {kind: [fold(term) for term in terms] for kind, terms in LEXICONS.items()}


def lexicon_dim(spark: SparkSession) -> DataFrame:
    """Every lexicon as one long table ``(kind, pos, term, term_norm)``.

    ``term_norm`` is what gets compared: folded for the text lexicons, raw for
    the lists that are matched against hosts, domains and file names.
    """
    raw = {
        "brand": BRANDS,
        "free_provider": FREE_PROVIDERS,
        "risky_tld": RISKY_TLDS,
        "shortener": SHORTENERS,
        "dangerous_extension": DANGEROUS_EXTENSIONS,
    }
    rows = [(kind, pos, t, fold(t)) for kind, ts in LEXICONS.items() for pos, t in enumerate(ts)]
    rows += [(kind, pos, t, t) for kind, ts in raw.items() for pos, t in enumerate(ts)]
    rows += [("homoglyph", pos, c, latin) for pos, (c, latin) in enumerate(HOMOGLYPHS.items())]
    rows += [("human_label", pos, f, text) for pos, (f, text) in enumerate(HUMAN_LABELS.items())]
    return spark.createDataFrame(rows, "kind string, pos int, term string, term_norm string")
