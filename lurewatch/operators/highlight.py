"""Spans worth highlighting in a mail: URLs, lexicon terms, look-alike characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lurewatch import lexicons as lex
from lurewatch.functions import text as tx
from lurewatch.functions.plan import let
from lurewatch.functions.lexicon_scan import occurrences
from lurewatch.operators.features import brand_distance

#: Longest folding of one character.
_WIDEST = 20


def _lexicon_spans(text: Column) -> Column:
    """Distinct ``(start, end, kind)`` of the lexicon terms of a text.

    Terms are found in the folded text; where folding drops or spells out a character, a
    table of each folded character's origin leads back. A span covers whole characters,
    and the marks that follow the last one.
    """
    kinds: dict[str, list[str]] = {}
    for kind, terms in lex.FOLDED.items():
        for term in terms:
            if kind not in kinds.setdefault(term, []):
                kinds[term].append(kind)
    names = F.map_from_arrays(
        F.split(F.lit("\x01".join(kinds)), "\x01"),
        F.transform(F.split(F.lit("\x01".join(",".join(k) for k in kinds.values())), "\x01"), lambda k: F.split(k, ",")),
    )

    def spans(found: Column) -> Column:
        each = F.transform(found, lambda x: F.transform(F.element_at(names, x["term"]), lambda kind: F.struct(
            x["start"].alias("start"), (x["start"] + F.length(x["term"])).alias("end"), kind.alias("kind")
        )))
        return F.array_distinct(F.flatten(each))

    def led_back(plain: Column) -> Column:
        widths = F.transform(F.split(text, ""), lambda c: F.length(tx.fold(c)))
        places = F.flatten(F.transform(widths, lambda w, i: F.array_repeat(i, w)))

        def origin(table: Column) -> Column:
            def span(s):
                last = F.get(table, s["end"] - 1)
                after = F.filter(F.slice(table, s["end"] + 1, F.lit(_WIDEST)), lambda at: at > last)
                return F.struct(
                    F.get(table, s["start"]).alias("start"),
                    F.coalesce(F.get(after, F.lit(0)), F.length(text)).alias("end"), s["kind"].alias("kind"),
                )

            return F.array_distinct(F.transform(plain, span))

        return let(places, origin)

    return let(spans(occurrences(tx.fold(text), kinds)), lambda plain: F.when(
        (F.size(plain) == 0) | tx.is_ascii(text) | ~text.rlike(tx.uneven_class()), plain
    ).otherwise(led_back(plain)))


def url_note(url: Column) -> Column:
    """Why a link is worth a look; the first rule that holds decides."""
    bare = F.regexp_replace(url, "^https?://", "")
    host = F.substring_index(F.substring_index(bare, "/", 1), ":", 1)
    domain = tx.last_two_labels(host)
    risky = domain.rlike(rf"\.({tx.literal_alternation(lex.NOTE_TLDS)})$")
    return (
        F.when(
            brand_distance(host) <= 2,
            F.concat(
                F.lit("Domaine très proche d'une marque connue ("), domain,
                F.lit(") - possible typosquatting"),
            ),
        )
        .when(risky, F.concat(F.lit("Extension de domaine à risque ("), domain, F.lit(")")))
        .when(
            host.rlike(r"^(\p{Nd}{1,3}\.){3}\p{Nd}{1,3}"),
            F.lit("L'URL pointe vers une adresse IP brute"),
        )
        .when(
            F.lower(url).startswith("http://"),
            F.lit("Lien non chiffré (http) - destination à vérifier"),
        )
        .otherwise(F.lit("Lien présent dans le message"))
    )


def _url_spans(text: Column, urls: Column) -> Column:
    parts = F.split(text, tx.URL, -1)
    total = lambda arr: F.aggregate(
        arr, F.lit(0), lambda acc, p: acc + F.length(p)
    )

    def span(url, i):
        start = total(F.slice(parts, 1, i + 1)) + total(F.slice(urls, 1, i))
        return F.struct(
            start.alias("start"), (start + F.length(url)).alias("end"), F.lit("url").alias("kind"),
            url.alias("snippet"), url_note(url).alias("note"),
        )

    return F.transform(urls, span)


def _homoglyph_spans(text: Column) -> Column:
    latin = F.map_from_arrays(
        F.split(F.lit("".join(lex.HOMOGLYPHS)), ""), F.split(F.lit(",".join(lex.HOMOGLYPHS.values())), ",")
    )
    placed = F.transform(F.split(text, ""), lambda c, i: F.struct(i.alias("i"), c.alias("c")))
    hits = F.filter(placed, lambda p: p["c"].isin(*lex.HOMOGLYPHS))
    spans = F.transform(
        hits,
        lambda p: F.struct(
            p["i"].alias("start"), (p["i"] + 1).alias("end"), F.lit("homoglyph").alias("kind"),
            p["c"].alias("snippet"),
            F.concat(
                F.lit("Caractère trompeur '"), p["c"], F.lit("' imitant '"),
                F.element_at(latin, p["c"]), F.lit("'"),
            ).alias("note"),
        ),
    )
    return F.when(tx.has_homoglyph(text), spans)


def highlight_array(text: Column) -> Column:
    """Distinct spans of a text as an array: start ascending, longer first, then kind."""
    notes = F.map_from_arrays(
        F.split(F.lit("\x01".join(lex.HIGHLIGHT_NOTES)), "\x01"),
        F.split(F.lit("\x01".join(lex.HIGHLIGHT_NOTES.values())), "\x01"),
    )

    def lexical(terms):
        return F.transform(
            terms,
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
                F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("snippet"),
                F.element_at(notes, s["kind"]).alias("note"),
            ),
        )

    def ordered(spans):
        keyed = F.transform(
            spans, lambda x: F.struct(x["start"].alias("a"), (-x["end"]).alias("b"), x["kind"].alias("k"), x.alias("s"))
        )
        return F.transform(F.array_sort(keyed), lambda x: x["s"])

    def every(terms):
        links = let(F.regexp_extract_all(text, F.lit(tx.URL), F.lit(0)), lambda urls: _url_spans(text, urls))
        glyphs = _homoglyph_spans(text)
        return let(F.concat(links, terms, F.coalesce(glyphs, F.slice(terms, 1, 0))), ordered)

    return let(lexical(_lexicon_spans(text)), every)


def highlight_spans(mail: DataFrame) -> DataFrame:
    """``(mail_id, pos, start, end, kind, snippet, note)``, one row per distinct span.

    Stays inside the row up to the final explode; ``pos`` counts from one in the order
    start ascending, longer first, then kind.
    """
    spans = highlight_array(F.col("text"))
    base = mail.select("mail_id", tx.full_text().alias("text")).select("mail_id", spans.alias("spans"))
    rows = base.select("mail_id", F.posexplode_outer("spans").alias("i", "s")).where("s is not null")
    return rows.select("mail_id", (F.col("i") + 1).alias("pos"), "s.*")
