"""Batch kernels against plain Python; pieces of any size give the same."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from lurewatch.functions import batches, draws, grams, lexicon_scan, text as tx
from lurewatch.operators import canonicalize, perturb, robustness, textvec
from lurewatch.sources.weights import LinearScorer

TEXTS = ["", None, "a", " --a  b_c-9 é ", "été!", "now now nownow anana ananas", "aaaaa", "\U0001d41a x\x01y", "ab " * 50, "z"]


def words_of(clean, kind):
    tokens = (clean or "").split()
    if kind == "word":
        long = [w for w in tokens if len(w) > 1]
        return long + [f"{a} {b}" for a, b in zip(long, long[1:])]
    padded = [f" {w} " for w in tokens]
    return [p[k : k + n] for p in padded for n in (3, 4, 5) for k in range(len(p) - n + 1)]


@pytest.fixture(params=[4, 1 << 20])
def clean(request, monkeypatch):
    monkeypatch.setattr(grams, "BUDGET", {"word": request.param, "char": request.param})
    rng = random.Random(5)
    return pa.array([None, "", "a", "ab"] + [" ".join(rng.choices(["a", "ab", "url_token", "x9", "hello"], k=k)) for k in range(1, 40)])


@pytest.mark.parametrize("budget", [1, 7, 1 << 20])
def test_only_words(budget, monkeypatch):
    monkeypatch.setattr(batches.pieces, "__defaults__", (budget,))
    want = [None if t is None else re.sub("[^a-z0-9_]+", " ", t).strip(" ") for t in TEXTS]
    assert batches.only_words(pa.array(TEXTS)).to_pylist() == want
    assert batches.only_words(pa.array(TEXTS)[3:6]).to_pylist() == want[3:6]
    assert batches.only_words(pa.array([], pa.string())).to_pylist() == []


@pytest.mark.parametrize("terms", [("now", "anana", "aa", "é", "b_c"), ("ana", "ananas", "own", "wno")])
def test_find(terms):
    data, offsets = batches.flat(pa.array(TEXTS))
    got = {(terms[t], int(r), int(p - offsets[r])) for t, row, at in batches.find(data, offsets, terms) for r, p in zip(row, at)}
    want = {(t, r, m.start()) for r, x in enumerate(TEXTS) for t in terms for m in re.finditer(re.escape(t.encode()), (x or "").encode())}
    assert got == want


@pytest.mark.parametrize("kind", ["word", "char"])
def test_terms_are_tallied_before_the_shuffle(spark, clean, kind):
    want = Counter(), Counter()
    for t in clean.to_pylist():
        want[0].update(set(words_of(t, kind)))
        want[1].update(words_of(t, kind))
    got = Counter(), Counter()
    for batch in grams.tally(kind)(iter([pa.RecordBatch.from_arrays([clean], ["clean"])])):
        assert len(set(batch.column(0).to_pylist())) == batch.num_rows  # one row a term and piece
        for term, df, total in zip(*(c.to_pylist() for c in batch.columns)):
            got[0][term] += df
            got[1][term] += total
    assert got == want
    table = spark.createDataFrame([(t,) for t in clean.to_pylist()], "clean string")
    assert {r.term: (r.df, r.total_tf) for r in textvec.term_document_frequency(table, kind).collect()} == {t: (want[0][t], want[1][t]) for t in want[0]}


def test_a_task_sums_its_ngrams(clean, monkeypatch):
    batches_ = [pa.RecordBatch.from_arrays([clean], ["clean"])] * 3
    want = Counter(w for t in clean.to_pylist() for w in words_of(t, "char"))
    for held in (grams.HELD, 10):
        monkeypatch.setattr(grams, "HELD", held)
        out = pa.Table.from_batches(grams.tally("char")(iter(batches_))).to_pylist()
        got = Counter()
        for r in out:
            got[r["term"]] += r["total_tf"]
        assert got == Counter({t: 3 * n for t, n in want.items()})
        assert held == 10 or len(out) == len(want)  # one row a term and task


def test_clean_text_equals_its_expressions(spark):
    rng = random.Random(4)
    odd = ["http", "HTTP", "https", "s", "://", "@", ".", "co", "m", " ", "\n", "\x1c", "\x0b", "a", "Z", "9", "_", "%", "+", "<", '"', "'", ")"]
    texts = ["x@y.comhttp://z", "a@b.co@c.de@e.fr", "http://a\x1cb", "", None, "ÀÉ http://é.com/à x@é.com a.b@c.fr", "İ ſ K ﬁ ½ e\u0301 httpſ://q x@ſ.com"]
    texts += ["".join(rng.choices(odd if i % 2 else [*odd, "é", "ſ", "İ", "а", "ﬁ", "\u2003", "\u0301"], k=rng.randint(1, 25))) for i in range(2000)]

    def mask(t):
        urls = F.when(t.contains("://"), F.regexp_replace(t, tx.URL, " URL_TOKEN ")).otherwise(t)
        return F.when(t.contains("@"), F.regexp_replace(urls, tx.EMAIL, " EMAIL_TOKEN ")).otherwise(urls)

    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    spelled = F.btrim(F.regexp_replace(tx.fold(mask(F.col("t"))), "[^a-z0-9_]+", " "))
    got = rows.select(tx.clean_text(F.col("t")).alias("got"), spelled.alias("want"))
    assert [r for r in got.collect() if r.got != r.want] == []
    plan = rows.select(tx.clean_text(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" not in plan  # letters are folded by the kernel


@pytest.mark.parametrize("kind", ["word", "char"])
def test_vocabulary_counts(clean, kind):
    terms = tuple(sorted({t for x in clean.to_pylist() for t in words_of(x, kind)})[::2]) + ("zz", "zzz")
    row, column, count = grams.Vocabulary(kind, terms).counts(clean)
    got = [(int(r), terms[c], int(n)) for r, c, n in zip(row, column, count)]
    want = [(r, t, n) for r, x in enumerate(clean.to_pylist()) for t, n in Counter(words_of(x, kind)).items() if t in terms]
    assert got == sorted(got, key=lambda x: (x[0], terms.index(x[1]))) and sorted(got) == sorted(want)
    assert [len(x) for x in grams.Vocabulary(kind, ()).counts(clean)] == [0, 0, 0]


def test_addresses_are_masked_as_before(spark):
    rng = random.Random(3)
    values = ["".join(rng.choices(["a", "b.co", "@", "_", " ", "x.org", "-", "1"], k=14)) for _ in range(400)] + ["a@b.com_x@y.org"]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    once, before = (F.regexp_replace("t", p, "<>") for p in (tx._EMAIL_ONCE, tx.EMAIL))
    assert rows.where(once != before).count() == 0


def test_characters_are_drawn_as_columns_are(spark):
    values = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "abc")]
    rows = spark.createDataFrame(values, "i long, t string")
    seed = draws.seed_of(F.col("i"), 2)
    got = {r.i: (r.t, r.z, r.h) for r in rows.select("i", "t", perturb.zero_width(F.col("t"), seed, 0.5).alias("z"), perturb.homoglyph(F.col("t"), seed).alias("h")).collect()}
    drawn = spark.range(60).select(F.col("id").alias("k"), *[draws.position_draw(draws.seed_of(F.lit(i), 2), F.col("id")).alias(f"d{i}") for i in range(len(TEXTS))])
    table = np.array([list(r)[1:] for r in drawn.orderBy("k").collect()])
    letters = set("abcdefghijklmnopqrstuvwxyzé\U0001d41a\x01")
    src, dst = perturb._both_cases(perturb.lex.LATIN_TO_HOMOGLYPH, str.upper)
    for i, t in enumerate(TEXTS):
        if t is not None and len(t) <= 60:
            mark = [c + (perturb.lex.ZERO_WIDTH[table[k, i] % 5] if c in letters and table[k, i] < draws.below(0.5) else "") for k, c in enumerate(t)]
            like = [dst[src.index(c)] if c in src and table[k, i] < draws.below(0.6) else c for k, c in enumerate(t)]
            assert got[i] == (t, "".join(mark), "".join(like))
    assert got[1] == (None, None, None) and got[None] == ("abc", "abc", "abc")


def test_only_entries_that_may_be_among_the_strongest_leave_the_kernel(spark):
    """Row 0 has ties at its second place (one by rounding only), row 1 has no entry, row 2 fewer than two."""
    row = np.array([0, 0, 0, 0, 0, 2])
    value = np.array([0.1, 0.5, 0.3, 0.3 - 4e-10, 0.2, 0.0])
    assert textvec.strongest(row, value, 2, 3).tolist() == [False, True, True, True, False, True]
    assert textvec.strongest(row[:0], value[:0], 2, 3).tolist() == []

    rows = [(0, "b b b a c c d d e"), (1, None), (2, ""), (3, "e"), (4, "d c b a"), (5, "a a zz")]
    docs = spark.createDataFrame(rows, "mail_id long, clean string")
    space = textvec.TextSpace("word", ["bb", "cc", "dd", "ee", "dd ee"], [1.5, 1.0, 1.0, 1.0, 2.0])
    docs = docs.withColumn("clean", F.regexp_replace("clean", "(\\w)", "$1$1"))
    for weights in (None, {"cc": -2.0, "ee": 1.0}, {}):
        want = {}
        for r in space.long_weights(docs).collect():
            c = round(r["weight"] * (1.0 if weights is None else weights.get(r["term"], 0.0)), 9)
            want.setdefault(r["mail_id"], []).append((-abs(c), r["term"], c))
        want = sorted((i, k + 1, t, c) for i, found in want.items() for k, (_, t, c) in enumerate(sorted(found)[:2]))
        assert sorted(map(tuple, space.top_terms(docs, weights, 2).collect())) == want


@pytest.mark.parametrize("cap", [3, 10, 40, 4000])
def test_vocabulary_counts_only_pairs_of_words_in_reach(spark, monkeypatch, cap):
    """The kept terms are those of all words and pairs, ties at the cap included; a word of nearly every row is left out."""
    monkeypatch.setattr(textvec, "LIMITS", {"word": (2, 0.9, cap), "char": textvec.LIMITS["char"]})
    rng = random.Random(cap)
    texts = ["the " + " ".join(f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(30)) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "clean string")
    every = textvec.term_document_frequency(docs).collect()
    want = sorted((r for r in every if 2 <= r["df"] <= 0.9 * len(texts)), key=lambda r: (-r["total_tf"], r["term"]))[:cap]
    got = textvec.vocabulary(docs).collect()
    assert sorted((r["term"], r["df"], r["total_tf"]) for r in got) == sorted(map(tuple, want))
    among = textvec._words_in_reach(docs)
    assert (among is None) == (cap == 4000)
    if among is not None:
        assert textvec.term_document_frequency(docs, "word", among).count() < len(every)


def test_kinds_of_settled_characters_are_the_engines(spark):
    """No character of another kind in the engine, and none told that is not settled."""
    points = [cp for first, last in tx.SETTLED for cp in range(first, last)]
    rows = spark.createDataFrame([(cp, chr(cp)) for cp in points], "cp int, c string")
    told = {tx.LETTER: r"^\p{L}$", tx.CAPITAL: r"^\p{Lu}$", tx.NUMBER: r"^\p{N}$"}
    got = rows.select("cp", *[F.col("c").rlike(p).cast("int") for p in told.values()]).collect()
    kinds = tx.kinds()
    assert [r.cp for r in got if [int(kinds[r.cp] & bit > 0) for bit in told] != list(r)[1:] or not kinds[r.cp] & tx.KNOWN] == []
    assert np.count_nonzero(kinds) == len(points)


def _odd_texts(n):
    rng = random.Random(11)
    pool = ["a", "b", "é", "É", " ", " ", " ", "1", "0", "@", "$", "4", "_", ".", "\n", "K", "ſ", "İ", "ß", "½", "ﬁ", "№", "а", "Е", "​", "﻿", "́", "ｏ", "①", "𝐚", "가", "각", "ᄀ", "ᅡ", "字", "ა", "\U0001e030", "Ɤ", "pаyp4l", "s p a c e", "urgent", "paypal", "\x01"]
    plain = [c for c in pool if all(ord(x) < 0x600 for x in c)]
    return ["", None, " ", "a", "a b", "a b c", "​", "4", "p4", "p4s"] + ["".join(rng.choices(pool if i % 2 else plain, k=rng.randint(1, 30))) for i in range(n)]


@pytest.mark.parametrize("budget", [9, 1 << 20])
def test_mails_are_made_canonical_as_by_the_single_steps(spark, monkeypatch, budget):
    monkeypatch.setattr(batches.sliced, "__defaults__", (budget,))
    rows = spark.createDataFrame([(i, t, t) for i, t in enumerate(_odd_texts(2000))], "i int, subject string, t string").repartition(4)
    step = canonicalize.normalize_homoglyphs(canonicalize.strip_zero_width(F.col("t")))
    want = rows.withColumn("want", step).withColumn("want", canonicalize.despace_words(F.col("want"))).withColumn("want", canonicalize.deleet(F.col("want")))
    got = canonicalize.canonicalize_mail(want.withColumn("body", F.regexp_replace("t", "://", "")))
    assert [r for r in got.collect() if r.subject != r.want or r.body != r.want] == []
    plan = canonicalize.canonicalize_mail(rows.withColumn("body", F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(subject" not in plan  # no step spells out all characters in the engine


def test_letters_and_terms_are_counted_as_in_folded_text(spark):
    rows = spark.createDataFrame([(t,) for t in _odd_texts(2000)], "t string")
    n, hits = F.length("t"), lexicon_scan.lexicon_hits(F.col("t"), letters=True)
    letters, capitals = (n - F.length(F.regexp_replace("t", p, "")) for p in (r"\p{L}+", r"\p{Lu}+"))
    folded = lexicon_scan.lexicon_hits(F.col("f"))
    got = rows.withColumn("f", tx.fold(F.col("t"))).select("t", hits.alias("h"), folded.alias("w"), letters.alias("l"), capitals.alias("c")).collect()
    assert all(list(r.h)[:5] == list(r.w) for r in got)
    glyphs = rows.select("t", hits["homoglyph"].alias("got"), tx.has_homoglyph(F.col("t")).alias("want"))
    assert glyphs.where("NOT got <=> want").count() == 0 < glyphs.where("got").count()
    assert all((r.h.letters, r.h.capitals) in ((r.l, r.c), (None, None)) for r in got)
    assert all((r.h.letters is None) == (r.t is None or any(not tx.kinds()[ord(c)] for c in r.t)) for r in got)
    plan = rows.select(hits)._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" not in plan and "lower" not in plan  # letters are folded by the kernel


def test_polishing_skips_no_place(spark):
    """The patterns that look at first letters before their surroundings change the same texts."""
    rng = random.Random(12)
    pool = ["urgent", "URGENT", "ımmédıatement", "İMMÉDIATEMENT", "Immédiatement", "ſous 24h", "tout de suite", "MAINTENANT", "Cher", "CHÈRE", " ", " ", "  ", "\u2003", "\t", "\x1f", "\xa0", "client", "abonnée", "é", "a", ",", "!!", "\x7f"]
    values = [None, "", " ", "a b", "\t", " \t"] + ["".join(rng.choices(pool, k=rng.randint(1, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    pairs = [(F.regexp_replace("t", a, "<>"), F.regexp_replace("t", b, "<>")) for a, b in ((perturb._GREETING, perturb._GREETING_ONCE), (perturb._PRESSURE, perturb._PRESSURE_ONCE))]
    for want, got in [*pairs, (F.regexp_replace("t", f"[{tx._SPACE_CLASS}]+", " "), tx.single_spaced(F.col("t")))]:
        assert rows.where(~got.eqNullSafe(want)).count() == 0 < rows.where(want != F.col("t")).count()


def test_a_mail_is_perturbed_once(spark, mail):
    """The rewriting of addresses stands in one place of the plan, not in each that reads the text."""
    scores = robustness.variant_scores(mail, LinearScorer(), ["url_obfuscation", "ia_polie"])
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("@evil-") == 1
