"""Collocations, language identification and importance resampling."""

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from lurewatch.llm import language, phrases, resample
from lurewatch.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---- collocations ----------------------------------------------------------


def brute_phrases(docs, min_count=10, inside=50, top=2000):
    """The contract, word by word."""
    counts, size = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        scored = []
        candidates = {p for p, a in f.items() if len(p) > 1 and a >= min_count}
        for p in candidates:
            around = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * f[q] >= inside * f[p] for q in around):
                continue
            cuts = [(1_000_000 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, size[lang], -s))
    return sorted(out)


def corpus():
    common = "New York City is big, New York is old! the of the of the\tof THE of; a a a a a"
    return [
        *[("en", f"{common} {i % 3} été çà\x0bnew york city") for i in range(12)],
        *[(None, "alpha beta gamma. alpha beta delta") for _ in range(11)],
        ("de", "alpha beta " * 40), ("de", "rare words only"), ("en", None), ("en", ""), ("fr", "  \t . , "),
        ("de", " ".join(f"w{i % 7}" for i in range(30_000))),
    ]


@pytest.mark.parametrize("budget", [1 << 19, 8])
def test_phrases_equal_brute_force(spark, budget):
    """A small budget extends prefixes and deals one subtree to many groups."""
    rows = [(i, lang, text, "x", 0) for i, (lang, text) in enumerate(corpus())]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, score string, h int").repartition(5)
    assert sorted(rows_of(phrases.collocations(docs, group_suffixes=budget))) == brute_phrases(corpus())


def test_phrases_break_ties_and_stop_at_the_top(spark):
    rows = [("en", f"p{k} q{k}. ") for k in range(9) for _ in range(10)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(rows_of(phrases.collocations(docs, top=4)))
    assert got == brute_phrases(rows, top=4) and [r[2] for r in got] == ["p0 q0", "p1 q1", "p2 q2", "p3 q3"]


def test_phrases_of_nothing(spark):
    assert rows_of(phrases.collocations(spark.createDataFrame([], "lang string, text string"))) == []


def test_colliding_words_take_another_seed(spark, monkeypatch):
    calls = []
    real = phrases._hash

    def clash(seed):
        calls.append(seed)
        return real(seed) % 3 if seed == 0 else real(seed)

    monkeypatch.setattr(phrases, "_hash", clash)
    totals = spark.createDataFrame([("en", f"w{i}", 20) for i in range(10)], "lang string, word string, f long")
    seed, words = phrases.counted_words(totals, 10)
    assert seed == 1 and calls == [0, 1] and words.count() == 10


def test_phrases_of_the_table_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    want = brute_phrases([(r["lang"], r["text"]) for r in docs.collect()])
    assert want and sorted(rows_of(phrases.collocations(docs))) == want


# ---- languages -------------------------------------------------------------

#: Ids that languages are learned from.
LEARNED = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1]


def brute_bits(training, text, order=language.ORDER):
    """Code length of a text, byte by byte, with a whole tree of one language."""
    counts = defaultdict(Counter)
    for raw in training:
        padded = b"\n" * order + raw
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[padded[i - k : i]][padded[i]] += 1
    bits, padded = 0.0, b"\n" * order + text
    for i in range(order, len(padded)):
        for k in range(order, -1, -1):
            seen = counts.get(padded[i - k : i])
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if seen[padded[i]]:
                bits -= math.log2(seen[padded[i]] / whole)
                break
            bits -= math.log2(len(seen) / whole)
        else:
            bits += 8
    return bits


def test_code_lengths_equal_byte_by_byte(spark):
    train = {"en": ["the cat sat on the mat", "the end"], "fr": ["le chat là-bas", "été", ""]}
    rows = [(i, text, lang) for i, (lang, text) in enumerate((lang, t) for lang, ts in train.items() for t in ts)]
    rows = [(3 * 10**6 + i, t, lang) for i, t, lang in rows]
    keep = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = language.fit_languages(docs)
    assert trees.langs == sorted({r[2] for r in keep if r[1]})
    for text in ("the chat", "ça", "\n", "zzzzzz", "the cat sat on the mat le chat " * 5):
        got = trees.code_lengths([text.encode()])[0]
        want = [brute_bits([r[1].encode() for r in keep if r[2] == lang], text.encode()) for lang in trees.langs]
        assert np.allclose(got, want, rtol=1e-5)


def test_slices_do_not_change_code_lengths(spark, monkeypatch):
    docs = spark.createDataFrame([(LEARNED[0], "some words and more words", "en"), (LEARNED[1], "des mots et encore", "fr")], "doc_id long, text string, lang string")
    trees, text = language.fit_languages(docs), ("some mots and " * 50).encode()
    whole = trees.code_lengths([text, b"", text])
    monkeypatch.setattr(language, "SLICE", 7)
    assert np.allclose(whole, trees.code_lengths([text, b"", text])) and np.allclose(whole[0], whole[2]) and not whole[1].any()


def test_a_small_tree_keeps_the_runs_seen_most(spark):
    counts = spark.createDataFrame([("en", 0, i, n) for i, n in enumerate([9, 5, 5, 1])], "lang string, depth int, run long, n long")
    kept = lambda limit: sorted(r["run"] for r in language.kept_runs(counts, limit).collect())
    assert [kept(k) for k in (1, 2, 3, 4)] == [[0], [0], [0, 1, 2], [0, 1, 2, 3]]


def test_languages_of_odd_rows(spark):
    one, two, three = LEARNED[:3]
    held = next(i for i in range(100) if i not in LEARNED)
    rows = [
        (one, "the quick brown fox and the dog", "en", 1.0), (None, "le renard brun et le chien", "fr", 1.0), (two, None, "en", 1.0),
        (three, "", "en", 1.0), (103, "123 ... 456", "fr", 1.0), (one, "the quick brown fox and the dog", "en", 1.0), (held, "the fox", None, 1.0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = language.predict_languages(docs, language.fit_languages(docs)).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and by_id[None]["lang_pred"] == "fr" and by_id[held]["lang_pred"] == by_id[one]["lang_pred"] == "en"
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 and by_id[i]["bits"] is None for i in (two, three, 103))
    assert all(0 <= r["score"] <= 1 for r in got)
    assert by_id[held]["held_out"] and not by_id[one]["held_out"]
    nothing = language.fit_languages(docs.where("false"))
    assert {r["lang_pred"] for r in language.predict_languages(docs, nothing).collect()} == {"und"}
    assert rows_of(language.predict_languages(docs.where("false"), nothing)) == []


def test_languages_of_rows_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = language.predict_languages(docs, language.fit_languages(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = [r for r in got.collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert len(held) > 200 and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97


# ---- resampling ------------------------------------------------------------


def brute_resample(docs, target, percent=25, min_words=20):
    def features(text):
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER).encode())
        return words, [zlib.crc32(x) % 10_000 for x in (*words, *map(b" ".join, zip(words, words[1:])))]

    s, t = (Counter(b for _, text in side for b in features(text)[1]) for side in (docs, target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out, able = [], []
    for i, (key, text) in enumerate(docs):
        words, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
        if len(words) >= min_words:
            able.append(i)
    able.sort(key=lambda i: (-out[i][3], math.inf if out[i][0] is None else out[i][0], out[i][1], out[i][2]))
    for rank, i in enumerate(able[: percent * len(able) // 100], 1):
        out[i][4] = rank
    return sorted(map(tuple, out), key=repr)


def odd_documents():
    long = [(i, " ".join(f"Word{(i * j) % 37} ünï{j % 5}" for j in range(30))) for i in range(40)]
    return [*long, *[(3, long[3][1])] * 5, (None, long[1][1]), (50, None), (51, ""), (52, "A-Z _x_ 7\x7f8"), (53, "one " * 5000)]


def test_resampling_equals_brute_force(spark):
    target = [(1, "word1 ünï1 word2 ünï2"), (2, None), (3, "one one")]
    rows = [(k, t, 1, 2) for k, t in odd_documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, m int").repartition(3)
    goal = spark.createDataFrame(target, "item_id long, text string")
    assert sorted(rows_of(resample.resample(docs, goal)), key=repr) == brute_resample(odd_documents(), target)


def test_head_changes_no_bucket(spark):
    docs = spark.createDataFrame(odd_documents(), "doc_id long, text string")
    small, none = resample.fit_head(docs, head_words=3, head_pairs=2, pair_words=2), resample.Head([], [])
    whole = resample.fit_head(docs)
    assert 0 < len(small) <= 3 and 0 < len(small.pairs) <= 2 and len(whole.pairs) > 2
    for _, text in odd_documents():
        words = resample.words_of(text or "")
        assert small.buckets(words).tolist() == none.buckets(words).tolist() == whole.buckets(words).tolist()


def test_equal_rows_are_ranked_one_behind_another(spark, monkeypatch):
    monkeypatch.setattr(resample, "_RUN", 3)
    rows = [(1, 30, 59, 5, 5)] * 10 + [(2, 30, 59, 4, 4)] * 10
    weighed = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = rows_of(resample.draw(weighed, percent=75))
    assert len(got) == 20 and sorted(r[4] for r in got if r[4]) == list(range(1, 16))
    assert {r[0] for r in got if r[4] and r[4] <= 10} == {1}


def test_resampling_of_nothing(spark):
    docs = spark.createDataFrame(odd_documents(), "doc_id long, text string")
    goal = spark.createDataFrame([], "item_id long, text string")
    assert sorted(rows_of(resample.resample(docs, goal)), key=repr) == brute_resample(odd_documents(), [])
    assert rows_of(resample.resample(docs.where("false"), goal)) == []
