"""Language model, classifier and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lurewatch.llm import jaccard_join, ngram_model, pitman_yor, quality
from lurewatch.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stirling_numbers():
    """Without discount they are the unsigned Stirling numbers of the first kind."""
    first = {(0, 0): 1}
    for c in range(8):
        for t in range(1, 9):
            first[c + 1, t] = first.get((c, t - 1), 0) + c * first.get((c, t), 0)
    logs = pitman_yor.stirling(0.0, 8)
    for (c, t), n in first.items():
        assert n == 0 and logs[c, t] == -np.inf or math.isclose(math.exp(logs[c, t]), n, rel_tol=1e-9)


def test_tables_follow_their_distribution():
    d, p, rest, c, n = 0.6, 0.3, 4, 4, 40_000
    logs = pitman_yor.stirling(d, pitman_yor.EXACT)
    drawn = pitman_yor.draw_tables(np.full(n, c), np.full(n, p), np.full(n, rest), d, logs, np.random.default_rng(1))
    weight = [math.exp(logs[c, t]) * p**t * math.prod(1.0 + d * (rest + j) for j in range(t)) for t in range(1, c + 1)]
    for t in range(1, c + 1):
        assert abs(np.mean(drawn == t) - weight[t - 1] / sum(weight)) < 0.01
    many = pitman_yor.draw_tables(np.full(50, 10_000), np.full(50, p), np.full(50, rest), d, logs, np.random.default_rng(1))
    assert (many > 1).all() and (many < 10_000).all()


def test_predictions_sum_to_one():
    block = pitman_yor.Block()
    for k in range(30):
        block.add(k, False, " ".join(f"w{(k * j * j) % 23}" for j in range(40)))
    _, requests = block.close(1)
    part = pitman_yor.Part([r for _, r in requests])
    held = np.bincount(part.context, weights=part.customers, minlength=pitman_yor.CONTEXTS)
    types = int((part.counts > 0).sum())
    model = pitman_yor.Model(int(part.customers.sum()), types, (0.7, 0.6, 0.5), held, part.totals())
    logs = [pitman_yor.stirling(d, pitman_yor.EXACT) for d in model.discounts]
    for tables in part.run(model, 2, logs, np.random.default_rng(0)):
        p0, p1, p2 = part.predict(model, tables)
        assert math.isclose(p0.sum() + (1 + 0.5 * tables[2][0]) / (types + 1) / (1 + tables[1].sum()), 1.0, rel_tol=1e-9)
        two, one = tables[0], tables[1]
        context = part.context[0]
        last = context // pitman_yor.BEFORE
        eaten = two[last * pitman_yor.BEFORE : (last + 1) * pitman_yor.BEFORE].sum()
        behind = (1 + 0.6 * one[last]) / (1 + eaten) * p0
        own1 = part.last == last
        behind[part.word[own1]] = p1[own1]
        all2 = (1 + 0.7 * two[context]) / (1 + held[context]) * behind
        own2 = part.context == context
        all2[part.word[part.up[own2]]] = p2[own2]
        unknown = (1 + 0.7 * two[context]) / (1 + held[context]) * (1 + 0.6 * one[last]) / (1 + eaten)
        unknown *= (1 + 0.5 * tables[2][0]) / (types + 1) / (1 + one.sum())
        assert math.isclose(all2.sum() + unknown, 1.0, rel_tol=1e-9)


def brute_base(rows):
    low = {c: c + 32 for c in range(65, 91)}
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + [" "] for _, t in rows]
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2 for k, _ in rows]
    count = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = sum(count.values()), len(count)
    return [
        (k, h, len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6))
        for (k, _), h, ws in zip(rows, held, words)
    ]


def scored(docs):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    rows = pitman_yor.score_documents(docs).collect()
    assert all(r["score"] <= 0 for r in rows)
    return sorted((tuple(round(r[c], 6) if c == "base_score" else r[c] for c in names) for r in rows), key=str)


def test_scores_of_odd_rows(spark):
    rows = [(1, "The the\tcat"), (2, None), (3, ""), (3, ""), (None, "caf\u00e9 the"), (40, "the " * 3000), (5, "x\x1cy z")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    assert scored(docs) == sorted(brute_base(rows), key=str)
    assert pitman_yor.score_documents(docs.where("false")).count() == 0
    alone = next(k for k in range(50) if zlib.crc32(str(k).encode()) % 7 == 2)
    assert scored(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")) == brute_base([(alone, "a b")])


def test_model_beats_the_base_on_texts_held_out(spark):
    docs = table(spark, SF, "documents")
    rows = pitman_yor.score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]
    assert scored(docs) == sorted(brute_base([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]), key=str)


def test_trigram_predictions_sum_to_one():
    rng = np.random.default_rng(3)
    block = ngram_model.Block()
    for k in range(40):
        block.add(k, False, " ".join(f"w{j}" for j in rng.integers(0, 12, 30)))
    _, requests = block.close(1, {})
    part = ngram_model.Part([r for _, r in requests], {})
    one, two = part.shared()
    part.take(one, two, np.minimum(two, 1))
    types = len(part.t0)
    model = ngram_model.Model(int(part.customers.sum()), types, (0.7, 0.6, 0.5), *part.begin)
    logs = [pitman_yor.stirling(d, pitman_yor.EXACT) for d in model.discounts]
    for _ in range(2):
        part.sweep(model, logs, rng)
        p0, p1, p2 = part.predict(model)
        t3, c2, t2, c0, customers, tables = part.totals(model)
        unknown = (1 + 0.5 * tables) / (types + 1) / (1 + customers)
        assert math.isclose(p0.sum() + unknown, 1.0, rel_tol=1e-9)
        for context in (0, 50, part.ends[0] - 1):
            own = part.context == context
            last = part.last[part.up[own][0]]
            behind = (1 + 0.6 * t2[last]) / (1 + c2[last])
            after = behind * p0
            mine = part.last == last
            after[part.word[mine]] = p1[mine]
            shown = (1 + 0.7 * t3[context]) / (1 + part.held[context])
            everything = shown * after
            everything[part.word[part.up[own]]] = p2[own]
            assert math.isclose(everything.sum() + shown * behind * unknown, 1.0, rel_tol=1e-9)


def test_a_sweep_draws_where_tables_can_differ(monkeypatch):
    """The seating is that of a draw over all dishes; dishes of one customer are not handed to it."""
    rng = np.random.default_rng(8)
    block = ngram_model.Block()
    for k in range(60):
        block.add(k, k % 7 == 2, " ".join(f"w{j}" for j in rng.zipf(1.6, 40) % 400))
    _, requests = block.close(1, {})
    part, whole = (ngram_model.Part([r for _, r in requests], {}) for _ in range(2))
    one, two = part.shared()
    for p in (part, whole):
        p.take(one, two, np.minimum(two, 1))
    model = ngram_model.Model(int(part.customers.sum()), len(part.t0), (0.7, 0.6, 0.5), *part.begin)
    logs = [pitman_yor.stirling(d, pitman_yor.EXACT) for d in model.discounts]
    draws, of_all = (np.random.default_rng(2) for _ in range(2))
    handed, draw = [], pitman_yor.draw_tables
    monkeypatch.setattr(pitman_yor, "draw_tables", lambda customers, *rest: handed.append(customers) or draw(customers, *rest))
    for k in range(3):
        part.sweep(model, logs, draws)
        (d3, d2, d0), p = model.discounts, whole
        p0, p1, _ = p.predict(model)
        t3, _, t2, *_ = p.totals(model)
        p.t3 = draw(p.customers, p1[p.up], t3[p.context] - p.t3, d3, logs[0], of_all)
        p.c2 = np.bincount(p.up, weights=p.t3).astype(np.int64)
        p.t2 = draw(p.c2, p0[p.word], t2[p.last] - p.t2, d2, logs[1], of_all)
        c0, _, tables = p.totals(model)[3:]
        p.t0 = draw(c0, np.full(len(c0), 1 / (model.types + 1)), np.maximum(tables - p.t0, 0), d0, logs[2], of_all)
        assert all((x == y).all() for x, y in zip((part.t3, part.c2, part.t2, part.t0), (p.t3, p.c2, p.t2, p.t0)))
        assert (handed[3 * k] > 1).all() and (handed[3 * k + 1] > 1).all() and len(handed[3 * k]) < len(part.customers)
        if k == 1:  # a later task takes the seating up where this one left it
            later = ngram_model.Part([r for _, r in requests], {})
            draws = later.seat(part.seats(draws))
            sums, tables = part.shared(), part.t0[part.order]
            for p in (later, whole):
                p.take(*sums, tables)
            part = later
    assert (part.t3 > 1).any() and np.allclose(part.predict(model)[2], whole.predict(model)[2], rtol=0, atol=0)


def test_shuffles_of_stored_sums_are_dropped(spark, monkeypatch):
    """Each round of the parts moves all trigrams; only one of them may lie on the disk at a time."""
    shown = []
    keep = ngram_model.stored
    monkeypatch.setattr(ngram_model, "stored", lambda df, name: shown.append((name, spark.conf.get(ngram_model._CLEANUP, None))) or keep(df, name))
    docs = spark.createDataFrame([(k, f"a b c w{k % 5}") for k in range(40)], "doc_id long, text string")
    assert pitman_yor.score_documents(docs).count() == 40
    assert {"pitman-first", "pitman-second"} <= {name for name, on in shown if on == "true"}
    assert spark.conf.get(ngram_model._CLEANUP, None) is None


def test_repeated_passages_raise_the_score(spark):
    """Words that end alike: only their sequence tells the passage from its words in another order."""
    held = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 7 == 2]
    words = [f"w{j}aa" for j in range(60)]
    rng = np.random.default_rng(0)
    rows = [(k, " ".join(words)) for k in range(1000, 1040)]
    rows += [(held[0], " ".join(words)), (held[1], " ".join(rng.permutation(words)))]
    got = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]] > got[held[1]] + 30


def test_spread_contexts_are_shared_by_parts():
    """Totals of a context dealt over parts by word equal those of one part."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 9, 50) * rng.integers(0, 2, 50)) for _ in range(30)]

    def parts(n, slices):
        block = ngram_model.Block()
        for k, t in enumerate(texts):
            block.add(k, False, t)
        return [ngram_model.Part([r], slices) for _, r in block.close(n, slices)[1]]

    whole, spread = parts(1, {})[0], parts(8, {int(h): 8 for h in ngram_model.hashed([b"w0"])})
    assert sum(len(p.open2) for p in spread) > 1
    sums = {}
    for p in spread:
        for key, one, two in zip(p.keys, *p.shared()):
            sums[key] = tuple(np.add(sums.get(key, (0, 0)), (one, two)))
    want = dict(zip(whole.keys, zip(*whole.shared())))
    assert all(sums[k] == v for k, v in want.items())
    for p in spread:
        one, two = (np.asarray([sums[k][j] for k in p.keys]) for j in (0, 1))
        p.take(one, two, np.minimum(two, 1))
    model = ngram_model.Model(0, len(whole.t0), (0.7, 0.6, 0.5), 0, 0)
    at = [p.totals(model)[2][p.open2] for p in spread if len(p.open2)]
    w0 = np.flatnonzero(whole.hashes == ngram_model.hashed([b"w0"])[0])[0]
    assert w0 >= 0 and all(x[0] == at[0][0] for x in at)
    assert whole.own()[2].max() == at[0][0]


# ---- classifier ------------------------------------------------------------


def test_quality_on_rows_held_out(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit_classifier(docs, labels)
    rows = quality.score_documents(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    kept = {r["doc_id"] for r in quality.keep_good(docs, model).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in quality.score_documents(docs, model).where("predicted = 1").collect()}


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a b", "y"), (3, "z " * 5000, "y")], "doc_id long, text string, held_out string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, None)], "doc_id long, quality int")
    for known in (labels, labels.where("false")):
        rows = quality.score_documents(docs, quality.fit_classifier(docs, known)).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_documents(docs.where("false"), quality.fit_classifier(docs.where("false"), labels)).count() == 0


def test_network_is_calibrated_by_temperature():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, quality.WIDTH)).astype(np.float32)
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    net = quality.fit_network(x, y, np.arange(4000) % 5 == 0)
    scores = net.scores(rng.normal(size=(4000, quality.WIDTH)))
    assert 0.25 <= net.temperature <= 8 and abs(scores.mean() - 0.5) < 0.05


# ---- pipeline --------------------------------------------------------------


def test_pipeline_equals_its_stages_one_by_one(spark):
    """Each stage against a plain version on what its predecessor kept."""
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "jaccard_join", "decontaminate", "bpe_round_trip"]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = [corpus_pipeline.STAGES[0][1](spark, docs, SF).cache()]
    first = {r["doc_id"] for r in kept[0].collect()}
    known = [d for d in labels if zlib.crc32(str(d).encode()) % 5]
    assert sum((d in first) == bool(labels[d]) for d in known) > 0.95 * len(known)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        kept.append(stage(spark, kept[-1], SF).cache())
        assert kept[-1].columns == docs.columns
    texts = [{r["doc_id"]: r["text"] for r in k.collect()} for k in kept]
    least = {}
    for d in sorted(texts[0]):
        least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[0][d] or ""), d)
    assert set(texts[1]) == set(least.values())
    shingles = jaccard_join.Shingler()
    sets = {d: set(shingles(t or "").tolist()) for d, t in texts[1].items()}
    group = {d: d for d in sets}
    for d in sorted(sets):
        for e in sorted(sets):
            both = len(sets[d] & sets[e])
            if e < d and both and 100 * both >= 75 * (len(sets[d]) + len(sets[e]) - both):
                a, b = group[d], group[e]
                group = {k: min(a, b) if v in (a, b) else v for k, v in group.items()}
    assert set(texts[2]) == {d for d, g in group.items() if d == g}
    squeeze = lambda t: " ".join((t or "").lower().split())
    items = [squeeze(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    holding = {d for d, t in texts[2].items() if any(i in squeeze(t) for i in items)}
    assert holding and set(texts[3]) == set(texts[2]) - holding
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r["doc_id"] for r in out.collect()} == set(texts[3])


@pytest.mark.parametrize("name", ["quality_classifier", "exact_dedup", "jaccard_join", "decontaminate", "bpe_round_trip"])
def test_stages_take_an_empty_table(spark, name):
    docs = table(spark, SF, "documents").where("false")
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, SF).count() == 0
