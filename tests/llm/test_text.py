"""Duplicates, rules, pages and the benchmark against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lurewatch.llm import decontaminate, exact_dedup, html_consensus, jaccard_join, url_filter
from lurewatch.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = [
    (5, "a  b\tc", "p"), (2, "a b c", "q"), (9, "a b  c", "r"), (4, "", "s"), (6, None, "t"), (None, "a b c", "u"),
    (7, "x", "v"), (7, "x", "w"), (7, "x y", "w"), (None, "alone", "z"), (11, " ", "z"),
]
SCHEMA = "doc_id long, text string, {extra} string"


def brute_groups(rows):
    groups = {}
    for key, text, _ in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups.setdefault(norm, []).append(key)
    out = []
    for norm, keys in groups.items():
        keep = min((k for k in keys if k is not None), default=None)
        kept = False
        for k in sorted(keys, key=lambda k: (k is None, k)):
            out.append((k, keep, len(keys), k == keep and not kept, hashlib.sha256(norm.encode()).hexdigest()))
            kept = kept or k == keep
    return sorted(out, key=str)


@pytest.mark.parametrize("hashing", [exact_dedup.md5_hash, lambda c: F.unhex(F.lit("00"))])
def test_exact_groups(spark, hashing):
    """The second hash makes all texts collide: bytes must tell them apart."""
    docs = spark.createDataFrame(DOCS, SCHEMA.format(extra="norm"))
    got = exact_dedup.exact_groups(docs, content_hash=hashing).collect()
    assert sorted(map(tuple, got), key=str) == brute_groups(DOCS)


def test_exact_rows_that_stay(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA.format(extra="keep"))
    kept = [(r["doc_id"], re.sub(r"\s+", " ", r["text"] or "")) for r in exact_dedup.drop_copies(docs).collect()]
    assert sorted(kept, key=str) == sorted([(2, "a b c"), (4, ""), (7, "x"), (7, "x y"), (None, "alone"), (11, " ")], key=str)
    assert exact_dedup.drop_copies(docs.where("false")).columns == docs.columns
    assert exact_dedup.exact_groups(docs.where("false")).count() == 0


URLS = [
    None, "", "no scheme.com/x", "http://a.com/", "http://a.com", "https://EXAMPLE.com/en/1", "http://x.example.com/en/",
    "http://www.example.com/en/a", "http://sub.www.example.com/en/a", "http://notexample.com/en/a", "http://b.net/es/1?x=/fr/",
    "http://b.net/fr", "http://b.net/es/a#b", "http://net/fr/x", "ftp://a://b.com/x", "http://www.casino-win.example.org/de/",
    "http://casinos.org/", "http://a.org/POKER/1", "http://a.com/poker", "http://a.example.com/EN/x",
]


def brute_verdict(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    fits = []
    for verdict, rule in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")):
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    words = re.findall("[a-z0-9]+", (host + path).lower())
    return host, path, None, "block" if {"casino", "poker", "betting", "jackpot", "viagra", "xxx", "porn"} & set(words) else "allow"


def test_url_rules(spark):
    rows = [(i % 18, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[3], "x")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = sorted((tuple(r) for r in url_filter.judge_urls(pages).collect()), key=str)
    assert got == sorted(((i, *brute_verdict(u)) for i, u, _ in rows), key=str)
    assert url_filter.judge_urls(pages.where("false")).count() == 0
    plain = url_filter.judge_urls(pages, host_rules=[], pattern_rules=[]).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in plain] == [(None, "allow")]


def test_rules_are_kept_under_their_rarest_token(spark):
    pages = url_filter.judge_urls(spark.createDataFrame([(1, "http://www.example.com/en/")] * 3 + [(2, "http://example.org/en/")], "page_id long, url string"))
    keys = url_filter._rarest(pages, [url_filter.HOST_RULES[1], url_filter.HOST_RULES[2]])
    assert [keys[r] for r in url_filter.HOST_RULES[1:3]] == ["com", "com"]


# ---- pages -----------------------------------------------------------------

PAGE = """<html><head><title>T</title><script>var a="<p>x</p>";</script></head><body><header>Site</header>
<div class="cookie-notice"><p>We use cookies and more cookies on this very long notice that goes on and on.</p></div>
<nav><a href=/>Home</a></nav><div class="post-{n}"><h1>Ti&amp;tle {n}</h1><p>One &lt;two&gt;
 three <a href=x>linked</a><p>Four<br>five<!-- gone --></p><ul><li>six<li>seven</ul></div>
<div id="comments"><p>First! A reader comment that is far longer than the article itself could ever hope to be.</p></div>
<form><p>Mail</p></form><aside>Side</aside><footer>&copy; end</footer></body></html>"""
TEXT = "Ti&tle {n}\n\nOne <two> three linked\n\nFour five\n\nsix\n\nseven"


def test_main_text_of_pages(spark):
    rows = [(i, f"https://h.org/{i}", PAGE.replace("{n}", str(i)), "x") for i in range(3)]
    rows += [(3, "https://h.org/3", "<body><p>plain page without the usual container</p></body>", "x"), (4, None, None, "x"), (4, "", "", "x"), (None, "https://k.org/", "just <b>text", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, __host string").drop("__host").withColumn("path", F.lit("x"))
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html_consensus.extract_pages(pages).collect()}
    for i in range(3):
        want = TEXT.replace("{n}", str(i))
        assert got[i, f"https://h.org/{i}"] == (want, len(want))
    assert got[3, "https://h.org/3"][0] == "plain page without the usual container"
    assert got[4, None] == got[4, ""] == ("", 0)
    assert got[None, "https://k.org/"][0] == "just text"
    assert html_consensus.extract_pages(pages.where("false")).count() == 0


def test_hosts_agree_on_a_path(spark):
    """One page's long odd container is outvoted by the other pages of its host."""
    usual = "<body><div class=main><p>{}</p></div><div class=extra><p>short</p></div></body>"
    rows = [(i, "http://h.org/", usual.format("some words of an article " * 3)) for i in range(5)]
    rows.append((9, "http://h.org/", "<body><div class=main><p>brief</p></div><div class=extra><p>" + "long filler " * 40 + "</p></div></body>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    paths = html_consensus.host_paths(pages).collect()
    assert [(r["host"], r["path"]) for r in paths] == [("h.org", "body/div.main")]
    got = {r["page_id"]: r["text"] for r in html_consensus.extract_pages(pages).collect()}
    assert got[9] == "brief"


@pytest.mark.parametrize("inside", [
    "<section><p>{}</p></section><section><p>{}</p></section>",
    "<section class=a><p>{}</p></section><section class=b><p>{}</p></section>",
    "<ul><li>{}<li>{}</ul>",
    "<table><tr><td>{}</td><td>{}</td></tr></table>",
    "<blockquote><p>{}</p></blockquote><div class=more><p>{}</p></div>",
])
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div class='content has-sidebar'>{}</div>", "<div class=share-page>{}</div>"])
def test_article_with_all_its_parts(inside, around):
    """Title and introduction stay however much text lists, cells or sections hold."""
    long = "words of the part " * 20
    page = around.format("<h1>Title</h1><p>Intro.</p>" + inside.format(long, long))
    page = f"<body><div class=sidebar><p>{'beside ' * 9}</p></div>{page}<div class=related>Other</div></body>"
    blocks = html_consensus.page_blocks(page)
    scores = html_consensus.container_scores(blocks)
    winner = min(scores, key=lambda p: (-scores[p], p))
    want = "\n\n".join(["Title", "Intro.", long.strip(), long.strip()])
    assert html_consensus.article_text(blocks, winner) == want


def test_long_comments_stay_out():
    page = f"<body><div class=post><p>Short text.</p></div><div id=comments><p>{'a reader said ' * 50}</p></div></body>"
    assert html_consensus.article_text(html_consensus.page_blocks(page), None) == "Short text."


def test_articles_of_the_sample_pages(spark):
    import html

    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r["text"] for r in html_consensus.extract_pages(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)
        blocks = re.split(r"</?(?:p|h1)>", article[1]) if article else []
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
        assert got[page["page_id"]] == "\n\n".join(b for b in blocks if b)


# ---- near copies -----------------------------------------------------------


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets, parent = [shingle_set(r[1]) for r in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(root(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((r[0], len(sets[i]), least[root(i)] if sets[i] else r[0]) for i, r in enumerate(rows)), key=str)


def near_rows():
    """Groups of edited copies, chains, short texts, a passage that all share, nulls and repeated rows."""
    rng, rows = random.Random(2), []
    passage = [f"p{k}" for k in range(30)]
    for g in range(6):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([8, 40, 90, 200]))]
        for c in range(rng.choice([1, 3, 25])):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
            rows.append((g * 100 + c, " ".join(words + passage * (g % 2))))
    chain = [f"c{k}" for k in range(60)]
    rows += [(1000 + k, " ".join(chain[4 * k : 4 * k + 40])) for k in range(6)]
    rows += [(2000 + k, " ".join(passage + [f"u{k}x{j}" for j in range(6)])) for k in range(12)]
    rows += [(1, "One two"), (3000, "one TWO"), (3001, "one"), (3002, ""), (3003, None), (3003, None), (None, "one"), (None, "zz yy xx"), (5, "a b c d e f g"), (5, "a b c d e f g")]
    return [(k, t, "x") for k, t in rows]


def test_near_copies_equal_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = jaccard_join.similar_groups(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)
    kept = sorted((r["doc_id"] for r in jaccard_join.drop_similar(docs).collect()), key=str)
    assert kept == sorted((i for i, _, c in brute_components(rows) if i == c), key=str)
    assert jaccard_join.similar_groups(docs.where("false")).count() == 0


def test_sets_that_share_a_key_are_hashed_again(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 7, 3), (2, 7, 3), (4, 8, 1), (3, 8, 2), (5, None, None)], "id long, g long, h long")
    nodes = jaccard_join._nodes
    assert sorted(map(tuple, nodes(rows).collect())) == [(7, 1, False), (8, 3, True)]
    seeds, documents = [], jaccard_join._documents
    monkeypatch.setattr(jaccard_join, "_documents", lambda *a: seeds.append(a[3]) or documents(*a))
    monkeypatch.setattr(jaccard_join, "_nodes", lambda r: nodes(r).withColumn("clash", F.lit(len(seeds) < 2)))
    docs = spark.createDataFrame(near_rows(), "doc_id long, text string, component_id string")
    got = jaccard_join.similar_groups(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert seeds == [0, 1] and sorted(map(tuple, got), key=str) == brute_components(near_rows())


def test_signatures_part_variants_that_are_not_similar(spark):
    """Eighty variants of one text, each pair a little too far apart, and two that are close: only these are compared."""
    rng, base = random.Random(11), [f"w{k}" for k in range(150)]
    texts = []
    for v in range(80):
        words = list(base)
        for k in rng.sample(range(0, 150, 6), 6):
            words[k] = f"e{v}x{k}"
        texts.append(" ".join(words))
    texts.append(texts[0].replace("w149", "other"))
    sets = [jaccard_join.Shingler()(t) for t in texts]
    keys, links = [jaccard_join.set_key(s)[0] for s in sets], set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            differ = sum(int(x).bit_count() for x in (jaccard_join.signature(a) ^ jaccard_join.signature(b)).view(np.uint64))
            assert differ <= len(a) + len(b) - 2 * both
            if 100 * both >= 75 * (len(a) + len(b) - both):
                links.add((min(keys[i], keys[j]), max(keys[i], keys[j])))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard_join._documents(docs, "doc_id", "text")
    entries = jaccard_join._entries(docs, np.ones(1 << jaccard_join.CELL_BITS, np.int32), "text", 0)
    pairs = jaccard_join._rest_pairs(entries, spark.createDataFrame([], "u long, c long"), rows).collect()
    assert links and links <= {(r["a"], r["b"]) for r in pairs}
    assert len(pairs) < 80 * 79 // 2 // 4


# ---- benchmark -------------------------------------------------------------


def brute_tiles(doc, item, least):
    doc_marks, item_marks, out = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and i + n not in item_marks and d + n not in doc_marks:
                    n += 1
                best = max(best, (n, -d, -i))
        if best[0] < least:
            return out
        n, d, i = best
        doc_marks.update(range(-d, n - d))
        item_marks.update(range(-i, n - i))
        out += n


def test_tiling_equals_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        item = [f"w{rng.randint(0, 25)}" for _ in range(rng.randint(5, 30))]
        doc = [f"w{rng.randint(0, 25)}" for _ in range(30)]
        for _ in range(3):
            a = rng.randrange(len(item))
            doc[rng.randrange(len(doc)) : 0] = item[a : a + rng.randint(3, 12)]
        seeds = decontaminate.Seeds([(1, " ".join(item))], 5)
        found = decontaminate.Matcher(seeds, 0.0).find(" ".join(doc))
        got = round(found[0][1] * len(item)) if found else 0
        assert got == brute_tiles(doc, item, 5)


def test_long_quotes_under_half_an_item_are_found(spark):
    words = [f"w{j}" for j in range(400)]
    once, pieces, few = words[100:150], words[:20] + ["x"] + words[30:50] + ["y"] + words[60:70 + 5], words[100:149]
    short = [w for k in range(0, 100, 10) for w in (*words[k : k + 6], "z")]
    docs = spark.createDataFrame([(k, "before " + " ".join(t) + " after") for k, t in enumerate((once, pieces, few, short))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = decontaminate.contaminated(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["coverage"], r["longest_tile"]) for r in got) == [(0, 0.125, 50), (1, 0.1375, 20)]
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, benchmark).collect()) == [2, 3]


def test_reordered_passages_are_found(spark):
    sentences = [[f"s{k}w{j}" for j in range(8)] for k in range(4)]
    item = ". ".join(" ".join(s) for s in sentences)
    mixed = "Intro words here. " + ", ".join(" ".join(sentences[k]).upper() for k in (2, 0, 3, 1)) + " and an end."
    rows = [(1, mixed, "x"), (2, "nothing at all", "x"), (3, None, "x"), (None, item, "x"), (4, " ".join(sentences[0]), "x"), (1, mixed, "x"), (5, "tiny item", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, coverage string")
    benchmark = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "tiny item")], "item_id long, text string")
    got = decontaminate.contaminated(docs, benchmark).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted([(1, 10), (1, 10), (None, 10), (5, 13)], key=str)
    assert all(r["coverage"] == 1.0 for r in got)
    clean = decontaminate.drop_contaminated(docs, benchmark).collect()
    assert sorted((r["doc_id"] for r in clean)) == [2, 3, 4]
    assert decontaminate.contaminated(docs, benchmark.where("false")).count() == 0
    assert decontaminate.contaminated(docs.where("false"), benchmark).count() == 0


def article_of(body):
    blocks = html_consensus.page_blocks(f"<html><body><header>Site</header>{body}<footer>end</footer></body></html>")
    return html_consensus.article_text(blocks, None).split("\n\n")


ONE, TWO, THREE = ("one " * 30).strip(), ("two " * 25).strip(), ("three " * 20).strip()


@pytest.mark.parametrize("page", [
    f'<div class="post comments-open"><p>{ONE}</p><p>{TWO}</p></div><div class="comments"><p>{THREE}</p></div>',
    f'<div class="content ad-free"><p>{ONE}</p><p>{TWO}</p></div>',
    f'<div class="comments-open"><p>{ONE}</p><p>{TWO}</p></div><div id="cookie-banner">{THREE}</div>',
    f'<div class="main-content nav-open"><p>{ONE}</p><p>{TWO}</p></div><div class="nav">{THREE}</div>',
    f'<div class=wrap><div class="para">{ONE}</div><div class="para2">{TWO}</div></div><div class=ads>{THREE}</div>',
    f"<div class=wrap><div>{ONE}</div><div class=q>{TWO}</div></div>",
    f'<div class="sidebar popup"><h1>{ONE}</h1><p>{TWO}</p></div>',
])
def test_names_do_not_lose_an_article(page):
    assert article_of(page) == [ONE, TWO]


def test_divs_of_text_belong_to_what_is_around_them():
    assert article_of(f'<main><div class="para">{ONE}</div><div class="para2">{TWO}</div><div class="para3">{THREE}</div></main>') == [ONE, TWO, THREE]
    assert article_of(f"<div id=a><div>{ONE}</div><div>{TWO}</div><div class=q>{THREE}</div></div>") == [ONE, TWO, THREE]


def test_a_header_holds_the_title_of_its_article():
    assert article_of(f"<main><header><h1>Title</h1></header><p>{ONE}</p></main>") == ["Title", ONE]
    assert article_of(f"<div class=post><header><h1>Title</h1></header><p>{ONE}</p></div>") == ["Title", ONE]
    assert article_of(f"<article><header><h1>Title</h1></header><p>{ONE}</p></article>") == ["Title", ONE]
    assert article_of(f"<div><header><h1>Site</h1></header></div><div class=post><p>{ONE}</p></div>") == [ONE]


def test_long_comments_stay_out():
    assert article_of(f'<div class=post><h1>T</h1><p>{ONE}</p></div><section class="comments"><article class=comment><p>{TWO * 5}</p></article></section>') == ["T", ONE]


def test_any_rule_meets_its_urls(spark):
    rules = [url_filter.host_rule("block", n) for n in ("example.com/en", "example.org/En/", "пример/", "Whole.net")]
    urls = ["http://example.com/english", "http://a.example.com/en", "http://example.com/fr", "http://example.org/En/x", "http://example.org/en/x",
            "http://пример/a", "http://whole.net", "http://x.whole.net/y", "http://wholes.net/", "http://whole.net.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {urls[r["page_id"]]: r["rule"] for r in url_filter.judge_urls(pages, host_rules=rules, pattern_rules=[]).collect()}
    assert {u for u, rule in got.items() if rule} == {urls[i] for i in (0, 1, 3, 5, 6, 7)}


def test_drop_stages_keep_columns_of_any_name_and_kind(spark):
    kind = "doc_id long, text string, own_hash string, place int, __own string, __n int, __hash string, KEPT_ID long, m map<string,int>"
    rows = [(i, t, "a", 1, "b", 2, "c", 3, {"k": i % 2}) for i, t in enumerate(["x y z"] * 3 + ["other words here now ok", None, ""])]
    docs = spark.createDataFrame(rows + [(0, "x y z", "a", 1, "b", 2, "c", 3, {"k": 7})], kind)
    for drop, ids in ((exact_dedup.drop_copies, [0, 3, 4]), (jaccard_join.drop_similar, None)):
        got = drop(docs)
        assert got.columns == docs.columns
        out = got.collect()
        assert all((r["own_hash"], r["place"], r["__own"], r["__n"], r["__hash"], r["KEPT_ID"]) == ("a", 1, "b", 2, "c", 3) for r in out)
        assert ids is None or sorted(r["doc_id"] for r in out) == ids


def test_very_long_texts_are_read_whole(spark):
    import sys

    long = " ".join(f"w{i % 9973}" for i in range(200_000))
    docs = spark.createDataFrame([(1, long), (2, long.replace(" ", "  ")), (3, long + " end")], "doc_id long, text string")
    groups = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_groups(docs).collect()}
    assert groups == {1: 1, 2: 1, 3: 3}
    assert {r["component_id"] for r in jaccard_join.similar_groups(docs).collect()} == {1}
    quote = " ".join(f"w{i % 9973}" for i in range(199_000, 199_060))
    bench = spark.createDataFrame([(7, quote)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.contaminated(docs, bench).collect()} == {1, 2, 3}
    page = "<html><body><article>" + "".join(f"<p>{long[i : i + 1000]}</p>" for i in range(0, len(long), 1000)) + "</article></body></html>"
    pages = spark.createDataFrame([(1, "http://a.b/c", page)], "page_id long, url string, html string")
    assert html_consensus.extract_pages(pages).first()["n_chars"] > 0.99 * len(long)
    url = spark.createDataFrame([(1, "http://example.com/en/" + "a" * 1_000_000)], "page_id long, url string")
    assert url_filter.judge_urls(url).first()["verdict"] == "block" and sys.getsizeof(long) > 1 << 20
