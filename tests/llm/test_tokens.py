"""Token operators against the tokenizers library."""

import gc
import hashlib
import random
import zlib

import numpy as np
import pytest

from lurewatch.llm import bpe_codec, token_counts, token_store

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = P.path("byte_bpe_50k.json")

ODD = [
    "", "a", " ", "a  b", " a\n\nb ", "it's we're!!'s x'", "!!'re 'll", "<|endoftext|>x <|endoftext|>",
    "\u00e9  b \xa0 x", "\x1c a\x1d!\x1c", "\u65e5\u672c\u8a9e \U0001f642\U0001f642 x\u00b2\u00bd", "a\t b\t  c",
    "aaaa" * 400, "-" * 300 + " " * 77 + "x", "\x85\x85x 'S 'T", "don''t ''s", "12'3's 4'''s", "a\u2003\u2003b\u3000",
]


def odd_texts():
    rng = random.Random(5)
    letters = list("ab'st !,.\n\t  1lreLLd|<>") + ["\u00e9", "\x85", "\U0001f642", "\u65e5", "\u00b2", "\u2003"]
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    wide = ["".join(chr(rng.choice([rng.randint(1, 0x3000), rng.randint(32, 127), 32])) for _ in range(30)) for _ in range(500)]
    return ODD + mixed + wide


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_forced_boundaries_equal_the_library(library):
    codec = bpe_codec.codec(PATH)
    for text in odd_texts():
        ids = ids_of(library, text)
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == ids
        assert codec.decode(codec.encode(text)) == library.decode(ids, skip_special_tokens=False) == text


def test_forced_boundaries_cut_inside_long_words():
    codec = bpe_codec.codec(PATH)
    assert len(codec.fragments(b"zqxj" * 5000)) > 1000
    assert not codec.pairs[ord("q") * 256 + ord(" ")]


def test_prefix_counts_equal_the_library(library):
    counter = token_counts.counter(PATH)
    for text in odd_texts():
        assert counter.count(text) == len(ids_of(library, text))
    for text in odd_texts()[:150]:
        for k in range(0, len(text) + 1, max(1, len(text) // 40)):
            assert counter.at(text, k) == len(ids_of(library, text[:k])), (text, k)


def test_longest_prefix_within_a_budget(library):
    counter = token_counts.counter(PATH)
    text = "Thntat reheas onblention of the <|endoftext|> 12,5 don't " * 20
    for budget in (0, 1, 7, 100):
        kept = counter.fitting(text, budget)
        assert len(ids_of(library, text[:kept])) <= budget < len(ids_of(library, text[: kept + 1]))


def test_every_prefix_is_counted_as_the_library_counts_it(library):
    counter = token_counts.counter(PATH)
    for text in odd_texts()[:220]:
        counts = counter.every_prefix(text[:120])
        assert counts == [len(ids_of(library, text[:k])) for k in range(len(text[:120]) + 1)], text
        assert token_counts.unpacked_counts(token_counts.packed_counts(counts)).tolist() == counts
    wide = [0, 5, -300, 1_000_000, 999_999, 0]
    assert token_counts.unpacked_counts(token_counts.packed_counts(wide)).tolist() == wide


DOCS = [(1, "the cat's  hat", "x"), (2, None, "x"), (3, "", None), (3, "", None), (None, "na\u00efve\n\n", "y"), (7, "a" * 70_000, "y")]
#: Extra columns named like those that the operators make.
SCHEMA = "doc_id long, text string, n_tokens string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def test_round_trip_table(docs, library):
    got = sorted(map(tuple, bpe_codec.round_trip(docs, PATH).collect()), key=str)
    want = []
    for key, text, _ in DOCS:
        ids = np.asarray(ids_of(library, text or ""), "<u4").tobytes()
        want.append((key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    coded = bpe_codec.encode_documents(docs, PATH)
    texts = [r["text"] for r in bpe_codec.decode_documents(coded, PATH).collect()]
    assert sorted(texts) == sorted(t or "" for _, t, _ in DOCS)
    assert bpe_codec.round_trip(docs.where("false"), PATH).count() == 0


def test_questions_are_answered_from_the_stored_counts(spark, docs, library, tmp_path):
    token_counts.prefix_counts(docs, PATH).write.parquet(str(tmp_path / "counts"))
    stored = spark.read.parquet(str(tmp_path / "counts"))
    assert stored.columns == ["doc_id", "n_tokens", "counts"]
    got = token_counts.with_longest_within(token_counts.with_tokens_at(stored, 5), 3).drop("counts").collect()
    want = []
    for key, text, _ in DOCS:
        text = text or ""
        sizes = [len(ids_of(library, text[:k])) for k in range(min(len(text), 60) + 1)]
        fits = max(k for k, n in enumerate(sizes) if n <= 3) if len(text) <= 60 else None
        want.append((key, len(ids_of(library, text)), sizes[min(5, len(text))], fits))
    got = [tuple(r)[:3] + (r.fit_chars if r.doc_id != 7 else None,) for r in got]
    assert sorted(got, key=str) == sorted(want, key=str)
    whole = token_counts.with_longest_within(stored, stored["n_tokens"]).where("doc_id = 7").first()
    assert whole.fit_chars == 70_000 and token_counts.with_longest_within(stored, -1).first().fit_chars is None


def test_count_table(docs, library):
    got = sorted(map(tuple, token_counts.token_counts(docs, PATH, limit=3).collect()), key=str)
    want = []
    for key, text, _ in DOCS:
        n = len(ids_of(library, text or ""))
        fit = max(k for k in range(min(len(text or ""), 40) + 1) if len(ids_of(library, (text or "")[:k])) <= 3)
        want.append((key, len((text or "").encode()), n, n > 3, fit))
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(docs.where("false"), PATH).count() == 0


def test_hash_is_minimal_and_perfect():
    keys = [str(k).encode() for k in range(5000)]
    low, high = token_store.key_hashes(keys)
    pilots, slots = token_store.build_hash(low, high)
    assert sorted(slots) == list(range(5000))
    assert (token_store.find_slots(low, high, pilots, 5000) == slots).all()
    with pytest.raises(ValueError):
        token_store.build_hash(*token_store.key_hashes([b"a", b"a", b"b", b"c"]))


def test_no_collection_while_a_batch_is_encoded(library, monkeypatch):
    own, seen = token_store.LibraryEncoder(PATH), []
    many = own._many
    monkeypatch.setattr(own, "_many", lambda pieces: seen.append(gc.isenabled()) or many(pieces))
    got = own.batch(["a b", "", "a b c"])
    assert [np.frombuffer(x, own.kind).tolist() for x in got] == [ids_of(library, t) + [2] for t in ("a b", "", "a b c")]
    assert seen and not any(seen) and gc.isenabled()


def test_buckets_look_for_their_pilots_together(monkeypatch):
    low, high = token_store.key_hashes([str(k).encode() for k in range(8192)])
    steps, slot = [], token_store._slot
    monkeypatch.setattr(token_store, "_slot", lambda *a: steps.append(1) or slot(*a))
    pilots, slots = token_store.build_hash(low, high)
    assert len(steps) < len(pilots) / 4
    assert sorted(slots) == list(range(8192)) and (token_store.find_slots(low, high, pilots, 8192) == slots).all()


def test_store_returns_every_record(spark, docs, library):
    store = token_store.write_store(docs, PATH, shards=3)
    rows = token_store.read_records(token_store.look_up(docs, store), store, payload=True).collect()
    rows = sorted(rows, key=lambda r: r["start"])
    want = sorted((-1 if k is None else k, ids_of(library, t or "") + [2]) for k, t, _ in DOCS)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == want
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)
    assert [r["start"] for r in rows] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in rows])[:-1])).tolist()
    assert all(r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) for r in rows)
    unknown = spark.range(10_000, 14_000).withColumnRenamed("id", "doc_id")
    assert token_store.look_up(unknown, store).count() == 0
    empty = token_store.write_store(docs.where("false"), PATH)
    assert token_store.read_records(token_store.look_up(docs, empty), empty).count() == 0 if empty.bases else True
