import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import packing
from headway.llm.bpe import Encoder, encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(text):
    return encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t.,'sé1aB!~ あ<|"), max_size=30) | st.text(max_size=30), max_size=6))
def test_encoder_equals_the_library(texts):
    enc = encoder(PATH)
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == [plain_ids(t) for t in texts]


def test_encoder_with_a_full_cache_and_special_strings():
    enc = Encoder(PATH, cache_units=3)
    texts = ["one two three four five", "six seven eight\nnine ten", "<|endoftext|> as text", "one six eleven"] * 2
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == [
        enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert 50256 not in np.frombuffer(enc.encode(["<|endoftext|>"])[0], "<u4")


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_plan_uses_every_length_once_and_never_overfills(counts):
    plan = packing.plan_bins(counts, 40)
    used = {}
    for bins, uses in plan:
        assert bins > 0 and sum(length * n for length, n in uses) <= 40
        for length, n in uses:
            used[length] = used.get(length, 0) + bins * n
    assert used == counts
    total = sum(k * n for k, n in counts.items())
    bins = sum(b for b, _ in plan)
    assert -(-total // 40) <= bins <= 2 * -(-total // 40) + 1


def test_two_smaller_ones_replace_the_smallest():
    # greedy: 60 + 30 leaves 10; the two 20s fill the gap of 40 that the 30 leaves
    assert packing.plan_bins({60: 1, 30: 1, 20: 2}, 100)[0] == (1, [(60, 1), (20, 2)])
    greedy = packing.plan_bins({60: 1, 30: 1, 20: 2}, 100, two_fit=False)
    assert greedy[0] == (1, [(60, 1), (30, 1)])
    with pytest.raises(ValueError):
        packing.plan_bins({101: 1}, 100)


def test_plan_is_near_the_lower_bound_and_bounded_in_patterns():
    rng = np.random.default_rng(1)
    lengths = np.minimum(1024, rng.lognormal(5.5, 1.0, 200_000).astype(int) + 1)
    counts = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)], strict=True))
    plan = packing.plan_bins(counts, 1024)
    assert sum(b for b, _ in plan) <= 1.002 * np.ceil(lengths.sum() / 1024)
    assert len(plan) < 10_000


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack_documents_against_plain_python(spark):
    long_text = " ".join(f"word{i}" for i in range(900))
    texts = ["a b c", None, "", long_text, "a b c", "a b c", "é ü\n\nx  y", long_text + " end"]
    docs = [(k, t, "x", 7) for k, t in enumerate(texts)] + [(None, "no id", "x", 7), (0, "a b c", "x", 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string, offset string, sequence_id int")
    packed = packing.pack_documents(df, PATH, capacity=50)
    rows = [r.asDict() for r in packed.collect()]
    check_places(rows, 50)
    got = sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], tuple(r["ids"])) for r in rows)
    want = []
    for doc_id, text, *_ in docs:
        ids = plain_ids(text) + [2]
        at, k, size = 0, 0, len(ids) % 50 or 50
        while at < len(ids):
            want.append((str(doc_id), k, at, size, tuple(ids[at : at + size])))
            at, k, size = at + size, k + 1, 50
    assert got == sorted(want)
    sequences = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in rows:
        s = sequences[r["sequence_id"]]
        assert s["input_ids"][r["offset"] : r["offset"] + r["length"]] == r["ids"]
        assert len(set(s["document"][r["offset"] : r["offset"] + r["length"]])) == 1
    digests = packing.pack_documents(df, PATH, capacity=50, digests=True).collect()
    assert sorted(r["ids_crc32"] for r in digests) == sorted(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)


def test_pack_many_ties_and_an_empty_table(spark):
    rows = [(i % 5, 10 if i % 3 else 7) for i in range(2000)]  # few ids, two lengths
    df = spark.createDataFrame(rows, "k long, length long")
    packed = packing.pack(df, 24).collect()
    assert len(packed) == 2000
    bins = check_places([r.asDict() for r in packed], 24)
    assert bins == sum(b for b, _ in packing.plan_bins({10: 1333, 7: 667}, 24))
    empty = packing.pack(df.filter("k > 100"), 24)
    assert empty.collect() == [] and empty.columns == ["k", "length", "sequence_id", "offset"]
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, None)], "k long, length long"), 24)


def test_marked_words_are_known_by_their_words():
    texts = ["a word, Word; (word) word's, word'll. 3rd, 1,000.00! naïve?! x... 'tis', ²³; \"word\" <|endoftext|>, a.b.c. --word--", "word. a! 3rd? naïve, x;"]
    encode = Encoder(PATH)
    expected = [np.array(e.ids, dtype="<u4").tobytes() for e in Encoder(PATH).tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert encode.encode(texts) == expected and encode.encode(texts[::-1]) == expected[::-1]
    asked, learn = [], encode._learn
    encode._learn = lambda units: asked.extend(units) or learn(units)
    encode.encode(["a word! naïve;"])  # words and marks known, but not together
    assert not asked


def test_a_cut_before_a_mark_after_every_latin_letter_and_sign():
    enc = Encoder(PATH)
    for c in map(chr, range(0x7E, 0x255)):
        texts = [f"{c}.x {c}'s, {c}-{c}", f"a{c}!{c}", f"{c}{c}...\n{c}#", f" {c}", f"{c} "]  # one ends and one begins with a space
        assert enc.encode(texts) == [np.array(plain_ids(t), "<u4").tobytes() for t in texts], hex(ord(c))


def test_words_that_come_again_are_kept_and_single_ones_are_not():
    asked, enc = [], Encoder(PATH, cache_units=300)
    learn = enc._learn
    enc._learn = lambda units: asked.extend(units) or learn(units)
    once = " ".join(f"once{i}" for i in range(1000))  # more single words than there is room for
    enc.encode(["x " + once + " often often", "x seldom"])
    assert " often" in enc.cache and len(enc.cache) < 50  # a few single ones share their place with another
    enc.encode(["x seldom"])
    asked.clear()
    enc.encode(["x often, seldom! x"])
    assert not {" often", " seldom"} & set(asked)
    enc.encode(["x" * 100 + " " + "x" * 100] * 3)
    assert max(map(len, enc.cache)) <= 64


def test_each_different_word_of_a_batch_is_asked_for_once():
    asked, enc = [], Encoder(PATH, cache_units=0)
    learn = enc._learn
    enc._learn = lambda units: asked.extend(units) or learn(units)
    texts = ["one two, two; two\ntwo two", "", " two two. One two,"] * 50
    got = enc.encode(texts)
    assert len(asked) == len(set(asked))
    assert got == [np.array(plain_ids(t), "<u4").tobytes() for t in texts] and not enc.cache


def test_a_full_cache_is_begun_anew_for_other_texts():
    enc = Encoder(PATH, cache_units=50)
    first = " ".join(f"w{i}" for i in range(100))
    enc.encode([first, first])
    assert len(enc.cache) >= 50
    other = " ".join(f"v{i}x" for i in range(100))
    for _ in range(2):
        assert enc.encode([other, other]) == [np.array(plain_ids(other), "<u4").tobytes()] * 2
    assert " v7x" in enc.cache and " w7" not in enc.cache
