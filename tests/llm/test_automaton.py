import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import automaton
from headway.llm.automaton import Codec, MergeAutomaton

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = Codec(PATH)


def ids(text):
    return np.frombuffer(CODEC.encode(text), dtype="<u4").tolist()


def by_ranks(word, merges):
    """Plain merging: the merges in their order, each from left to right."""
    parts = list(word)
    for a, b in merges:
        i = 0
        while i < len(parts) - 1:
            if parts[i] == a and parts[i + 1] == b:
                parts[i : i + 2] = [a + b]
            i += 1
    return parts


@st.composite
def merge_lists(draw):
    tokens, merges = list("abc"), []
    for _ in range(draw(st.integers(0, 14))):
        a, b = draw(st.sampled_from(tokens)), draw(st.sampled_from(tokens))
        if a + b not in tokens:
            tokens.append(a + b)
            merges.append((a, b))
    return tokens, merges


@settings(max_examples=300, deadline=None)
@given(merge_lists(), st.text("abc", max_size=24))
def test_paths_of_any_merge_list(listed, word):
    tokens, merges = listed
    made = MergeAutomaton({t: i for i, t in enumerate(tokens)}, merges)
    assert [tokens[i] for i in made.encode(word)] == by_ranks(word, merges)


def test_every_string_has_one_path():
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "aa"), ("ab", "ab")]
    tokens = ["a", "b", *[a + b for a, b in merges]]
    made = MergeAutomaton({t: i for i, t in enumerate(tokens)}, merges)

    def paths(word, state):
        if not word:
            return 1
        return sum(paths(word[len(t) :], made.behind[i]) for i, t in enumerate(tokens) if word.startswith(t) and made.has_arc(state, i))

    for n in range(9):
        for k in range(2**n):
            assert paths("".join("ab"[k >> i & 1] for i in range(n)), 0) == 1


def test_lists_that_training_cannot_give_are_refused():
    with pytest.raises(ValueError):
        MergeAutomaton({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")])
    with pytest.raises(ValueError):
        Codec(public_tokenizers.path("byte_bpe_50k.json"))  # has a decoder


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abcdeinrst' ,.'éñß1\n", max_size=80), st.text("ΑΣσς İıéÉǅſḰ  １²½'", max_size=30)))
def test_ids_and_text_are_the_librarys(text):
    text = text.encode("utf-8", "replace").decode()  # no lone surrogates
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids(text) == expected
    assert CODEC.decode(CODEC.encode(text)) == LIBRARY.decode(expected, skip_special_tokens=False)


def test_odd_texts():
    vocabulary = [t.removesuffix("</w>") for t in json.load(open(PATH))["model"]["vocab"]]
    texts = ["<|endoftext|>a B<|startoftext|><|endoftext|>", "'street it's I'LL 'Re", "a" * 30_000, " \t\r\n", "­ x­y", "日本語 テキスト"]
    texts += ["".join(vocabulary[i::4999]) for i in range(0, 4999, 50)]
    for text in texts:
        assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_full_cache_changes_nothing():
    small = Codec(PATH, cache_pieces=2)
    assert [small.encode(t) for t in ("one two three four", "four three, two one")] == [CODEC.encode(t) for t in ("one two three four", "four three, two one")]
    assert len(small.cache) == 2


def test_documents(spark):
    rows = [(1, "The cat's hat", 5), (1, "The cat's hat", 5), (2, None, 6), (3, "", 7), (None, "naïve 日本", 8), (4, "long " * 50_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = automaton.encode_documents(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids"]
    expected = [(i, LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows]
    found = [(r["doc_id"], np.frombuffer(r["ids"], dtype="<u4").tolist(), r["n_tokens"]) for r in got.collect()]
    key = lambda r: (str(r[0]), r[1])
    assert sorted(found, key=key) == sorted(((i, x, len(x)) for i, x in expected), key=key)
    decoded = {r["doc_id"]: r["decoded"] for r in automaton.decode_documents(got, PATH).collect()}
    assert decoded == {i: LIBRARY.decode(x, skip_special_tokens=False) for i, x in expected}
    digests = {r["doc_id"]: (r["ids_sha256"], r["decoded_sha256"]) for r in automaton.encode_documents(docs, PATH, digests=True).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert digests == {i: (sha(np.array(x, "<u4").tobytes()), sha(decoded[i].encode())) for i, x in expected}
    assert automaton.encode_documents(docs.limit(0), PATH).count() == 0
    assert automaton.decode_documents(got.selectExpr("doc_id", "cast(null as binary) ids"), PATH).filter("decoded != ''").count() == 0


def test_whole_table_as_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    for r in automaton.encode_documents(docs, PATH).collect():
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == LIBRARY.encode(texts[r["doc_id"]], add_special_tokens=False).ids
