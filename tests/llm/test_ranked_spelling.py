import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import ranked, spelling

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_ranking(docs, items, k):
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counted:
            m = 10 + (90 * n * n_docs) // n_terms
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return out


def test_ranking_is_that_of_a_plain_search(spark):
    rnd = random.Random(3)
    vocabulary = ["a", "B", "the", "rare", "É", "x1", "naïve", *[f"w{i}" for i in range(40)]]
    text = lambda most: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, most)))
    docs = [(i, text(60)) for i in range(150)]
    docs += [(None, "rare rare é"), (150, None), (151, ""), (152, "... !"), (153, "w1 " * 20_000), (7, "rare a"), (7, "rare a")] + [(200 + i, "w3 rare x1") for i in range(25)]
    items = [(i, text(12)) for i in range(12)] + [(3, "rare x1"), (None, "THE a"), (77, None), (78, ""), (79, "unseen"), (3, "rare x1")]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, item_id string, n int")
    bench = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, doc_id int")
    expected = sorted(map(str, brute_ranking(docs, items, 10)))
    # as it is; one owner and tiny blocks; several passes over the documents
    for options in ({}, {"owners": 1, "block_docs": 1}, {"vocabulary": 45, "owners": 4}):
        got = ranked.search(df, bench, **options)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(str(tuple(r)) for r in got.collect()) == expected
    assert ranked.search(df.limit(0), bench).count() == 0
    assert ranked.search(df, bench.limit(0)).count() == 0
    named = ranked.search(df.withColumnRenamed("text", "body"), bench.withColumnRenamed("text", "q"), k=2, text_col="body", item_text_col="q")
    assert sorted(str(tuple(r)) for r in named.collect()) == sorted(map(str, brute_ranking(docs, items, 2)))


def edits_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé", min_size=2, max_size=6), min_size=1, max_size=90), st.integers(2, 5))
def test_bit_sliced_sets_are_those_of_plain_edits(words, shorter):
    words = sorted(w for w in words if len(w) in (shorter, shorter + 1))
    if not words:
        return
    raw = [w.encode("latin-1") for w in words]
    group = np.array([zlib.crc32(w[:1]) % 2 for w in raw])
    i, j = spelling.near_words(raw, np.full(len(raw), shorter), group)
    expected = {
        (x, y)
        for x in range(len(words))
        for y in range(len(words))
        if group[x] == group[y] and min(len(raw[x]), len(raw[y])) == shorter and edits_one(raw[x], raw[y])
    }
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(expected)


def brute_variants(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    holes = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for hole, same in holes.items():
        for w in same:
            near[w] |= same - {w}
            if (less := hole.replace("\0", "")) in n:
                near[w].add(less)
                near[less].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def test_variants_are_those_of_a_plain_count(spark):
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(6, 9))) for _ in range(25)]
    words = []
    for w in base:
        n = rnd.choice([5, 30, 200])
        words += [w] * n
        for m in (n // 6, 5):
            at = rnd.randrange(len(w))
            words += [rnd.choice([w[:at] + "x" + w[at:], w[:at] + w[at + 1 :], w[:at] + "y" + w[at + 1 :]])] * max(5, m)
    words += ["aaaaaaa" + "b" * k for k in range(12) for _ in range(6)] + ["AbcdeF", "abcdef"] * 4 + ["É" * 7, "é" * 7] * 5 + ["z" * 3000] * 6 + ["z" * 2999] * 40
    words += ["ab×cde÷", "ÀÿÀÿÀÿ"] * 6
    rnd.shuffle(words)
    docs = [(i, rnd.choice([" ", ", ", "7", "日"]).join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    docs += [(None, "nullid nullid nullid"), (None, "nullid nullid"), (5, None), (6, ""), (7, "123 !!"), (8, "again! " * 7), (8, "again! " * 7)]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, word string, n int")
    expected = brute_variants(docs)
    assert any(f and r != f for _, f, r, *_ in expected)  # forms of forms
    for options in ({}, {"group_words": 2, "index_words": 3}):
        got = spelling.variants(df, **options)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert {tuple(r) for r in got.collect()} == expected
    assert spelling.variants(df.limit(0)).count() == 0
