import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import partenum
from headway.llm.components import components


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = w.split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    """[(doc_id, n, component)] by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((str(d), len(s), str(least.get(find(i)))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))))


def found(spark, docs):
    df = spark.createDataFrame([(*d, 3, "x") for d in docs], "doc_id long, text string, node int, sig string")
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in partenum.jaccard_groups(df).collect())


def test_most_difference_is_that_of_all_larger_sizes():
    for x in range(1, 600):
        most = max(x + y - 2 * (-(-80 * (x + y) // 180)) for y in range(x, 100 * x // 80 + 1))
        assert partenum.most_difference(np.array([x]))[0] == most


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(0)
    n = 0
    for size in [*range(1, 40), 60, 75, 76, 99, 100, 101, 150, 230, 700, 2000]:
        for _ in range(60 if size < 200 else 10):
            base = rng.integers(0, 2**64, 2 * size + 4, dtype=np.uint64)
            total = rng.integers(0, size // 4 + 2)
            k = rng.integers(0, total + 1)
            a = np.unique(np.concatenate([base[:size], base[size : size + k]]))
            b = np.unique(np.concatenate([base[:size], base[size + k : size + total]]))
            if partenum.similar(a, b):
                n += 1
                sig, of = partenum.signatures([a, b])
                assert np.intersect1d(sig[of == 0], sig[of == 1]).size, (len(a), len(b))
    assert n > 2000


def test_counters_never_rule_out_similar_sets():
    rng = np.random.default_rng(1)
    for size in (1, 4, 5, 50, 20_000):
        base = rng.integers(0, 2**64, size * 2, dtype=np.uint64)
        a, b = np.unique(base[:size]), np.unique(base[size // 10 : size])
        rows = np.array([list(c) for c in partenum.counters([a, b])], dtype=np.uint8)
        assert partenum.similar(a, b) <= partenum._near(np.array([len(a)]), np.array([len(b)]), rows[:1], rows[1:])[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbé \n\t "), max_size=40), max_size=5))
def test_sets_have_as_many_elements_as_shingles(texts):
    assert [len(s) for s in partenum.shingle_sets([t.encode() for t in texts])] == [len(shingles(t)) for t in texts]


def test_long_texts_are_cut_between_words(monkeypatch):
    raws = [b"a b", b" ".join(b"w%d" % (i % 3000) for i in range(9000)), b"", b"c" * 5000 + b" d e f g h i", b"x y z"]
    whole = partenum.shingle_sets(raws)
    monkeypatch.setattr(partenum, "_PIECE", 500)
    for a, b in zip(whole, partenum.shingle_sets(raws), strict=True):
        assert a.tolist() == b.tolist()
    assert [len(s) for s in whole] == [1, 3000, 0, 3, 1]


def make_docs(seed, n_groups=25):
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(50)]
    docs = []
    for _ in range(n_groups):
        base = [f"w{rnd.randint(0, 10**6)}" for _ in range(rnd.choice([1, 3, 5, 6, 7, 9, 12, 20, 45, 90, 130, 300]))]
        if rnd.random() < 0.5:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rnd.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, len(w) // 30, len(w) // 15])):
                w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 10**6)}"
            docs.append(rnd.choice([" ", "\n", "  "]).join(rnd.choice([x, x.upper()]) for x in w))
    docs += [None, "", " \n", "a b", "A  b", "a b c", docs[0], docs[0]]
    rnd.shuffle(docs)
    return [(i * 3, t) for i, t in enumerate(docs)]


def test_groups_against_all_pairs(spark):
    docs = [*make_docs(1), (None, "only here " * 9), (5, "a b"), (3, "w w w w w w w")]
    assert found(spark, docs) == brute(docs)


def test_groups_that_a_first_member_does_not_hold_together(spark, monkeypatch):
    # a chain: neighbours are similar, the ends are not; small blocks make the rest several tasks' work
    monkeypatch.setattr(partenum, "BLOCK", 4)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(words[4 * i : 4 * i + 120])) for i in range(60)] + make_docs(2, 8)
    docs = [(k, t) for k, (_, t) in enumerate(docs)]
    assert found(spark, docs) == brute(docs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    got = partenum.jaccard_groups(df)
    assert got.collect() == [] and got.columns == ["doc_id", "n_shingles", "component_id"]


def test_components(spark):
    rnd = random.Random(7)
    links = [(rnd.randint(0, 150), rnd.randint(0, 150)) for _ in range(110)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
