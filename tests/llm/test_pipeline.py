"""The pipeline against a plain Python version, on a table small enough to compare all pairs."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import toxicity
from headway.llm.bpe import encoder

from .test_bpe_packing import check_places
from .test_decontam_html import brute as brute_windows
from .test_partenum import brute as brute_groups
from .test_toxicity_quality import brute_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


class PlainKneserNey:
    """The two class models with dicts of byte strings."""

    def __init__(self, texts, labelled):
        every, classes = set(), (Counter(), Counter())
        for doc_id, text in texts:
            words = toxicity.words_of(text)
            for w in words:
                every.update(self.grams(w))
            if doc_id in labelled:
                for w in words:
                    classes[labelled[doc_id]].update(self.grams(w))
        self.classes = classes
        self.context = [defaultdict(Counter), defaultdict(Counter)]
        for k in (0, 1):
            for g, n in classes[k].items():
                self.context[k][g[:-1]][g[-1:]] += n
        # lower orders: before how many bytes an n-gram has been seen
        self.lower = defaultdict(Counter)
        longer = {g for g in every if len(g) == toxicity.ORDER}
        for m in range(toxicity.ORDER - 1, 0, -1):
            before = defaultdict(set)
            for g in longer:
                before[g[1:]].add(g[:1])
            for g, b in before.items():
                self.lower[g[:-1]][g[-1:]] = len(b)
            longer = set(before) | {g for g in every if len(g) == m}

    @staticmethod
    def grams(word):
        s = b" " + word + b" "
        return [s[max(0, i + 1 - toxicity.ORDER) : i + 1] for i in range(1, len(s))]

    def shared(self, gram):
        if not gram:
            return 1 / 256
        seen = self.lower.get(gram[:-1])
        low = self.shared(gram[1:]) if len(gram) > 1 else 1 / 256
        if not seen:
            return low
        return (max(seen[gram[-1:]] - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * len(seen) * low) / sum(seen.values())

    def p(self, k, gram):
        seen = self.context[k].get(gram[:-1])
        if not seen:
            return self.shared(gram[1:])
        return (max(seen[gram[-1:]] - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * len(seen) * self.shared(gram[1:])) / sum(seen.values())

    def value(self, word):
        ratio = sum(math.log(self.p(1, g)) - math.log(self.p(0, g)) for g in self.grams(word))
        return math.log1p(toxicity.SHARE * math.expm1(min(ratio, 60)))

    def margin(self, text):
        words = toxicity.words_of(text)
        return sum(map(self.value, words)) / max(1, len(words)) ** 0.5


def small_corpus(folder):
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abdeiklnorst") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    foul = ["zgrox", "vuxqim", "qwazzle"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(30))) for i in range(5)]
    docs, labels = [], []
    for i in range(150):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(12, 80))]
        bad = i % 5 == 0
        if bad:
            for _ in range(max(2, len(w) // 12)):
                w[rnd.randrange(len(w))] = rnd.choice(foul) + rnd.choice(["", "a", "ing"])
        if i % 11 == 0:
            w[5:5] = items[i % 5][1].split()[3:18]
        docs.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, 1, int(bad)))
    docs += [(200, "short one"), (201, None), (202, "same words again and again " * 20), (203, docs[7][1]), (204, docs[7][1] + " more"), (7, docs[7][1])]
    docs += [(205, docs[13][1].upper()), (206, "")]
    table = pd.DataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], columns=["doc_id", "text", "lang", "source", "n_chars"])
    table.to_parquet(f"{folder}/documents.parquet")
    pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]).to_parquet(f"{folder}/labels.parquet")
    pd.DataFrame(items, columns=["item_id", "text"]).to_parquet(f"{folder}/benchmark.parquet")
    return docs, labels, items


def plain_pipeline(docs, labels, items):
    kept = []
    for d in docs:
        n_words, repeat = brute_counts(d[1])[0], brute_counts(d[1])[5]
        if n_words >= 10 and 100 * repeat <= 20 * n_words:  # too few labels for a cutoff
            kept.append(d)
    fold = lambda i: __import__("zlib").crc32(str(i).encode()) % 5
    learned = {i: t for i, _, t in labels if fold(i) != 0}
    first = PlainKneserNey(kept, {i: t for i, t in learned.items() if fold(i) != 4})
    final = PlainKneserNey(kept, learned)
    rows = [(first.margin(t), learned[i]) for i, t in kept if i in learned and fold(i) == 4]
    slope, cut = toxicity.fit_curve(np.array([m for m, _ in rows]), np.array([y for _, y in rows]))
    assert slope > 0
    kept = [d for d in kept if final.margin(d[1]) < cut]
    after_toxicity = len(kept)
    smallest = {i for i, _, c in brute_groups(kept) if i == c}
    once = {}
    for i, t in kept:
        if str(i) in smallest:
            once[i] = t  # the repeated rows have equal texts here
    kept = [d for d in once.items() if not brute_windows(d[1], items, 10)[3]]
    assert len(docs) > after_toxicity > len(once) > len(kept) > 50
    pieces = []
    for i, t in kept:
        ids = encoder(PATH).tokenizer.encode(t, add_special_tokens=False).ids + [2]
        assert len(ids) <= 1024
        pieces.append((i, 0, 0, len(ids)))
    return sorted(pieces)


def test_pipeline_against_plain_python(spark, tmp_dir):
    docs, labels, items = small_corpus(tmp_dir)
    rows = [r.asDict() for r in corpus_pipeline.run(spark, tmp_dir).collect()]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in rows) == plain_pipeline(docs, labels, items)
    assert check_places(rows, 1024) == -(-sum(r["length"] for r in rows) // 1024)


def test_stages_return_the_columns_of_documents(spark, tmp_dir):
    small_corpus(tmp_dir)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    names = ["score", "kept", "n_words", "stratum", "contaminated", "component_id", "n_hit", "_hw_gone_"]
    docs = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in names])
    given = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tmp_dir)
        assert out.columns == docs.columns, name
        kept = {tuple(r) for r in out.collect()}
        assert kept < given, name
        assert stage(spark, docs.filter("false"), tmp_dir).count() == 0, name
    assert len(corpus_pipeline.STAGES) == 5


def test_near_duplicates_of_shared_and_missing_ids(spark, tmp_dir):
    rnd = random.Random(5)
    a, b, c, d, e = (" ".join(f"{w}{rnd.randint(0, 999)}" for _ in range(60)) for w in "abcde")
    rows = [(1, a), (2, a + " more"), (2, b), (2, c), (2, c), (3, d), (None, d), (None, e), (None, e), (None, e + " more"), (None, b), (4, None), (4, None), (None, None), (None, None), (5, " "), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    out = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{tmp_dir}/documents.parquet"), tmp_dir)
    got = [tuple(r) for r in out.collect()]
    of_e = [r for r in got if r[0] is None and r[1] in (e, e + " more")]
    assert len(of_e) == 1  # that with the smaller hash
    want = [(1, a), (2, b), (2, c), (3, d), (4, None), (None, None), (None, None), (5, " "), (2, "")]
    assert sorted(map(str, got)) == sorted(map(str, want + of_e))


def test_kneser_ney_against_plain_python(spark, tmp_dir):
    docs, labels, _ = small_corpus(tmp_dir)
    learned = {i: t for i, _, t in labels}
    plain = PlainKneserNey(docs, learned)
    grams = sorted({int.from_bytes(g, "big") for _, t in docs for w in toxicity.words_of(t) for g in plain.grams(w)})
    classes = []
    for c in plain.classes:
        pairs = sorted((int.from_bytes(g, "big"), n) for g, n in c.items())
        classes.append((np.array([g for g, _ in pairs], dtype=np.uint64), np.array([n for _, n in pairs])))
    model = toxicity.Model(np.array(grams, dtype=np.uint64), classes)
    words = sorted({w for _, t in docs for w in toxicity.words_of(t)}) + [b"neverseen", b"zgr", b"\xc3\xa9"]
    assert np.allclose(model.values(words), [plain.value(w) for w in words], atol=1e-4)
