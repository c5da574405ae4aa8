"""Toxicity scores from class-conditional Kneser-Ney models.

Words are modelled byte by byte, from at most ``ORDER - 1`` bytes of the same
word (with the space before it).  Each class has its own highest-order counts,
from labelled rows; both back off to one set of lower-order continuation counts
taken from all documents, so an expression that is rare in a class is judged by
what the whole corpus says about its parts.  A toxic document is mostly ordinary
words: its model is a mixture of the ordinary model and a small share of the
toxic one.  The difference of the two log-likelihoods is divided by the square
root of the number of words, and a logistic curve fitted on labelled rows that
the first model has not seen turns it into a score.
"""

from __future__ import annotations

import copy
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import NOT_ALPHANUMERIC, release_worker, word_table, worker_state, written

#: Bytes of an n-gram, the last of which is predicted; at most 8.
ORDER = 6
DISCOUNT = 0.75
#: Share of toxic words in a toxic document.
SHARE = 0.01
#: At most so many labelled rows are learned from, those with the smallest hash of their id.
LABELLED_ROWS = 400_000
#: Distinct words whose value a worker keeps, and that are counted before they are turned into n-grams, a part at a time.
CACHED_WORDS = 200_000
PART_WORDS = 50_000
#: Labels are learned from the folds 1 to 4 of crc32(id) mod 5; fold 4 fits the curve of a model of folds 1 to 3.
FOLDS, HELD_OUT, CURVE_FOLD = 5, 0, 4

_TABLE = word_table(NOT_ALPHANUMERIC, lower=False)
_SLOTS = ["everywhere", "ordinary", "toxic", "ordinary_curve", "toxic_curve"]


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all other characters beyond ASCII."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return (F.crc32(id_col.cast("string").cast("binary")) % FOLDS).cast("int")


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each word and its end: the longest n-gram that ends there as a number, and the word's index."""
    raw = np.frombuffer(b"".join([b" " + w + b" " for w in words]), dtype=np.uint8)
    size = np.array([len(w) + 2 for w in words], dtype=np.int64)
    place = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
    gram = raw.astype(np.uint64)
    for k in range(1, min(ORDER, len(raw))):
        before = np.zeros(len(raw), dtype=np.uint64)
        before[k:] = raw[:-k]
        before[place < k] = 0
        gram |= before << np.uint64(8 * k)
    keep = place > 0
    return gram[keep], np.repeat(np.arange(len(words)), size)[keep]


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of sorted keys; 0 for others."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _by_context(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, their total counts and how many bytes follow them."""
    contexts, inverse = np.unique(grams >> np.uint64(8), return_inverse=True)
    return contexts, np.bincount(inverse, weights=counts, minlength=len(contexts)), np.bincount(inverse, minlength=len(contexts))


class Shared:
    """Lower-order probabilities from continuation counts: before how many bytes an n-gram has been seen."""

    def __init__(self, grams: np.ndarray):
        size = np.zeros(len(grams), dtype=np.int64)
        for k in range(ORDER):
            size += (grams >> np.uint64(8 * k)) > 0
        self.levels: dict[int, tuple] = {}
        longer = grams[size == ORDER]
        for m in range(ORDER - 1, 0, -1):
            seen, n = np.unique(longer & np.uint64((1 << 8 * m) - 1), return_counts=True)
            self.levels[m] = (seen, n, *_by_context(seen, n))
            longer = np.union1d(seen, grams[size == m])

    def probability(self, grams: np.ndarray, m: int) -> np.ndarray:
        """Of the last byte of n-grams of ``m`` bytes."""
        if m == 0:
            return np.full(len(grams), 1 / 256)
        seen, n, contexts, total, kinds = self.levels[m]
        lower = self.probability(grams & np.uint64((1 << 8 * (m - 1)) - 1), m - 1)
        context = grams >> np.uint64(8)
        there = _lookup(contexts, total, context)
        own = np.maximum(_lookup(seen, n, grams) - DISCOUNT, 0) + DISCOUNT * _lookup(contexts, kinds, context) * lower
        return np.where(there > 0, own / np.maximum(there, 1), lower)


def _shorter(grams: np.ndarray) -> np.ndarray:
    """N-grams without their first byte."""
    out = np.zeros_like(grams)
    for m in range(2, ORDER + 1):
        mine = grams >= np.uint64(1 << 8 * (m - 1))
        out[mine] = grams[mine] & np.uint64((1 << 8 * (m - 1)) - 1)
    return out


def lower_orders(grams: np.ndarray, seen: np.ndarray, n: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """What ``Shared`` gives for ``grams`` without their first byte, from a table (sorted by ``seen``) of all that they
    end with: continuation counts, and those of the context: their total and how many bytes follow it."""
    p = np.zeros(len(seen))
    own, back = np.maximum(n - DISCOUNT, 0), DISCOUNT * kinds
    ends = np.searchsorted(seen, np.array([1 << 8 * m for m in range(ORDER)], dtype=np.uint64))
    for m in range(1, ORDER):  # shorter ones come first
        at = slice(ends[m - 1], ends[m])
        lower = np.full(at.stop - at.start, 1 / 256) if m == 1 else p[np.searchsorted(seen, _shorter(seen[at]))]
        p[at] = (own[at] + back[at] * lower) / total[at]
    return p[np.searchsorted(seen, _shorter(grams))]


class Model:
    """log P(toxic) - log P(ordinary) of n-grams seen in a class, and of others by their context.

    ``everywhere`` are all n-grams, or those (sorted) whose lower-order probabilities are ``lower``.
    """

    def __init__(self, everywhere: np.ndarray, classes: list[tuple[np.ndarray, np.ndarray]], lower: np.ndarray | None = None):
        self.grams = np.union1d(classes[0][0], classes[1][0])
        self.contexts = np.unique(self.grams >> np.uint64(8))
        if lower is None:
            shared = Shared(everywhere)
            lower = np.zeros(len(self.grams))
            for m in range(2, ORDER + 1):
                mine = (self.grams < np.uint64(1 << 8 * m)) if m < 8 else np.ones(len(self.grams), dtype=bool)
                mine &= self.grams >= np.uint64(1 << 8 * (m - 1))
                lower[mine] = shared.probability(self.grams[mine] & np.uint64((1 << 8 * (m - 1)) - 1), m - 1)
        else:
            lower = lower[np.searchsorted(everywhere, self.grams)]
        own, rest = [], []
        for grams, counts in classes:
            contexts, total, kinds = _by_context(grams, counts)
            context = self.grams >> np.uint64(8)
            there, follow = _lookup(contexts, total, context), _lookup(contexts, kinds, context)
            p = np.maximum(_lookup(grams, counts, self.grams) - DISCOUNT, 0) + DISCOUNT * follow * lower
            own.append(np.log(np.where(there > 0, p / np.maximum(there, 1), lower)))
            there, follow = _lookup(contexts, total, self.contexts), _lookup(contexts, kinds, self.contexts)
            rest.append(np.log(np.where(there > 0, DISCOUNT * follow / np.maximum(there, 1), 1)))
        self.by_gram = (own[1] - own[0]).astype(np.float32)
        self.by_context = (rest[1] - rest[0]).astype(np.float32)
        self.slope, self.cut = 1.0, 0.0
        self.cache: dict[bytes, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def values(self, words: list[bytes]) -> list[float]:
        """Of each word: how much likelier it is in a toxic document (log of the mixture over the ordinary model)."""
        if not words:
            return []
        if not len(self.grams):
            return [0.0] * len(words)
        grams, of = word_grams(words)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        each = np.where(self.grams[at] == grams, self.by_gram[at], _lookup(self.contexts, self.by_context, grams >> np.uint64(8)))
        ratio = np.bincount(of, weights=each, minlength=len(words))
        return np.log1p(SHARE * np.expm1(np.minimum(ratio, 60))).tolist()

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Length-normalised difference of log-likelihoods; 0 for a text without words."""
        out = np.zeros(len(texts))
        for begin in range(0, len(texts), 256):  # few texts at a time are cut into words
            docs = [words_of(t) for t in texts[begin : begin + 256]]
            new = list({w for words in docs for w in words if w not in self.cache})
            found = dict(zip(new, self.values(new), strict=True))
            if len(self.cache) < CACHED_WORDS:  # a full cache stays: what comes first is what comes often
                self.cache.update(found)
                found = self.cache
            else:
                found = _Both(self.cache, found)
            for k, words in enumerate(docs, begin):
                out[k] = sum(map(found.__getitem__, words)) / max(1, len(words)) ** 0.5
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.margins(texts) - self.cut), -500, 500)))


class _Both(dict):
    """Two dicts as one."""

    def __init__(self, first: dict, second: dict):
        super().__init__(second)
        self.first = first

    def __missing__(self, key):
        return self.first[key]


def fit_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, cut): the cut errs least on the labels (the middle of the widest such gap), the slope has the largest
    likelihood around it, with a weak prior; (1, 0) without rows of both classes."""
    if len(np.unique(labels)) < 2:
        return 1.0, 0.0
    order = np.argsort(margins, kind="stable")
    x, y = margins[order], labels[order]
    # errors of a cut between the rows i-1 and i
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    gaps = np.where(errors == errors[np.diff(edges) > 0].min(), np.diff(edges), -1)
    k = int(gaps.argmax())
    cut = (edges[k] + edges[k + 1]) / 2
    slopes = np.geomspace(0.05, 50, 61)
    z = np.where(labels > 0, 1, -1)[None, :] * (margins - cut)[None, :] * slopes[:, None]
    loss = np.logaddexp(0, -z).sum(axis=1) + 0.5 * np.log(slopes) ** 2
    return float(slopes[loss.argmin()]), float(cut)


def labelled_rows(labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "toxic", limit: int = LABELLED_ROWS):
    """Ids (sorted), classes and curve-fold marks of the rows to learn from, at most ``limit`` of them.

    Rows with a null id or label and the held-out fold are left out; of several
    labels of an id the largest counts.
    """
    rows = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(F.col(id_col)) != HELD_OUT))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
        .select("id", "toxic", (fold(F.col("id")) == CURVE_FOLD).cast("int").alias("curve"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(limit)
        .toPandas()
        .sort_values("id")
    )
    return rows["id"].to_numpy(np.int64), rows["toxic"].to_numpy(np.int64), rows["curve"].to_numpy(np.int64)


def gram_counts(docs: DataFrame, labelled, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``gram`` and its counts in all documents and in the labelled rows, by class and curve fold."""
    ids, toxic, curve = labelled
    slot = 1 + toxic + 2 * curve

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        found = [Counter() for _ in _SLOTS]

        def flush() -> pa.RecordBatch:
            words = list(found[0])
            seen, sums = np.zeros(0, dtype=np.uint64), np.zeros((len(_SLOTS), 0), dtype=np.int64)
            for begin in range(0, len(words), PART_WORDS):
                part = words[begin : begin + PART_WORDS]
                n = np.array([[c[w] for w in part] for c in found], dtype=np.int64)
                grams, of = word_grams(part)
                both = np.concatenate([seen, grams])
                seen, inverse = np.unique(both, return_inverse=True)
                counts = np.concatenate([sums, n[:, of]], axis=1)
                sums = np.array([np.bincount(inverse, weights=row, minlength=len(seen)) for row in counts]).astype(np.int64)
            for c in found:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), *map(pa.array, sums)], names=["gram", *_SLOTS])

        for batch in batches:
            doc_ids = batch.column(0)
            at = np.searchsorted(ids, doc_ids.fill_null(0).to_numpy(zero_copy_only=False))
            for k, (i, text) in enumerate(zip(at.tolist(), batch.column(1).to_pylist(), strict=True)):
                words = words_of(text)
                found[0].update(words)
                if i < len(ids) and doc_ids[k].is_valid and ids[i] == doc_ids[k].as_py():
                    found[slot[i]].update(words)
                if len(found[0]) >= CACHED_WORDS:
                    yield flush()
        if found[0]:
            yield flush()

    counted = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(count, f"gram long, {', '.join(f'{s} long' for s in _SLOTS)}")
    return counted.groupBy("gram").agg(*[F.sum(s).alias(s) for s in _SLOTS])


def _endings(grams: DataFrame) -> DataFrame:
    """``longer``: all that n-grams end with, themselves too, but for single bytes; ``gram``: that without its first byte."""
    g = F.col("gram")

    def last(k: int) -> Column:
        return g if k == 8 else g.bitwiseAND(F.lit((1 << 8 * k) - 1).cast("long"))

    each = [
        F.when(F.shiftrightunsigned(g, 8 * (k - 1)) != 0, F.struct(last(k - 1).alias("gram"), last(k).alias("longer")))
        for k in range(2, ORDER + 1)
    ]
    return grams.select(F.inline(F.array_compact(F.array(*each))))


def shared_counts(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of all that the ``wanted`` n-grams end with: ``n``, before how many bytes it is seen in the n-grams ``counted``, and
    ``total`` and ``kinds`` of its context.  A key of any of the steps has at most 256 rows."""
    n = written(_endings(counted).groupBy("gram").agg(F.count_distinct("longer").cast("int").alias("n")), "endings")
    n = n.withColumn("context", F.shiftrightunsigned("gram", 8))
    contexts = n.groupBy("context").agg(F.sum("n").cast("int").alias("total"), F.count("*").cast("int").alias("kinds"))
    mine = n.join(_endings(wanted).select("gram").distinct(), "gram", "left_semi")
    return mine.join(contexts, "context").select("gram", "n", "total", "kinds")


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    labelled_limit: int = LABELLED_ROWS,
) -> Model:
    """The model of all learned folds, with the curve of the model without the curve fold.

    Every n-gram of every document counts for the shared lower orders; they are
    counted in Spark, and only the n-grams of labelled rows, with the counts of
    what they end with, come to the driver.  Without labelled rows
    of both classes all scores are 1/2 or less than it by the curve (1, 0).
    """
    labelled = labelled_rows(labels, id_col=id_col, label_col=label_col, limit=labelled_limit)
    counted = written(gram_counts(docs, labelled, id_col=id_col, text_col=text_col), "grams")
    sparse = counted.filter(" or ".join(f"{s} > 0" for s in _SLOTS[1:]))
    table = sparse.select("gram", *[F.col(s).cast("int") for s in _SLOTS[1:]]).toArrow()
    grams = table.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams = grams[order]
    n = {s: table.column(s).to_numpy()[order] for s in _SLOTS[1:]}
    table = shared_counts(counted, sparse).toArrow()
    seen = table.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(seen)
    lower = lower_orders(grams, seen[order], *[table.column(c).to_numpy()[order] for c in ("n", "total", "kinds")])
    del table, order, seen

    def model(slots: list[list[str]]) -> Model:
        classes = []
        for names in slots:
            total = sum(n[s].astype(np.int64) for s in names)
            classes.append((grams[total > 0], total[total > 0]))
        return Model(grams, classes, lower)

    first = model([["ordinary"], ["toxic"]])
    final = model([["ordinary", "ordinary_curve"], ["toxic", "toxic_curve"]])
    del grams, n, lower
    ids, toxic, curve = labelled

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            doc_ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            at = np.minimum(np.searchsorted(ids, doc_ids), len(ids) - 1)
            mine = np.flatnonzero((ids[at] == doc_ids) & (curve[at] == 1) & np.asarray(batch.column(0).is_valid()))
            found = first.margins(batch.column(1).take(pa.array(mine)).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), pa.array(toxic[at[mine]], pa.int64())], names=["x", "y"])

    curve_docs = docs.select(F.col(id_col).cast("long"), text_col).filter(fold(F.col(id_col).cast("long")) == CURVE_FOLD)
    rows = curve_docs.mapInArrow(margins, "x double, y long").toPandas()
    final.slope, final.cut = fit_curve(rows["x"].to_numpy(np.float64), rows["y"].to_numpy(np.int64))
    return final


def score(docs: DataFrame, model: Model, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all by default) with ``score``, from 0 to 1; every whole text is read.

    Null, empty and wordless texts get the score of a difference of 0.  Rows are
    scored one by one.  An input column named ``score`` is replaced.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c != "score"]
    schema = T.StructType([*docs.select(*names).schema.fields, T.StructField("score", T.DoubleType())])
    shipped, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # n-grams of at most LABELLED_ROWS rows
    at_text = names.index(text_col) if text_col in names else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_state("toxicity", key, lambda: copy.copy(shipped.value))  # with a cache of its own
        for batch in batches:
            found = own.scores(batch.column(at_text).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(found, pa.float64())], names=schema.names)

    sent = docs.select(*names) if text_col in names else docs.select(*names, F.col(text_col).alias("_hw_text"))
    return sent.mapInArrow(run, schema)
