"""Spelling variant grouping with a bit-sliced position index.

The index of a set of words has, for each position and letter, a bitset of the
words with that letter there.  A query word is read letter by letter: the set of
words without an error so far, and the sets with one error (a replaced letter, or
a letter more), are advanced together by a few operations on whole machine words,
with the bitsets of the same and of the next position.  Many queries are advanced
at once.

The vocabulary is cut into small indexes that lose no pair: of two words with one
edit, of which the shorter has r letters, either the first r // 2 letters agree or
the last r - r // 2 do.  Words stand in a group for each, and a group above
GROUP_WORDS is cut again by the same rule on the letters that are still free,
however many words begin alike.  Groups that need no cut are packed into indexes
of about INDEX_WORDS words.  A task sends, for each word of an index, the number of
its near words and the best of them, not the pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ship_code, written

#: Words of at least so many code points, and of at least so many occurrences.
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form occurs at least so many times as often as the word.
FORM_RATIO = 5
#: A run loses a code point where its checksum is a multiple of this.
DELETES = 199
#: A group of more words is cut again; groups are packed into indexes of about so many words.
GROUP_WORDS, INDEX_WORDS = 4096, 1024
#: Different words that a task counts before it sends them, and bits of one set of many queries.
HELD, HELD_BITS = 300_000, 1 << 24

# Latin-1 bytes: A-Z lower-cased, a-z and those from 0xC0 on as they are, all others separate runs.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))


def runs_of(text: str) -> list[bytes]:
    """The runs of ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased, in Latin-1; what is beyond Latin-1 separates them."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` (occurrences in all documents) of the words long and frequent enough."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = crc32(f"{'' if doc is None else doc}:".encode())
                for w, n in Counter([w for w in runs_of(text) if len(w) >= LEAST_LENGTH]).items():
                    h = crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                    if h % DELETES == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < LEAST_LENGTH:
                            continue
                    total[w] += n
            if len(total) > HELD:
                yield flush()
                total.clear()
        if total:
            yield flush()

    sent = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    counted = sent.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def near_words(words: list[bytes], shorter: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of words with one edit between them, both ways round, within the same ``group``.

    ``words`` are in Latin-1 and of the length ``shorter`` of their group or one more;
    pairs of two longer ones are not looked for.
    """
    n = len(words)
    length = np.array([len(w) for w in words], dtype=np.int64)
    width = -(-n // 64)
    letters = np.frombuffer(b"".join(words), dtype=np.uint8)
    of = np.repeat(np.arange(n), length)
    begin = np.cumsum(length) - length
    code = (np.arange(len(letters)) - begin[of]) << 8 | letters  # position and letter

    def bitsets(row: np.ndarray, rows: int, member: np.ndarray) -> np.ndarray:
        table = np.zeros((rows, width * 8), dtype=np.uint8)
        np.bitwise_or.at(table, (row, member >> 3), (1 << (member & 7)).astype(np.uint8))
        return table.view("<u8")

    codes, row = np.unique(code, return_inverse=True)
    slices = np.concatenate([bitsets(row, len(codes), of), np.zeros((1, width), dtype="<u8")])  # the last for what is nowhere
    groups, group = np.unique(group, return_inverse=True)
    within = bitsets(group, len(groups), np.arange(n))
    longer = length > shorter
    same = bitsets(longer.astype(np.int64), 2, np.arange(n))  # of the group's shortest length, and of one more

    def at(position: int, letter: np.ndarray) -> np.ndarray:
        wanted = position << 8 | letter.astype(np.int64)
        place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        return slices[np.where(codes[place] == wanted, place, len(codes))]

    queries = np.flatnonzero(~longer)
    queries = queries[np.argsort(-length[queries], kind="stable")]  # longest first, so those still read stand in front
    found_i, found_j = [], []
    step = max(1, HELD_BITS // (width * 64))
    for first in range(0, len(queries), step):
        q = queries[first : first + step]
        none = within[group[q]]  # no error so far
        replaced = np.zeros_like(none)  # one letter differed
        more = none.copy()  # the word has had one letter more
        reading = len(q)
        ends = length[q]
        for i in range(int(ends[0])):
            while reading and ends[reading - 1] <= i:
                reading -= 1
            letter = letters[begin[q[:reading]] + i]
            here, ahead = at(i, letter), at(i + 1, letter)
            z = none[:reading]
            replaced[:reading] = replaced[:reading] & here | z & ~here
            z &= here
            more[:reading] = more[:reading] & ahead | z
        hits = replaced & same[0] | more & same[1]
        r, c = np.nonzero(hits)
        bits = np.unpackbits(hits[r, c].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, bit = np.nonzero(bits)
        i, j = q[r[k]], c[k] * 64 + bit
        back = longer[j]  # two words of one length are queries both
        found_i += [i, j[back]]
        found_j += [j, i[back]]
    if not found_i:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


# A group: the shorter length of its pairs, how many first and last letters agree, those letters, and where its pairs must
# differ (start and length), which are those that another group has.
_GROUP = ["c", "a", "b", "agreed", "differ"]


def _cut(grouped: DataFrame) -> DataFrame:
    """Each row in the two groups that the free letters of its group's shorter words give."""
    free = F.col("c") - F.col("a") - F.col("b")
    half = F.floor(free / 2).cast("int")
    n = F.length("word")
    start = F.col("a") + half
    front = F.struct(start.alias("a"), F.col("b").alias("b"), F.col("differ").alias("differ"))
    rest = F.concat("differ", F.array(F.col("a"), half))
    back = F.struct(F.col("a").alias("a"), (F.col("b") + free - half).alias("b"), rest.alias("differ"))
    both = grouped.select("word", "n", "c", F.explode(F.array(front, back)).alias("g")).select("word", "n", "c", "g.*")
    agreed = F.concat(F.expr("left(word, a)"), F.lit(" "), F.expr("right(word, b)"))
    return both.select("c", "a", "b", agreed.alias("agreed"), "differ", "word", "n").filter(n >= F.col("c"))


def _small_groups(words: DataFrame, group_words: int) -> DataFrame:
    """Rows of groups of at most ``group_words`` words, or whose words have no letters left to be cut by."""
    n = F.length("word")
    length = F.explode(F.array(n, n - 1)).alias("c")
    whole = words.select(length, F.lit(0).alias("a"), F.lit(0).alias("b"), F.expr("cast(array() as array<int>)").alias("differ"), "word", "n")
    grouped = written(_cut(whole.filter(F.col("c") >= LEAST_LENGTH)), "groups")
    done = None
    while True:
        sizes = grouped.groupBy(*_GROUP).agg(F.count("*").alias("m"))
        large = sizes.filter((F.col("m") > group_words) & (F.col("c") - F.col("a") - F.col("b") >= 2)).drop("m")
        large = written(large, "large")  # at most rows / group_words
        more = not large.isEmpty()
        small = grouped.join(large, _GROUP, "left_anti") if more else grouped
        done = small if done is None else done.unionByName(small)
        if not more:
            return done
        grouped = written(_cut(grouped.join(large, _GROUP)), "groups")


def _nearest(grouped: DataFrame, index_words: int) -> DataFrame:
    """For each word of an index that has near words there: ``n_near`` and the best, ``form_n`` and ``form``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[str] = []
        n: list[int] = []
        group: list[int] = []
        shorter: list[int] = []
        differ: list[list[int]] = []
        last = None

        def index() -> Iterator[pa.RecordBatch]:
            raw = [w.encode("latin-1") for w in words]
            i, j = near_words(raw, np.array(shorter, dtype=np.int64), np.array(group, dtype=np.int64))
            keep = [
                all(raw[x][s : s + k] != raw[y][s : s + k] for s, k in zip(d[::2], d[1::2], strict=True))
                for x, y, d in zip(i.tolist(), j.tolist(), (differ[x] for x in i.tolist()), strict=True)
            ]
            i, j = i[keep], j[keep]
            if len(i):
                place = np.empty(len(words), dtype=np.int64)
                place[np.argsort(np.array(raw, dtype=object), kind="stable")] = np.arange(len(words))  # bytes order as code points do
                count = np.array(n, dtype=np.int64)
                order = np.lexsort((place[j], -count[j], i))
                i, j = i[order], j[order]
                first = np.flatnonzero(np.diff(i, prepend=-1))
                near = np.diff(np.append(first, len(i)))
                of = lambda k: pa.array([words[x] for x in k.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [of(i[first]), pa.array(near, pa.int64()), pa.array(count[j[first]], pa.int64()), of(j[first])],
                    names=["word", "n_near", "form_n", "form"],
                )

        for batch in batches:
            for c, a, b, agreed, apart, word, count in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                key = (c, a, b, agreed, tuple(apart))
                if key != last:
                    if len(words) >= index_words:
                        yield from index()
                        words, n, group, shorter, differ = [], [], [], [], []
                    last = key
                    at = len(words)
                words.append(word)
                n.append(count)
                group.append(at)
                shorter.append(c)
                differ.append(apart)
        if words:
            yield from index()

    sent = grouped.select(*_GROUP, "word", "n").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return sent.mapInArrow(run, "word string, n_near long, form_n long, form string")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words that have a form, by doubling the steps; counts rise with each, so paths end."""
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        step = reached.join(onward, F.col("root") == F.col("_at"), "left")
        moved = written(step.select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), "roots")
        reached = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return reached


def variants(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", group_words: int = GROUP_WORDS, index_words: int = INDEX_WORDS
) -> DataFrame:
    """One row for each word: ``word``, ``form`` and ``root``, ``n``, ``n_near`` and ``form_n``.

    Words are the runs of ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased, of at least
    LEAST_LENGTH code points and LEAST_COUNT occurrences; of a run whose checksum with
    the document's id is a multiple of DELETES, one code point is left out first.  Two
    words are near if one inserted, deleted or replaced code point makes them equal.
    The form is the near word of most occurrences, of equal ones the first in
    code-point order, if it occurs FORM_RATIO times as often as the word; otherwise
    it and ``form_n`` are null.  The root follows forms to the last, and is the word
    itself if it has none.  Null and empty texts have no words; a null id counts as an
    empty one in the checksum; repeated rows count as often as they stand; texts and
    words of any length are read whole; an empty table gives no rows; only the two
    named columns are read, whatever the others are called.
    """
    words = written(word_counts(docs, id_col=id_col, text_col=text_col), "words")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    near = _nearest(_small_groups(words, group_words), index_words).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    held = F.when(-F.col("best.less") >= FORM_RATIO * F.col("n"), F.col("best"))
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), held.getField("form").alias("form"), (-held.getField("less")).alias("form_n")
    )
    judged = written(judged, "judged")
    roots = _roots(judged.filter("form is not null"))
    found = judged.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
