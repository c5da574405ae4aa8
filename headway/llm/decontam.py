"""Benchmark decontamination by a prefix-filtered join of word windows.

Every benchmark item is cut into windows of ``window`` consecutive words (an
item of fewer words is one window).  A document contains a window exactly if it
has all its words in a row, which is containment 1: of the window's words,
ordered from the rarest in the corpus, the first alone is a sufficient prefix.
Documents are joined with the windows on that word; its place in the window and
in the document give the only place where the window can stand (the positional
bound), places that leave the document are out (the length bound), and the words
there are looked up among the windows.

Windows are stored in blocks of a bounded size, each with the document counts of
its own words, which Spark joins to it: a worker holds one block, whatever the
size of the benchmark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import NOT_ALPHANUMERIC, local_or_remote, release_worker, scratch_path, text_bytes, word_table, worker_state

_WORDS = word_table(NOT_ALPHANUMERIC, lower=True)

#: Windows (each with an item) in one block; a worker holds one block at a time.
BLOCK_WINDOWS = 400_000

#: Distinct words that a task counts before it hands on what it has.
COUNTED_WORDS = 500_000

#: Bytes of rows for which a worker goes through all blocks, where there are several.
HELD_BYTES = 64 << 20


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and all characters beyond ASCII."""
    return raw.translate(_WORDS).split()


def item_windows(benchmark: DataFrame, window: int, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``words`` (space-joined) and ``item_id`` of each distinct window; items without words have none."""
    id_type = benchmark.schema[id_col].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            out, of = [], []
            for row, raw in enumerate(batch.column(1).to_pylist()):
                words = words_of(raw)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    out.append(b" ".join(words[i : i + window]))
                    of.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()), batch.column(0).take(pa.array(of, pa.int64()))], names=["words", "item_id"]
            )

    schema = T.StructType([T.StructField("words", T.BinaryType()), T.StructField("item_id", id_type)])
    return benchmark.select(F.col(id_col), text_bytes(text_col).alias("_raw")).mapInArrow(cut, schema).distinct()


def write_blocks(windows: DataFrame, folder: str, block_windows: int = BLOCK_WINDOWS) -> list[str]:
    """Store the (window, item) rows in blocks of about ``block_windows``; returns the blocks' folders.

    A window that very many items share stands in several blocks, with some of
    its items in each: marks and items of all blocks are united.
    """
    n = windows.count()
    blocks = max(1, -(-n // block_windows))
    kept = windows.withColumn("block", F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)).cast("int"))
    kept.repartition(blocks, "block").write.partitionBy("block").parquet(folder)
    return [f"{folder}/block={k}" for k in range(blocks)]


def _rows(folder: str, columns: list[str]) -> Iterator[tuple]:
    """The rows of a block's files; none where no row fell into the block."""
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs

    fs, path = local_or_remote(folder)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return
    for file in fs.get_file_info(pafs.FileSelector(path)):
        if file.path.endswith(".parquet"):
            table = pq.read_table(file.path, filesystem=fs, columns=columns, partitioning=None)
            yield from zip(*(table.column(c).to_pylist() for c in columns), strict=True)


class _Block:
    """The windows of one block, by their words and by their rarest word."""

    def __init__(self, folder: str):
        self.items: dict[bytes, list] = {}
        for words, item in _rows(folder, ["words", "item_id"]):
            self.items.setdefault(words, []).append(item)

    def order(self, rarity: dict[bytes, int]) -> None:
        """word -> {(its place in a window, the window's length)} of the windows whose rarest word it is.

        A window with a word that no document has is in no document.
        """
        self.by_word: dict[bytes, set[tuple[int, int]]] = {}
        for joined in self.items:
            words = joined.split(b" ")
            at = min(range(len(words)), key=lambda i: (rarity.get(words[i], 0), words[i]))
            if rarity.get(words[at], 0):
                self.by_word.setdefault(words[at], set()).add((at, len(words)))
        self.prefix = frozenset(self.by_word)


def block_words(windows: DataFrame) -> DataFrame:
    """The distinct (``block``, ``word``) of stored windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            pairs = {(b, w) for b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for w in x.split(b" ")}
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in pairs], pa.int32()), pa.array([w for _, w in pairs], pa.binary())], names=["block", "word"]
            )

    return windows.select("block", "words").mapInArrow(cut, "block int, word binary").distinct()


def word_rarity(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` and ``n``, parts of the number of documents with the word (to be summed); all documents are counted."""

    def parts(found: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        found: Counter[bytes] = Counter()
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                found.update(set(words_of(raw)))
                if len(found) > COUNTED_WORDS:  # so much is held, the rest is summed in Spark
                    yield parts(found)
                    found = Counter()
        yield parts(found)

    return docs.select(text_bytes(text_col).alias("_raw")).mapInArrow(count, "word binary, n long")


def write_rarity(docs: DataFrame, windows_folder: str, folder: str, blocks: int, text_col: str = "text") -> None:
    """Store, for each block, its words and in how many documents each of them is."""
    spark = docs.sparkSession
    block_words(spark.read.schema("words binary, block int").parquet(windows_folder)).write.parquet(f"{folder}-words")
    words = spark.read.schema("block int, word binary").parquet(f"{folder}-words")
    counted = word_rarity(docs, text_col).join(words.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.sum("n").alias("n"))
    words.join(counted, "word").select("word", "n", "block").repartition(blocks, "block").write.partitionBy("block").parquet(folder)


def find_windows(words: list[bytes], block: _Block, hit: np.ndarray, items: set) -> None:
    """Mark in ``hit`` the words of ``words`` inside an occurrence of a window of ``block``.

    At each prefix word there are as many places to look at as there are places
    and lengths of windows with this rarest word, however many windows that is.
    """
    here = block.prefix.intersection(words)
    if not here:
        return
    total = len(words)
    for i, word in enumerate(words):
        if word in here:
            for at, n in block.by_word[word]:
                begin = i - at
                if begin >= 0 and begin + n <= total:
                    found = block.items.get(b" ".join(words[begin : begin + n]))
                    if found is not None:
                        hit[begin : begin + n] = True
                        items.update(found)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_windows: int = BLOCK_WINDOWS,
    carry: list[str] | None = None,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all of them by default) with ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``item_ids`` (sorted strings of
    the items with occurring windows) and ``contaminated``.

    Null or empty texts have no words; items without words have no windows.  An
    item with a null id marks words but is not listed.  Repeated rows and items
    count once each as rows and as ids.  Input columns named like the results
    are replaced.  Rows keep their place: no document is shuffled.
    """
    spark = docs.sparkSession
    at = scratch_path(spark, "decontam")
    blocks = write_blocks(item_windows(benchmark, window, id_col=item_id_col, text_col=item_text_col), f"{at}/windows", block_windows)
    write_rarity(docs, f"{at}/windows", f"{at}/rarity", len(blocks), text_col)
    added = T.StructType(
        [
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("item_ids", T.ArrayType(T.StringType())),
            T.StructField("contaminated", T.BooleanType()),
        ]
    )
    names = [c for c in (docs.columns if carry is None else carry) if c not in added.names]
    kept = docs.select(*names)
    schema = T.StructType([*kept.schema.fields, *added.fields])

    def load(k: int) -> _Block:
        block = _Block(blocks[k])
        block.order(dict(_rows(f"{at}/rarity/block={k}", ["word", "n"])))
        return block

    def marked(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raws = [raw for batch in held for raw in batch.column(at_text).cast(pa.binary())]
        n_words = [0] * len(raws)
        hits: list[np.ndarray | None] = [None] * len(raws)
        items: list[set] = [set() for _ in raws]
        for k in range(len(blocks)):
            block = worker_state("decontam", blocks[k], lambda k=k: load(k))
            for row, raw in enumerate(raws):
                words = words_of(raw.as_py()) if raw.is_valid else []
                if hits[row] is None:
                    n_words[row], hits[row] = len(words), np.zeros(len(words), dtype=bool)
                find_windows(words, block, hits[row], items[row])
        n_hit = [int(h.sum()) for h in hits]
        columns = [
            pa.array(n_words, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array([sorted(str(i) for i in x if i is not None) for x in items], pa.list_(pa.string())),
            pa.array([n > 0 for n in n_hit], pa.bool_()),
        ]
        begin = 0
        for batch in held:
            added_here = [c.slice(begin, batch.num_rows) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *added_here], names=schema.names)
            begin += batch.num_rows

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # with several blocks, texts are gathered so that a block is not loaded for a few of them
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if len(blocks) == 1 or size >= HELD_BYTES:
                yield from marked(held)
                held, size = [], 0
        if held:
            yield from marked(held)

    # a carried text is sent to the tasks once
    at_text = names.index(text_col) if text_col in names else len(names)
    sent = kept if text_col in names else docs.select(*names, F.col(text_col).alias("_hw_text"))
    return sent.mapInArrow(mark, schema)


def items_digest(item_ids: Column) -> Column:
    """Lower-case hex SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(item_ids, ","), 256)

