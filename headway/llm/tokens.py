"""Token files: Arrow files whose rows are equal-length sequences with masks.

A folder has, for each shard,

* ``tokens-NNNNN.arrow``: an Arrow file of record batches with the columns
  ``tokens`` (fixed-size list of uint16, or uint32 for large vocabularies) and
  ``mask`` (fixed-size list of booleans, false for the padding of the last
  sequence), uncompressed, so that any sequence is a view of the mapped file;
* ``index-NNNNN.arrow``: the documents in it, ``doc_id``, ``start`` and
  ``n_tokens``, counted from the shard's first token.

Shards hold consecutive ranges of ``doc_id`` in ascending order; the manifest
(a Parquet table, one row for each shard) gives each shard's first token.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from headway.llm.bpe import encoder
from headway.llm.common import AtomicFile, local_or_remote, make_folder

#: Ids in one record batch, about; a multiple of the sequence length is written.
BATCH_IDS = 1 << 20

_MANIFEST = "shard int, tokens_path string, index_path string, n_docs long, n_tokens long, n_sequences long"


def _sequence_batch(ids: np.ndarray, seq_len: int, schema: pa.Schema) -> pa.RecordBatch:
    n = -(-len(ids) // seq_len)
    flat = np.zeros(n * seq_len, dtype=ids.dtype)
    flat[: len(ids)] = ids
    mask = np.arange(n * seq_len) < len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.FixedSizeListArray.from_arrays(pa.array(flat), seq_len), pa.FixedSizeListArray.from_arrays(pa.array(mask), seq_len)],
        schema=schema,
    )


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seq_len: int = 1024,
    end_id: int = 0,
) -> DataFrame:
    """Encode ``docs`` in ascending order of ``id_col`` and write them; returns the manifest, read from ``folder``.

    A null text is empty (the end id alone).  Null ids come first; rows that
    repeat an id are ordered by their text's hash.  An empty table gives an
    empty manifest.  Other columns are ignored.
    """
    spark = docs.sparkSession
    make_folder(folder)
    id_type = docs.schema[id_col].dataType
    if not isinstance(id_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"{id_col} must be an integer")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from contextlib import ExitStack

        shard = TaskContext.get().partitionId()
        names = f"{folder}/tokens-{shard:05d}.arrow", f"{folder}/index-{shard:05d}.arrow"
        encode = encoder(tokenizer_path)
        kind = np.uint16 if len(encode.opens) <= 1 << 16 else np.uint32
        item = pa.from_numpy_dtype(kind)
        schema = pa.schema([("tokens", pa.list_(item, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        end = np.array([end_id], dtype=kind)
        n_docs = n_tokens = n_sequences = 0
        waiting, n_waiting = [], 0
        step = max(1, BATCH_IDS // seq_len) * seq_len
        with ExitStack() as stack:
            tokens = listed = None

            def put(ids: np.ndarray) -> int:
                tokens.write_batch(_sequence_batch(ids, seq_len, schema))
                return -(-len(ids) // seq_len)

            for batch in batches:
                if not batch.num_rows:
                    continue
                if tokens is None:
                    tokens = stack.enter_context(pa.ipc.new_file(stack.enter_context(AtomicFile(names[0])), schema))
                    listed = stack.enter_context(pa.ipc.new_file(stack.enter_context(AtomicFile(names[1])), index))
                lengths = []
                for raw in encode.encode(["" if t is None else t for t in batch.column(1).to_pylist()]):
                    waiting += [np.frombuffer(raw, "<u4").astype(kind), end]
                    lengths.append(len(raw) // 4 + 1)
                    n_waiting += lengths[-1]
                    if n_waiting >= step:
                        ids = np.concatenate(waiting)
                        full = len(ids) // step * step
                        for at in range(0, full, step):
                            n_sequences += put(ids[at : at + step])
                        waiting, n_waiting = [ids[full:].copy()], len(ids) - full
                ends = np.cumsum(lengths) + n_tokens
                listed.write_batch(
                    pa.RecordBatch.from_arrays(
                        [batch.column(0).cast(pa.int64()), pa.array(ends - lengths), pa.array(lengths, pa.int64())], schema=index
                    )
                )
                n_docs, n_tokens = n_docs + batch.num_rows, int(ends[-1])
            if tokens is not None and n_waiting:
                n_sequences += put(np.concatenate(waiting))
        if n_docs:
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "tokens_path": [names[0]],
                    "index_path": [names[1]],
                    "n_docs": [n_docs],
                    "n_tokens": [n_tokens],
                    "n_sequences": [n_sequences],
                }
            )

    tie = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    ordered = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), tie.alias("_tie"))
        .repartitionByRange("_id", "_tie")
        .sortWithinPartitions("_id", "_tie")
        .select("_id", "_text")
    )
    ordered.mapInArrow(write, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each shard, with ``base``: the ids in the shards before it."""
    shards = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    total = F.sum("n_tokens").over(Window.orderBy("shard"))  # a row for each file, not for each document
    return shards.withColumn("base", total - F.col("n_tokens"))


class TokenFile:
    """Random access to one shard; sequences and masks are views of the mapped file.

    Masks are packed, an eighth of a byte for each id, as Arrow boolean arrays, which can begin at any bit.
    """

    def __init__(self, tokens_path: str, index_path: str | None = None):
        fs, path = local_or_remote(tokens_path)
        self.source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.index_path = index_path
        self.at = -1
        self.seq_len = self.file.schema.field(0).type.list_size
        # all batches but the last have the same number of sequences
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0

    def _values(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if k != self.at:
            batch = self.file.get_batch(k)
            self.at = k
            self.ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
            self.mask = batch.column(1).flatten()
        return self.ids, self.mask

    def views(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``, without a copy of either (on a local file system)."""
        ids, mask = self._values(i // self.rows)
        at = i % self.rows * self.seq_len
        return ids[at : at + self.seq_len], mask.slice(at, self.seq_len)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """``views`` with the mask as a numpy array, which is a copy of its bits."""
        ids, mask = self.views(i)
        return ids, mask.to_numpy(zero_copy_only=False)

    def slices(self, starts: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of runs in ascending order."""
        step = self.rows * self.seq_len
        for start, n in zip(starts.tolist(), lengths.tolist(), strict=True):
            parts = []
            while n:
                k, at = divmod(start, step)
                part = self._values(k)[0][at : at + n]
                parts.append(part)
                start, n = start + len(part), n - len(part)
            yield parts[0] if len(parts) == 1 else np.concatenate(parts)

    def documents(self) -> Iterator[pa.RecordBatch]:
        fs, path = local_or_remote(self.index_path)
        with fs.open_input_file(path) as source:
            index = pa.ipc.open_file(source)
            for k in range(index.num_record_batches):
                yield index.get_batch(k)


def read_documents(spark: SparkSession, folder: str, *, digests: bool = False) -> DataFrame:
    """The documents in a folder of token files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids``, or ``ids_crc32`` with ``digests``."""
    manifest = read_manifest(spark, folder)
    last = "ids_crc32 long" if digests else "ids array<int>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = TokenFile(row["tokens_path"], row["index_path"])
                for docs in shard.documents():
                    starts, lengths = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                    ids = (x.astype("<u4") for x in shard.slices(starts, lengths))
                    found = pa.array([zlib.crc32(x) for x in ids], pa.int64()) if digests else pa.array([x.astype("i4") for x in ids], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [docs.column(0), pa.array(starts + row["base"]), docs.column(2), found],
                        names=["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"],
                    )

    shards = max(1, manifest.count())  # a task for each shard
    spread = manifest.select("shard", "tokens_path", "index_path", "base").repartitionByRange(shards, "shard")
    return spread.mapInArrow(read, f"doc_id long, start long, n_tokens long, {last}")
