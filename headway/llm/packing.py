"""Best-two-fit packing of token sequences into fixed-size bins.

The plan is made from the histogram of lengths, which has at most ``capacity``
rows however many documents there are.  A bin is filled greedily with the
longest lengths that fit; then its smallest document is replaced by the two
unpacked lengths that fill the expanded gap best, if they fill it better.  The
same bin pattern is applied as often as all its lengths last, so there are at
most a few thousand patterns.  Each piece then finds its place from its rank
among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.bpe import encoder
from headway.llm.common import release_worker, written

#: Groups that the pieces of one length are ranked in, and the pieces above which there are more of them.
SALTS = 64
PIECES_A_SALT = 500_000


def cut_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    capacity: int = 1024,
    digests: bool = False,
) -> DataFrame:
    """Token pieces of at most ``capacity`` ids; a document is its ids and ``end_id``.

    Longer documents are cut into pieces of ``capacity`` ids, of which the first
    may be shorter.  A null or empty text is the end id alone.  Rows with a null
    or repeated id are packed like any other.  Returns the id, ``piece``,
    ``start`` (ids of the document before the piece), ``length`` and ``ids``
    (array) or, with ``digests``, ``ids_crc32`` of the little-endian uint32 ids,
    which keeps the ids in the Python worker.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    last = ("ids_crc32", T.LongType()) if digests else ("ids", T.ArrayType(T.IntegerType()))
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField(*last),
        ]
    )
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            of, piece, start, length, out = [], [], [], [], []
            for row, ids in enumerate(encode(["" if t is None else t for t in batch.column(1).to_pylist()])):
                ids += end
                n = len(ids) // 4
                at, k = 0, 0
                size = n % capacity or capacity
                while at < n:
                    part = ids[4 * at : 4 * (at + size)]
                    of.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    out.append(zlib.crc32(part) if digests else np.frombuffer(part, "<u4").astype("i4"))
                    at, k, size = at + size, k + 1, capacity
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(out, pa.int64() if digests else pa.list_(pa.int32())),
                ],
                names=schema.names,
            )

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def plan_bins(counts: dict[int, int], capacity: int, two_fit: bool = True) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(bins, [(length, how many in each bin)])] that use up ``counts`` (length -> number of documents)."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a length of {length} does not fit {capacity}")
        left[length] += n
    index = np.arange(capacity + 1)
    plan = []
    while left.any():
        rest = left.copy()
        chosen: list[list[int]] = []
        gap = capacity
        while gap:
            there = np.flatnonzero(rest[: gap + 1])
            if not len(there):
                break
            length = int(there[-1])
            n = min(gap // length, int(rest[length]))
            chosen.append([length, n])
            rest[length] -= n
            gap -= n * length
        if two_fit and gap and sum(n for _, n in chosen) > 1:
            smallest = chosen[-1][0]
            wide = gap + smallest
            fits = np.maximum.accumulate(np.where(rest > 0, index, 0))  # the longest length left, up to each
            first = np.flatnonzero(rest[: wide + 1])
            second = np.minimum(fits[wide - first], first)
            alone = (second == first) & (rest[first] < 2)
            second[alone] = fits[np.maximum(first[alone] - 1, 0)]
            both = np.where(second > 0, first + second, 0)
            if len(both) and both.max() > smallest:
                k = int(both.argmax())
                chosen[-1][1] -= 1
                chosen += [[int(first[k]), 1], [int(second[k]), 1]]
        uses: dict[int, int] = {}
        for length, n in chosen:
            if n:
                uses[length] = uses.get(length, 0) + n
        bins = min(int(left[length]) // n for length, n in uses.items())
        for length, n in uses.items():
            left[length] -= bins * n
        plan.append((bins, sorted(uses.items(), reverse=True)))
    return plan


def _places(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For each run of ranks of a length: where it begins, its first bin, how many go into a bin, and their offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for bins, uses in plan:
        offset = 0
        for length, n in uses:
            rank = used.get(length, 0)
            rows.append((length, rank, base, n, offset))
            used[length] = rank + bins * n
            offset += n * length
        base += bins
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "bin", "each", "offset"), table.T, strict=True))


def pack(pieces: DataFrame, capacity: int = 1024, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every row has its place, sequences are gapless from 0.

    ``pieces`` is read twice, so it should be a stored table.  Lengths outside
    1..capacity (or null) raise ValueError.  Ties and repeated rows are ordered
    by all columns.  An empty table stays empty.  Input columns named like the
    two results are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    counts = {r[0]: r[1] for r in pieces.groupBy(length_col).count().limit(capacity + 2).collect()}  # a row for each length
    if None in counts:
        raise ValueError("a length is null")
    where = _places(plan_bins(counts, capacity))
    salts = max(SALTS, -(-max(counts.values(), default=0) // PIECES_A_SALT))
    plain = [F.col(c) for c, kind in pieces.dtypes if not kind.startswith(("array", "map", "struct"))]
    order = [c.asc_nulls_first() for c in plain]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int"))
    before = (
        salted.groupBy(length_col, "_salt")
        .count()
        .withColumn("_before", F.sum("count").over(Window.partitionBy(length_col).orderBy("_salt")) - F.col("count"))
        .drop("count")
    )
    ranked = (
        salted.withColumn("_rank", F.row_number().over(Window.partitionBy(length_col, "_salt").orderBy(*order)))
        .join(before, [length_col, "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_rank") - 1)
        .select(*pieces.columns, "_rank")
    )
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    shift = 1 << 44
    starts = where["length"] * shift + where["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            length = batch.column(batch.schema.get_field_index(length_col)).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            k = np.searchsorted(starts, length * shift + rank, side="right") - 1
            into, slot = np.divmod(rank - where["rank"][k], where["each"][k])
            added = [pa.array(where["bin"][k] + into), pa.array(where["offset"][k] + slot * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=schema.names)

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 1024, digests: bool = False, **named) -> DataFrame:
    """Cut ``docs`` into pieces, keep them in the shared folder, and give each its place."""
    pieces = cut_pieces(docs, tokenizer_path, capacity=capacity, digests=digests, **named)
    return pack(written(pieces, "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``input_ids`` and ``document`` (1, 2, ... by place) of each id.

    A sequence has at most ``capacity`` ids, so its group is small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.flatten(F.col("parts.ids")).alias("input_ids"),
            F.flatten(F.transform("parts", lambda p, i: F.array_repeat(i + 1, F.size(p["ids"])))).alias("document"),
        )
    )
