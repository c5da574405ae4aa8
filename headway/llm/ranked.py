"""Ranked lexical search by pipelined term partitioning.

The terms of the stated query items are dealt out to a few owners, from the rarest
to the commonest, each with about as many postings.  An owner's postings stand in
blocks of documents.  A bundle is all items' sparse accumulators of one block: it
passes through the owners one after the other, and each stage is a cogroup of the
bundles and that owner's postings by block, which adds the owner's integer
contributions.  The rarest terms come first, so the bundles that travel are small;
the last owner, of the commonest terms, which touch most documents, selects each
item's best of the block in the same task, and no accumulators leave it.  The final
selection ranks the best of all blocks.

Documents are dealt to blocks evenly, whatever their ids, sources or texts, and a
block has so many that items times documents are at most ACCUMULATORS, so no term
or item makes a group larger.  Items are searched in blocks, each by one pass over
the documents: their different terms are about VOCABULARY at most, or those of one
longer item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import NOT_ALPHANUMERIC, scratch_path, ship_code, text_bytes, word_table
from headway.sources.paths import remove_folder

#: Term owners, the stages of the pipeline.
OWNERS = 3
#: Accumulators of a block (items times documents), 8 bytes each while a task works on them, and its documents.
ACCUMULATORS, BLOCK_DOCS = 1 << 20, 2048
#: Terms of the items of one pass over the documents, repeats in different items included.
VOCABULARY = 500_000

_TABLE = word_table(NOT_ALPHANUMERIC, lower=True)


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats: runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return raw.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    """floor(1000 * ln((2 N + 2) / (2 df + 1)))"""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _packed(values, kind: str) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _counted(docs: DataFrame, number) -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats), and ``terms`` and ``tfs`` (packed) of the terms in ``number``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.value.get
        for batch in batches:
            ids, n, terms, tfs = [], [], [], []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms_of(raw)
                if words:
                    known = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                    term, tf = np.unique(known[known >= 0], return_counts=True)
                    ids.append(doc)
                    n.append(len(words))
                    terms.append(_packed(term, "<i4"))
                    tfs.append(_packed(tf, "<i4"))
            columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms binary, tfs binary")


def _document_frequencies(counted: DataFrame, size: int) -> DataFrame:
    """``term`` and ``df``; a task sums its own documents first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total[np.frombuffer(raw, dtype="<i4")] += 1  # a document's terms are different
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["term", "df"])

    return counted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


_INDEX = "block long, owner int, n_docs int, term binary, start binary, doc binary, part binary, ids binary, none binary"


def _index(counted: DataFrame, owner_of, owners: int, n_docs: int, n_terms: int, blocks: int) -> DataFrame:
    """Each owner's postings of each block: its terms in order, where their runs begin, and for each posting the document's
    place in the block and the integer that a weight is multiplied by.  The last owner's also have the documents' ids."""

    def build(key, rows):
        n = rows.column("n").to_numpy()
        terms = [np.frombuffer(x, dtype="<i4") for x in rows.column("terms").to_pylist()]
        doc = np.repeat(np.arange(len(n), dtype=np.int32), [len(t) for t in terms])
        term = np.concatenate(terms)
        tf = np.concatenate([np.frombuffer(x, dtype="<i4") for x in rows.column("tfs").to_pylist()]).astype(np.int64)
        m = 10 + (90 * n * n_docs) // n_terms
        part = ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])).astype("<i4")
        order = np.argsort(term, kind="stable")
        term, doc, part = term[order], doc[order], part[order]
        owner = owner_of.value[term]
        found = []
        for s in range(owners):
            mine = owner == s
            first = np.flatnonzero(np.diff(term[mine], prepend=-1))
            row = {"block": key[0].as_py(), "owner": s, "n_docs": len(n), "ids": None, "none": None}
            row |= {"term": _packed(term[mine][first], "<i4"), "start": _packed(first, "<i4")}
            row |= {"doc": _packed(doc[mine], "<i4"), "part": _packed(part[mine], "<i4")}
            if s == owners - 1:
                ids = rows.column("doc_id").combine_chunks()
                row |= {"ids": _packed(ids.fill_null(0).to_numpy(zero_copy_only=False), "<i8")}
                row |= {"none": _packed(ids.is_null().to_numpy(zero_copy_only=False), "u1")}
            found.append(row)
        return pa.Table.from_pylist(found, schema=schema)

    schema = pa.schema(
        [("block", pa.int64()), ("owner", pa.int32()), ("n_docs", pa.int32())]
        + [(c, pa.binary()) for c in ("term", "start", "doc", "part", "ids", "none")]
    )
    block = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(blocks)).alias("block")
    placed = counted.filter(F.length("terms") > 0).select(block, "doc_id", "n", "terms", "tfs")
    return placed.groupBy("block").applyInArrow(build, _INDEX)


_BUNDLE = "block long, places binary, scores binary"


def _stage(bundles: DataFrame, postings: DataFrame, asked, owner: int, best: int | None, id_type: str) -> DataFrame:
    """One owner's stage.  ``asked`` holds for each owner the items' (number, terms and weights); ``best`` makes it the last."""

    def run(key, left, right):
        ids, wanted = asked.value
        if not right.num_rows:  # all owners have a row for a block
            return left if best is None else pa.Table.from_pylist([], schema=last)
        row = right.to_pylist()[0]
        n = row["n_docs"]
        sums = np.zeros((len(ids), n), dtype=np.int64)
        flat = sums.reshape(-1)
        for places, scores in zip(left.column("places").to_pylist(), left.column("scores").to_pylist(), strict=True):
            flat[np.frombuffer(places, dtype="<i4")] = np.frombuffer(scores, dtype="<i8")
        term, start, doc, part = (np.frombuffer(row[c], dtype="<i4") for c in ("term", "start", "doc", "part"))
        ends = np.append(start, len(doc))[1:]
        runs = {t: (a, b) for t, a, b in zip(term.tolist(), start.tolist(), ends.tolist(), strict=True)}
        part = part.astype(np.int64)
        for item, terms in wanted[owner]:
            mine = sums[item]
            for t, w in terms:
                if run := runs.get(t):
                    a, b = run
                    mine[doc[a:b]] += w * part[a:b]  # a run's documents are different
        if best is None:
            places = np.flatnonzero(flat)
            if not len(places):
                return pa.Table.from_pylist([], schema=travels)
            return pa.Table.from_pylist(
                [{"block": key[0].as_py(), "places": _packed(places, "<i4"), "scores": _packed(flat[places], "<i8")}], schema=travels
            )
        doc_ids, none = np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["none"], dtype="u1")
        found = []
        for item in np.flatnonzero(sums.any(axis=1)).tolist():
            mine = sums[item]
            least = max(1, int(np.partition(mine, n - best)[n - best]) if n > best else 1)
            at = np.flatnonzero(mine >= least)  # ties with the last place included, until ids decide
            at = at[np.lexsort((doc_ids[at], none[at], -mine[at]))][:best]
            found += [(item, ids[item], None if none[d] else int(doc_ids[d]), int(mine[d])) for d in at.tolist()]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, last, strict=True)], schema=last)

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    travels = pa.schema([("block", pa.int64()), ("places", pa.binary()), ("scores", pa.binary())])
    item_type = to_arrow_type(_parse_datatype_string(id_type))
    last = pa.schema([("item", pa.int32()), ("item_id", item_type), ("doc_id", pa.int64()), ("score", pa.int64())])
    gives = _BUNDLE if best is None else f"item int, item_id {id_type}, doc_id long, score long"
    return bundles.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(run, gives)


def _item_terms(items: DataFrame) -> DataFrame:
    """``key`` (of the row), ``item_id`` and each of its different terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(raw))) for raw in batch.column(2).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(terms)), [len(t) for t in terms]))
            flat = pa.array([t for found in terms for t in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), flat], names=["key", "item_id", "term"])

    return items.mapInArrow(run, f"key long, item_id {items.schema['item_id'].dataType.simpleString()}, term binary")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    owners: int = OWNERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    vocabulary: int = VOCABULARY,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's ``k`` highest-scoring documents.

    A document's score for an item sums, over the item's different terms, w *
    ((10**9 * tf) div (1000 * tf + 8 * m)), with w of ``weight`` and m = 10 + ((90 *
    n * N) div L).  Only scores above 0 are returned; equal scores stand by ascending
    id, no id last.  A null or empty text has no terms: such a document is not
    counted in N, such an item has no rows.  Rows that repeat an id or a text are
    documents, and items, of their own.  Texts of any length are read whole.  Empty
    tables give no rows; only the four named columns are read, whatever the others
    are called.
    """
    spark = docs.sparkSession
    ship_code(spark)
    sc = spark.sparkContext
    items = items.select(F.monotonically_increasing_id().alias("key"), F.col(item_col).alias("item_id"), text_bytes(item_text_col).alias("raw"))
    id_type = items.schema["item_id"].dataType.simpleString()
    path = scratch_path(spark, "items")
    _item_terms(items).write.parquet(path)
    terms = spark.read.parquet(path)
    passes = max(1, -(-terms.count() // vocabulary))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw"))
    found = None
    for p in range(passes):
        rows = terms.filter(F.pmod(F.xxhash64("key"), F.lit(passes)) == p).collect()  # about ``vocabulary`` rows
        if rows:
            part = _search_block(spark, sc, docs, rows, k, owners, block_docs, id_type)
            found = part if found is None else found.unionByName(part)
    remove_folder(spark, path)
    if found is None:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    return found


def _search_block(spark, sc, docs, rows, k, owners, block_docs, id_type) -> DataFrame:
    number = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    keys = sorted({r["key"] for r in rows})
    place = {key: i for i, key in enumerate(keys)}
    ids: list = [None] * len(keys)
    of_item: list[list[int]] = [[] for _ in keys]
    for r in rows:
        ids[place[r["key"]]] = r["item_id"]
        of_item[place[r["key"]]].append(number[bytes(r["term"])])
    path = scratch_path(spark, "counted")
    _counted(docs, sc.broadcast(number)).write.parquet(path)
    counted = spark.read.schema("doc_id long, n long, terms binary, tfs binary").parquet(path)
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(number), dtype=np.int64)
    for term, count in _document_frequencies(counted, len(number)).collect():  # a row for each of the items' terms
        df[term] = count
    # From the rarest terms to the commonest, as many postings each.
    order = np.argsort(df, kind="stable")
    owner_of = np.zeros(len(df), dtype=np.int32)
    before = np.cumsum(df[order]) - df[order]
    owner_of[order] = np.minimum(before * owners // max(1, int(df.sum())), owners - 1)
    w = [weight(n_docs, int(x)) if x else 0 for x in df]
    wanted = [
        [(i, own) for i, terms in enumerate(of_item) if (own := [(t, w[t]) for t in terms if owner_of[t] == s and w[t]])] for s in range(owners)
    ]
    size = max(64, min(block_docs, ACCUMULATORS // len(ids)))
    index_path = scratch_path(spark, "postings")
    index = _index(counted, sc.broadcast(owner_of), owners, n_docs, max(1, n_terms), max(1, -(-n_docs // size)))
    index.write.partitionBy("owner").parquet(index_path)
    remove_folder(spark, path)
    index = spark.read.schema(_INDEX).parquet(index_path)
    asked = sc.broadcast((ids, wanted))
    bundles = spark.createDataFrame([], _BUNDLE)
    for s in range(owners):
        postings = index.filter(F.col("owner") == s).drop("owner")
        bundles = _stage(bundles, postings, asked, s, k if s == owners - 1 else None, id_type)
    highest = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = bundles.withColumn("rank", F.row_number().over(highest)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
