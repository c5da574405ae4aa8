"""N-gram Jaccard join with PartEnum signatures.

Sets of word shingles whose Jaccard similarity is at least a threshold differ in
a bounded number of elements, and their sizes are within a factor of it.  Sizes
are cut into bands; the feature domain is partitioned by a hash for each band.
Partitions stand in groups of three, of which the subsets of two are enumerated:
a group can have one difference and still give a common subset, so of the groups
in a fixed order a set emits the first so many that the differences cannot touch
each twice.  Two similar sets share at least one signature, the whole content of
two partitions, some five shingles.  A set with too few full groups also emits
its first elements in the order of their hashes.

Equal sets are one node from the start.  Within the sets of one signature, each
is compared with the first only; what these comparisons and the links through
other signatures leave in different components is compared pair by pair, behind
a bound on the difference that 256 counters of each set give; a pair is named in
one of its common signatures, not in each.  All comparisons are of the exact sets,
recomputed from the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import SPACES, release_worker, text_bytes, word_table, written
from headway.llm.components import components

SHINGLE = 5
#: Similarity of at least SHARE / OF.
SHARE, OF = 80, 100
#: Sizes of a band are within this factor.
BAND = 1.5
#: Partitions of a band, over what its largest sets need.
SPARE = 1.1
#: Counters of a set, and of them summed into one for a first look.
COUNTERS, SUMMED = 256, 8
#: Signatures of a bucket that they are dealt out by, at most about, signatures for each element, and signatures that a
#: task holds before it sends them.
BUCKET, FOR_EACH = 500_000, 0.75
HELD = 400_000
#: Smaller signatures of a node that are sent with each, to see in which a pair was named before.
EARLIER = 16
#: Members of a signature compared in one block with another.
BLOCK = 2048
#: A side of at most so many ids may be broadcast to the tasks that read texts.
BROADCAST_IDS = 2_000_000

_TABLE = word_table(SPACES, lower=True)
_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_PIECE = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = _mix(np.arange(1, 257, dtype=_U) * _P)
_PLACES = _mix(np.arange(1, 17, dtype=_U) * _U(0xD1B54A32D192ED03)) | _U(1)
_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least ``n``."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _PIECE + 4096)
        _powers[:] = []
        for base in (_P, _U(pow(int(_P), -1, 1 << 64))):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of translated bytes, and where they start."""
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = np.concatenate([[False], data != 0x20, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    power, inverse = _tables(len(data))
    total = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(_BYTES[data] * power[: len(data)], dtype=_U)])
    return (total[end] - total[start]) * inverse[start], start


def _pieces(raws: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes]]:
    """(rows, their lengths, joined bytes) of about _PIECE bytes; a longer text comes in pieces that end between words."""
    rows, held, size = [], [], 0

    def joined():
        return rows, [len(x) for x in held], b" ".join(held)

    for row, raw in enumerate(raws):
        raw = raw.translate(_TABLE)
        while len(raw) > _PIECE:
            if rows:
                yield joined()
                rows, held, size = [], [], 0
            at = raw.rfind(b" ", 0, _PIECE)
            if at <= 0:
                at = raw.find(b" ", _PIECE)
            if at < 0:
                break
            yield [row], [at], raw[:at]
            raw = raw[at:]
        rows.append(row)
        held.append(raw)
        size += len(raw) + 1
        if size > _PIECE:
            yield joined()
            rows, held, size = [], [], 0
    if rows:
        yield joined()


def shingle_sets(raws: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct shingles; one for a text of fewer words, none for no words.

    Sets of hashes stand for sets of shingles: two different shingles of one pair
    of texts have the same hash with a probability of about 2**-64 for each pair.
    """
    words: list[list[np.ndarray]] = [[] for _ in raws]
    for rows, lengths, raw in _pieces(raws):
        hashes, start = _word_hashes(raw)
        hashes = _mix(hashes)
        cuts = np.searchsorted(start, np.cumsum(np.array(lengths) + 1)).tolist()
        for r, a, b in zip(rows, [0, *cuts[:-1]], cuts, strict=True):
            words[r].append(hashes[a:b])
    out = []
    for parts in words:
        w = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, dtype=_U)
        n = len(w)
        k = min(n, shingle)
        if not n:
            out.append(w)
            continue
        total = w[: n - k + 1] * _PLACES[0]
        for j in range(1, k):
            total = total + w[j : n - k + 1 + j] * _PLACES[j]
        out.append(np.unique(_mix(total + _U(k))))
    return out


def node_of(elements: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes())).astype(np.int64))


def _least_common(total):
    """Common elements that two sets of so many elements together need."""
    return -(-SHARE * total // (OF + SHARE))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Of two sorted sets."""
    if OF * min(len(a), len(b)) < SHARE * max(len(a), len(b)):
        return False
    common = len(a) + len(b) - len(np.union1d(a, b))
    return OF * common >= SHARE * (len(a) + len(b) - common)


def most_difference(size):
    """Elements in which a set may differ from a similar one that is no smaller, at most.

    Over the sizes y from x to x * OF / SHARE of the larger set it is the largest
    x + y - 2 * common; the last two sizes decide, as the floor moves it by one.
    """
    top = OF * size // SHARE
    found = size + top - 2 * _least_common(size + top)
    before = np.maximum(top - 1, size)
    return np.maximum(found, size + before - 2 * _least_common(size + before))


class Bands:
    """Upper size and groups of three partitions of each band, up to sizes of 2**40."""

    def __init__(self):
        uppers, size = [], 4
        while size < 1 << 40:
            uppers.append(size)
            size = int(size * BAND) + 1
        self.upper = np.array(uppers, dtype=np.int64)
        need = most_difference(self.upper) + 1
        self.groups = np.ceil((need // 2 + 1) * SPARE).astype(np.int64)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.upper, size)


_BANDS = Bands()


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of its set) of non-empty sets, for their own bands and for the next where a partner may be in it."""
    if not sets:
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    element = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), size)
    own = _BANDS.of(size)
    above = _BANDS.of(OF * size // SHARE)
    need = most_difference(size) + 1
    out = [_band_signatures(sets, element, of, own, need)]
    reach = np.flatnonzero(above > own)  # a factor of OF / SHARE is less than a band
    if len(reach):
        keep = np.zeros(len(sets), dtype=bool)
        keep[reach] = True
        mine = keep[of]
        out.append(_band_signatures(sets, element[mine], of[mine], own + 1, need))
    return np.concatenate([s for s, _ in out]), np.concatenate([i for _, i in out])


def _band_signatures(sets, element, of, band, need) -> tuple[np.ndarray, np.ndarray]:
    in_band = band[of]
    seed = _mix((in_band + 1).astype(_U) * _P)
    spread = _mix(element ^ seed)
    parts = (_BANDS.groups[in_band] * 3).astype(_U)
    part = ((spread >> _U(32)) * parts >> _U(32)).astype(np.int64)
    inside = _mix(element + _P * seed)
    where = of << 40 | part
    order = np.argsort(where, kind="stable")
    where, inside = where[order], inside[order]
    first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
    content = np.add.reduceat(inside, first)
    where = where[first]
    out, of = _choose(sets, where >> 40, where & ((1 << 40) - 1), content, need, band)
    return np.concatenate(out), np.concatenate(of)


def _ranks(owner: np.ndarray) -> np.ndarray:
    """The place of each row among the rows of its owner, which stand together."""
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))


def _sign(content, part, band, kind: int) -> np.ndarray:
    return _mix(content + _mix(part.astype(_U) * _PLACES[5] + band.astype(_U) * _PLACES[6] + _U(kind)))


def _short(sets, present, n_groups, needed, need, band) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The first elements, as signatures, of sets with fewer groups than needed.

    Two such similar sets have one in common: sorted by hash, neither set's part
    of the other before its first ``need`` elements is larger than their difference.
    """
    short = present[n_groups[present] < needed[present]]
    out, of = [], []
    for s in short.tolist():
        first = sets[s][: need[s]]
        out.append(_sign(first, np.zeros(len(first), dtype=_U), np.full(len(first), band[s]), 9))
        of.append(np.full(len(first), s))
    return out, of


def _choose(sets, owner, part, content, need, band):
    group, member = part // 3, part % 3
    key = owner << 40 | group
    new = np.concatenate([[True], key[1:] != key[:-1]])
    at, first = np.cumsum(new) - 1, np.flatnonzero(new)
    held = np.zeros((len(first), 3), dtype=_U)
    there = np.zeros((len(first), 3), dtype=bool)
    held[at, member] = content
    there[at, member] = True
    full = there.sum(axis=1) >= 2  # each subset of two has an element
    owner, group = owner[first], group[first]
    present = np.unique(owner)
    needed = (need - 1) // 2 + 1
    out, of = _short(sets, present, np.bincount(owner[full], minlength=len(sets)), needed, need, band)
    # up to the last full group that is needed, the subsets with an element of all groups
    before = np.cumsum(full) - full
    start = np.flatnonzero(_ranks(owner) == 0)
    before -= np.repeat(before[start], np.diff(np.append(start, len(owner))))
    take = before < needed[owner]
    for left in range(3):  # the subset without this member
        a, b = (left + 1) % 3, (left + 2) % 3
        mine = take & (there[:, a] | there[:, b])
        out.append(_sign(held[mine, a] * _PLACES[7 + a] + held[mine, b] * _PLACES[7 + b], group[mine], band[owner[mine]], 2 + left))
        of.append(owner[mine])
    return out, of


def counters(sets: list[np.ndarray]) -> list[bytes]:
    """256 saturating counters of each set's elements; their difference is no more than the sets'."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if not size.sum():
        return [bytes(COUNTERS)] * len(sets)
    place = (np.concatenate(sets) >> _U(56)).astype(np.int64) + np.repeat(np.arange(len(sets)), size) * COUNTERS
    table = np.minimum(np.bincount(place, minlength=len(sets) * COUNTERS), 255).astype(np.uint8).reshape(-1, COUNTERS)
    return [row.tobytes() for row in table]


def profiles(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``n`` (elements), ``node`` (the set's name; null if empty) and its ``counters``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), shingle)
            columns = [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array(counters(sets), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "node", "counters"])

    sent = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw"))
    return sent.mapInArrow(run, "doc_id long, n long, node long, counters binary")


def signature_groups(docs: DataFrame, *, text_col: str = "text", shingle: int = SHINGLE, buckets: int) -> DataFrame:
    """``sig``, ``node`` and ``center`` (the smallest node of the signature) of signatures that two sets or more share.

    Signatures travel as packed arrays, one row for each task and bucket, and a
    task sends those of equal sets once.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        done: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            sig = np.concatenate([s for s, _ in held])
            node = np.concatenate([x for _, x in held])
            bucket = ((sig >> _U(20)) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, sig, node = bucket[order], sig[order], node[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            edges = np.append(first, len(bucket)).tolist()
            cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(edges, edges[1:])], pa.binary())  # noqa: B905, E731
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), cut(sig), cut(node)], names=["bucket", "sigs", "nodes"])

        for batch in batches:
            raws = batch.column(0).to_pylist()
            for begin in range(0, len(raws), 1024):
                sets, nodes = [], []
                for s in shingle_sets(raws[begin : begin + 1024], shingle):
                    if len(s) and (node := node_of(s)) not in done:
                        done.add(node)
                        sets.append(s)
                        nodes.append(node)
                sig, of = signatures(sets)
                held.append((sig, np.array(nodes, dtype=np.int64)[of]))
                n += len(sig)
                if n >= HELD:
                    yield flush()
                    n = 0
        if n:
            yield flush()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        at, held = None, []

        def groups() -> Iterator[pa.RecordBatch]:
            sig = np.concatenate([np.frombuffer(s, dtype=_U) for s, _ in held])
            node = np.concatenate([np.frombuffer(x, dtype=np.int64) for _, x in held])
            order = np.lexsort((node, sig))
            sig, node = sig[order], node[order]
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])  # equal sets of different tasks
            sig, node = sig[new], node[new]
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            count = np.diff(np.append(first, len(sig)))
            center = np.repeat(node[first], count)
            keep = np.repeat(count, count) > 1
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[keep].view(np.int64)), pa.array(node[keep]), pa.array(center[keep])], names=["sig", "node", "center"]
                )

        for batch in batches:
            for bucket, sigs, nodes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != at and held:
                    yield from groups()
                    held = []
                at = bucket
                held.append((sigs, nodes))
        if held:
            yield from groups()

    sent = docs.select(text_bytes(text_col).alias("raw")).mapInArrow(emit, "bucket long, sigs binary, nodes binary")
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(gather, "sig long, node long, center long")


def _room(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Difference that similar sets of these sizes may have; -1 if such sizes cannot be similar."""
    common = _least_common(n_a + n_b)
    return np.where(common <= np.minimum(n_a, n_b), n_a + n_b - 2 * common, -1)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.abs(a.astype(np.int16) - b.astype(np.int16)).sum(axis=-1)


def _near(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """May rows of counters be of similar sets?"""
    return _apart(a, b) <= _room(n_a, n_b)


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, COUNTERS)


def _padded(lists: pa.Array) -> np.ndarray:
    """Lists of at most EARLIER signatures as rows, filled up with values that no other row has."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    table = -1 - np.arange(len(lists) * EARLIER, dtype=np.int64).reshape(-1, EARLIER)
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    table[np.arange(EARLIER) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return table


def _meet(earlier: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Have rows i and j of ``earlier`` a value in common?"""
    out = np.zeros(len(i), dtype=bool)
    for first in range(0, len(i), 65536):
        part = slice(first, first + 65536)
        for k in range(EARLIER):
            out[part] |= (earlier[i[part], k, None] == earlier[j[part]]).any(axis=1)
    return out


def _passing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of nodes that the counters do not rule out."""
    info = classes.select("node", "n", "counters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            n_a, n_b = (batch.column(k).to_numpy() for k in (2, 4))
            keep = pa.array(_near(n_a, n_b, _rows(batch.column(3)), _rows(batch.column(5))))
            yield batch.select([0, 1]).filter(keep)

    a = info.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("counters").alias("c_a"))
    b = info.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("counters").alias("c_b"))
    wide = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "c_a", "n_b", "c_b")
    return wide.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, *, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """The pairs (``a``, ``b``) of nodes whose exact sets are similar; texts are read for the nodes in a pair only."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    ids = written(wanted.join(classes, "node").select("node", "doc_id"), "wanted")
    known = ids.select(F.col("doc_id").alias("_of")).distinct()
    if ids.count() <= BROADCAST_IDS:  # 8 bytes each; more are joined by a shuffle
        known = F.broadcast(known)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(text_col).alias("raw"))
    texts = texts.join(known, F.col("_id").eqNullSafe(F.col("_of")), "left_semi")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            nodes = [node_of(s) if len(s) else None for s in shingle_sets(batch.column(0).to_pylist(), shingle)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column(0)], names=["node", "raw"])

    named = texts.select("raw").mapInArrow(name, "node long, raw binary").join(ids.select("node").distinct(), "node", "left_semi")
    stored = written(named.dropDuplicates(["node"]), "texts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        last, center = None, None
        for batch in batches:
            keep = []
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin in range(0, batch.num_rows, 256):
                part = slice(begin, begin + 256)
                others = shingle_sets(batch.column(3)[part].to_pylist(), shingle)
                for x, k, other in zip(a[part], range(begin, begin + 256), others, strict=False):
                    if x != last:
                        last, center = x, shingle_sets([batch.column(2)[k].as_py()], shingle)[0]
                    keep.append(similar(center, other))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = stored.select(F.col("node").alias("a"), F.col("raw").alias("raw_a"))
    right = stored.select(F.col("node").alias("b"), F.col("raw").alias("raw_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "raw_a", "raw_b")
    return both.mapInArrow(compare, "a long, b long")


def _rest(groups: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of nodes that share a signature, are in different components, and that the counters do not rule out.

    Signatures shared by the very same nodes are one.  A signature with many such
    nodes is cut into blocks, and each pair of blocks is a task's work of its own.
    A pair is not sent where the nodes share one of the signatures that come just
    before in the order of their values, as they meet there too.
    """
    placed = groups.join(roots, "node", "left").select("sig", "node", "center", F.coalesce("root", "node").alias("root"))
    members = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"members{k}") for k in range(2)]
    mixed = placed.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m"), *members)
    # pairs with the center are known, so two nodes leave none
    mixed = mixed.filter("lo != hi and m > 2").groupBy("m", "members0", "members1").agg(F.min("sig").alias("sig"))
    open_ = placed.join(mixed.select("sig", "m"), "sig").filter("node != center")
    before = Window.partitionBy("node").orderBy("sig").rowsBetween(-EARLIER, -1)
    open_ = open_.withColumn("earlier", F.collect_list("sig").over(before))
    info = classes.select("node", "n", "counters")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (
        open_.join(info, "node")
        .select("sig", "node", "root", "n", "counters", "earlier", blocks.alias("blocks"), mine.alias("mine"))
        .select("*", other)
        .select("sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "root", "n", "counters", "earlier")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        key, held = None, []

        def pairs() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            mine, node, root, n = (rows.column(k).to_numpy() for k in ("mine", "node", "root", "n"))
            table = _rows(rows.column("counters"))
            earlier = _padded(rows.column("earlier"))
            coarse = table.reshape(len(table), -1, SUMMED).sum(axis=2, dtype=np.int16)
            first = np.flatnonzero(mine == key[1])
            second = np.flatnonzero(mine == key[2])
            step = max(1, BLOCK * 64 // max(1, len(second)))  # so many rows at a time that their differences stay small
            for begin in range(0, len(first), step):
                mine_ = first[begin : begin + step, None]
                room = np.where(root[mine_] != root[second], _room(n[mine_], n[second]), -1)
                if key[1] == key[2]:
                    room[second <= mine_] = -1
                i, j = np.nonzero(_apart(coarse[mine_], coarse[second]) <= room)  # the sums rule most out
                i, j, room = mine_[i, 0], second[j], room[i, j]
                near = _apart(table[i], table[j]) <= room
                i, j = i[near], j[near]
                new = ~_meet(earlier, i, j)  # the others are named in the smaller signature
                i, j = i[new], j[new]
                if len(i):
                    ends = np.sort(np.stack([node[i], node[j]]), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], names=["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            begin = 0
            for k in range(len(keys) + 1):
                if k == len(keys) or keys[k] != (keys[begin] if k > begin else keys[k]):
                    if k > begin:
                        if keys[begin] != key and held:
                            yield from pairs()
                            held = []
                        key = keys[begin]
                        held.append(batch.slice(begin, k - begin))
                    begin = k
        if held:
            yield from pairs()

    order = ["sig", "i", "j"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long").distinct()


def jaccard_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``.

    Texts are compared as sets of distinct ``shingle``-word shingles (the whole
    sequence for a text of fewer words); two are linked when their Jaccard
    similarity is at least SHARE / OF.  The component is named by its smallest id
    (null if all its ids are null).  A null, empty or wordless text is linked with
    nothing and is its own component.  Rows with equal texts, whether or not their
    ids are equal, are in one component.  ``docs`` is read three times, so it
    should be a stored table.
    """
    profile = written(profiles(docs, id_col=id_col, text_col=text_col, shingle=shingle), "profiles")
    # equal sets have equal names and sizes; one name of two different sets stays two classes
    classes = profile.filter("node is not null").groupBy("node", "n").agg(F.min("doc_id").alias("doc_id"), F.first("counters").alias("counters"))
    classes = written(classes, "classes")
    elements = profile.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(FOR_EACH * elements / BUCKET))
    groups = written(signature_groups(docs, text_col=text_col, shingle=shingle, buckets=buckets), "signatures")
    star = groups.filter("node != center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    named = {"id_col": id_col, "text_col": text_col, "shingle": shingle}
    links = written(verified(written(_passing(star, classes), "pairs"), classes, docs, **named), "links")
    roots = components(links)
    rest = written(_rest(groups, roots, classes), "pairs")
    if not rest.isEmpty():
        links = links.unionByName(verified(rest, classes, docs, **named))
        roots = components(links)
    named_roots = classes.join(roots, "node", "left").select("node", "n", "doc_id", F.coalesce("root", "node").alias("root"))
    least = named_roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    member = named_roots.join(least, "root").select(F.col("node").alias("_node"), F.col("n").alias("_n"), "component_id")
    found = profile.join(member, (profile["node"] == member["_node"]) & (profile["n"] == member["_n"]), "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
