"""URL rules kept as a sorted digest array.

A rule is a host and the beginning of a path; it fits its host and all its
subdomains where the url's path starts with the rule's, and the longest fitting
rule gives the verdict.  The rules are stored in the shared folder as shards of
sorted 64-bit xxhash keys with the full rule strings beside them, in batches that
can be read by row.  Tasks map the shards, probe all keys of a batch of urls with
a vectorised binary search, and compare the full strings of what was found, so a
collision cannot give a verdict.  No task reads the strings of other rules.

On a storage that cannot be mapped the keys (8 bytes a rule) are read into each
worker; the strings are still read by row.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from headway.llm.common import AtomicFile, local_or_remote, make_folder, worker_state

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEED = 42  # that of Spark's xxhash64, which makes the keys
_MANIFEST = "shard int, n_rules long, keys string, rules string, path_lengths array<int>"

#: Rules in one batch of a shard's strings, which is what a look at a string reads.
BATCH_RULES = 4096


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    # the pattern above has no "." and so crosses line breaks
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))), F.lit(""))


def write_rules(rules: DataFrame, folder: str, shards: int | None = None) -> DataFrame:
    """Store ``rules`` (``host``, ``path``, ``verdict``) under ``folder``; returns the manifest, read from there.

    Hosts are lower-cased.  Null hosts, paths or verdicts raise an error when the
    rules are written; a repeated rule must have one verdict, else ``block``
    stands.  No rules give an empty manifest.
    """
    make_folder(folder)
    wanted = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
    bad = F.col("host").isNull() | F.col("path").isNull() | F.col("verdict").isNull() | ~F.col("verdict").isin("allow", "block")
    checked = wanted.select("host", "path", F.when(bad, F.raise_error(F.lit("a rule needs a host, a path and allow or block"))).otherwise(F.col("verdict")).alias("verdict"))
    text = F.concat("host", F.lit("\0"), "path")
    keyed = (
        checked.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(F.xxhash64(text).alias("key"), text.alias("rule"), "verdict")
    )
    dealt = keyed.repartitionByRange(shards, "key") if shards else keyed.repartitionByRange("key")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        shard = TaskContext.get().partitionId()
        names = f"{folder}/keys-{shard:05d}.npy", f"{folder}/rules-{shard:05d}.arrow"
        raw = io.BytesIO()
        np.save(raw, table.column(0).to_numpy())
        with AtomicFile(names[0]) as out:
            out.write(raw.getvalue())
        strings = table.select([1, 2]).combine_chunks()
        with AtomicFile(names[1]) as out, pa.ipc.new_file(out, strings.schema) as file:
            file.write_table(strings, max_chunksize=BATCH_RULES)
        lengths = sorted({len(r) - r.index("\0") - 1 for r in strings.column(0).to_pylist()})
        row = {"shard": pa.array([shard], pa.int32()), "n_rules": pa.array([table.num_rows], pa.int64()), "keys": [names[0]], "rules": [names[1]]}
        yield pa.RecordBatch.from_pydict({**row, "path_lengths": pa.array([lengths], pa.list_(pa.int32()))})

    dealt.sortWithinPartitions("key", "rule").mapInArrow(write, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return rules.sparkSession.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


class DigestArray:
    """The mapped shards, in order of their keys."""

    def __init__(self, shards: list[tuple[str, str]]):
        self.keys, self.files = [], []
        for keys, rules in shards:
            fs, path = local_or_remote(keys)
            if fs.type_name == "local":
                self.keys.append(np.load(path, mmap_mode="r"))
                source = pa.memory_map(local_or_remote(rules)[1])
            else:
                with fs.open_input_stream(path, compression=None) as stream:
                    self.keys.append(np.load(io.BytesIO(stream.read())))
                source = fs.open_input_file(local_or_remote(rules)[1])
            self.files.append(pa.ipc.open_file(source))
        self.first = np.array([k[0] for k in self.keys], dtype=np.int64)
        self.held: dict[tuple[int, int], pa.RecordBatch] = {}

    def rule(self, shard: int, row: int) -> tuple[str, str]:
        """The string and the verdict of a rule; the last few batches that were read are kept."""
        batch, at = divmod(row, BATCH_RULES)
        held = self.held.pop((shard, batch), None)
        if held is None:
            while len(self.held) >= 64:
                self.held.pop(next(iter(self.held)))
            held = self.files[shard].get_batch(batch)
        self.held[shard, batch] = held
        return held.column(0)[at].as_py(), held.column(1)[at].as_py()

    def find(self, texts: list[str]) -> list[tuple[int, int] | None]:
        """(shard, row) of each text that is a rule."""
        if not texts or not self.keys:
            return [None] * len(texts)
        hashes = np.array([xxhash.xxh64_intdigest(t.encode(), _SEED) for t in texts], dtype=np.uint64).view(np.int64)
        out: list[tuple[int, int] | None] = [None] * len(texts)
        # equal keys may go on from one shard into the next, so a key is looked for from the first shard that may have it
        begin = np.maximum(np.searchsorted(self.first, hashes, side="left") - 1, 0)
        stop = np.searchsorted(self.first, hashes, side="right")
        for s, keys in enumerate(self.keys):
            mine = np.flatnonzero((begin <= s) & (s < stop))
            low, high = np.searchsorted(keys, hashes[mine], side="left"), np.searchsorted(keys, hashes[mine], side="right")
            found = np.flatnonzero(low < high)  # only where a key is equal
            for i, k, end in zip(mine[found].tolist(), low[found].tolist(), high[found].tolist(), strict=True):
                while k < end and self.rule(s, k)[0] != texts[i]:
                    k += 1
                if k < end:
                    out[i] = (s, k)
        return out


def judge(pages: DataFrame, manifest: DataFrame, *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` (the rule's, else ``default``).

    A null url, or one without ``://``, has an empty host and path and fits no
    rule.  Rows are judged one by one, so repeated rows and nulls elsewhere do
    not matter; input columns named like the four results are replaced.  The
    manifest has a row for each shard of rules, with its lengths of paths.  Two
    fitting rules of one url differ in their strings; of those with equally long
    strings (``a.b.com`` with ``/``, ``b.com`` with a longer path) the one with the
    longer host stands.
    """
    listed = manifest.orderBy("shard").collect()
    shards = [(r["keys"], r["rules"]) for r in listed]
    lengths = sorted({n for r in listed for n in r["path_lengths"]})
    added = ["host", "path", "rule", "verdict"]
    base = pages.select(*[c for c in pages.columns if c not in added], url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))

    schema = T.StructType([*base.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = worker_state("urls", tuple(shards), lambda: DigestArray(shards))
        for batch in batches:
            hosts, paths = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            of, text, size = [], [], []
            for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                at = 0
                while True:
                    for n in lengths:
                        if n > len(path):
                            break
                        of.append(i)
                        text.append(f"{host[at:]}\0{path[:n]}")
                        size.append(len(text[-1]))
                    if (dot := host.find(".", at)) < 0:
                        break
                    at = dot + 1
            best: dict[int, tuple[int, tuple[int, int]]] = {}
            for i, n, found in zip(of, size, array.find(text), strict=True):
                if found is not None and n > best.get(i, (0,))[0]:
                    best[i] = (n, found)
            rule: list[str | None] = [None] * len(hosts)
            verdict = [default] * len(hosts)
            for i, (_, (s, k)) in best.items():
                text_of, verdict[i] = array.rule(s, k)
                rule[i] = text_of.replace("\0", "")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=schema.names)

    return base.mapInArrow(fit, schema)
