import gzip
import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest

from headway.llm import tokens, warc
from headway.llm.bpe import encoder
from headway.llm.common import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text, end):
    return encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def test_token_files_round_trip(spark):
    docs = [(i, f"text number {i} " * (i % 40)) for i in range(300)] + [(300, None), (-5, ""), (7, "again"), (None, "no id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    folder = scratch_path(spark, "t")
    manifest = tokens.write_token_files(df, folder, PATH, seq_len=16, end_id=0)
    rows = tokens.read_documents(spark, folder).orderBy("start").collect()
    at, last = 0, None
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert last is None or r["doc_id"] >= last
        at += r["n_tokens"]
        last = r["doc_id"] if r["doc_id"] is not None else last
    assert rows[0]["doc_id"] is None
    assert sorted((str(r["doc_id"]), r["ids"]) for r in rows) == sorted((str(i), ids_of(t, 0)) for i, t in docs)
    digests = tokens.read_documents(spark, folder, digests=True).orderBy("start").collect()
    assert [r["ids_crc32"] for r in digests] == [zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows]
    # random access to equal-length sequences and masks
    flat = np.concatenate([r["ids"] for r in rows])
    for m in manifest.collect():
        shard = tokens.TokenFile(m["tokens_path"])
        own = flat[m["base"] : m["base"] + m["n_tokens"]]
        for k in range(m["n_sequences"]):
            ids, mask = shard.sequence(k)
            want = own[16 * k : 16 * (k + 1)]
            assert len(ids) == len(mask) == 16 and mask.sum() == len(want)
            assert ids[: len(want)].tolist() == want.tolist() and not ids[len(want) :].any()
            assert not ids.flags.owndata  # a view of the mapped file
            view, bits = shard.views(k)
            assert view.tolist() == ids.tolist() and bits.to_pylist() == mask.tolist()
            assert _within(shard, view.__array_interface__["data"][0]) and _within(shard, bits.buffers()[1].address)


def _within(shard, address):
    """Is this the address of a mapped byte of the file?"""
    shard.source.seek(0)
    mapped = shard.source.read_buffer(shard.source.size())
    return mapped.address <= address < mapped.address + mapped.size


def test_token_files_across_batches(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_IDS", 64)
    df = spark.createDataFrame([(1, "a b c d e f g " * 400), (2, "x"), (3, "y z " * 100)], "doc_id long, text string").coalesce(1)
    folder = scratch_path(spark, "t")
    tokens.write_token_files(df, folder, PATH, seq_len=16)
    got = {r["doc_id"]: r["ids"] for r in tokens.read_documents(spark, folder).collect()}
    assert got == {1: ids_of("a b c d e f g " * 400, 0), 2: ids_of("x", 0), 3: ids_of("y z " * 100, 0)}


def test_token_files_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder = scratch_path(spark, "t")
    assert tokens.write_token_files(df, folder, PATH).collect() == []
    assert tokens.read_documents(spark, folder).collect() == []
    with pytest.raises(TypeError):
        tokens.write_token_files(spark.createDataFrame([("a", "b")], "doc_id string, text string"), folder, PATH)


def brute_warc(pages):
    largest = {}
    for page_id, _, html in pages:
        body = (html or "").encode()
        if len(body) >= 1000 and page_id is not None:
            largest[body] = max(page_id, largest.get(body, page_id))
    out = []
    for page_id, _, html in pages:
        body = (html or "").encode()
        target = largest.get(body)
        revisit = target is not None and target != page_id
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    big = "".join(f"<p>é{i}</p>" for i in range(30_000))
    same = "x" * 1000
    pages = [(i, f"http://a/{i}", [same, "short", big, None, "", "y" * 999, "z" * 1001][i % 7]) for i in range(40)]
    pages += [(None, "http://a/none", same), (None, None, "only here " * 200), (39, "http://a\r\nb", "z" * 1001), (35, "u", same), (35, "u", same)]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, refers_to string")
    folder = scratch_path(spark, "w")
    manifest = warc.write_archives(df, folder).collect()
    assert sum(m["n_records"] for m in manifest) == len(pages)
    chunks = warc.read_archives(spark, folder, chunk_bytes=4096).collect()
    last = [r for r in chunks if r["is_last"]]
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in last], key=str) == brute_warc(pages)
    assert len({r["record_id"] for r in last if r["page_id"] is not None}) == sum(p[0] is not None for p in pages)
    # chunks are bounded, whole and carry the digest so far
    by = {}
    for r in chunks:
        by.setdefault((r["archive"], r["record"]), []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: r["chunk"])
        data = b""
        for r in rows:
            assert len(r["data"]) <= 4096
            data += bytes(r["data"])
            if r["record_type"] == "response":
                assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
    assert any(len(rows) > 50 for rows in by.values())
    without = warc.read_archives(spark, folder, data=False)
    assert without.filter("data is not null").count() == 0 and without.filter("is_last").count() == len(pages)
    # the files are plain WARC in gzip members
    path = manifest[0]["archive"].removeprefix("file:")
    assert gzip.decompress(open(path, "rb").read()).startswith(b"WARC/1.1\r\nWARC-Type: re")


def test_damaged_archives_raise(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "hello " * 500)], "page_id long, url string, html string")
    folder = scratch_path(spark, "w")
    path = warc.write_archives(df, folder).first()["archive"].removeprefix("file:")
    raw = gzip.decompress(open(path, "rb").read())
    bad = os.path.join(tmp_path, "bad.warc.gz")
    open(bad, "wb").write(gzip.compress(raw.replace(b"hello", b"jello")))
    assert list(warc.records(bad))[-1][-1] != hashlib.sha1(b"hello " * 500).hexdigest()
    for damaged in (raw[:-300], raw[:-2], raw[:60], raw[10:]):
        open(bad, "wb").write(gzip.compress(damaged))
        with pytest.raises(ValueError):
            list(warc.records(bad))


def test_archives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "w")
    assert warc.write_archives(df, folder).collect() == []
    assert warc.read_archives(spark, folder).collect() == []
