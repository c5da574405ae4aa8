import random
import textwrap

import numpy as np

from headway.llm import licenses, urls
from headway.llm.common import scratch_path
from headway.llm.queries import URL_RULES

MIT = licenses.KNOWN_TEXTS[-2][1]


def test_canonical_spellings_are_found(spark):
    noisy = "Copyright (c) 2019 Someone\n" + MIT.upper().replace('"', "''").replace(", ", " ,\n") + "\nAll rights reserved."
    texts = [
        (1, "released under the MIT licence"),
        (2, "Some text.\nLicenced under the Apache License, version 2.0!\nmore\nReleased under the MIT License."),
        (3, MIT),
        (4, noisy),
        (5, "The MIT License is a licence."),
        (6, None),
        (7, ""),
        (8, "Copyright 2020 A\n\n..."),
        (9, "Copyright holders are named in a line that no licence has"),
        (None, "Licensed under CC BY-NC 4.0."),
        (2, "another row of 2"),
    ]
    df = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, licenses string")
    got = sorted((str(r["doc_id"]), r["licenses"], r["n_notices"], r["whole_text"]) for r in licenses.scan(df, licenses.known_licenses(spark)).collect())
    assert got == sorted(
        [
            ("1", "MIT", 1, True),
            ("2", "Apache-2.0,MIT", 2, False),
            ("2", "Apache-2.0,MIT", 2, False),
            ("3", "MIT", 0, True),
            ("4", "MIT", 0, True),
            ("5", "", 0, False),
            ("6", "", 0, False),
            ("7", "", 0, False),
            ("8", "", 0, False),
            ("9", "", 0, False),
            ("None", "CC-BY-NC-4.0", 1, True),
        ]
    )


def test_whole_license_files(spark):
    common = "/usr/share/common-licenses/"
    read = lambda name: open(common + name, encoding="utf-8").read()
    rewrapped = lambda text, width: "\n\n".join(textwrap.fill(part, width) for part in text.split("\n\n"))
    apache, bsd, gpl, gpl2 = read("Apache-2.0"), read("BSD"), read("GPL-3"), read("GPL-2")
    holder = bsd.replace("University", "copyright holder").replace("REGENTS AND", "COPYRIGHT HOLDERS AND").replace("REGENTS OR", "COPYRIGHT HOLDER OR")
    files = [
        ("Apache-2.0", apache),
        ("Apache-2.0", apache[apache.index("TERMS AND") :].replace("Copyright [yyyy] [name of copyright owner]", "Copyright Foo Inc.")),
        ("Apache-2.0", apache[: apache.index("APPENDIX")]),
        ("BSD-3-Clause", bsd),
        ("BSD-3-Clause", "BSD 3-Clause License\n\n" + holder.replace("The Regents of the University of California", "Foo, Inc.")),
        ("BSD-2-Clause", holder[: holder.index("3. ")] + holder[holder.index("THIS SOFTWARE") :]),
        ("CC0-1.0", read("CC0-1.0")),
        ("GPL-1.0", read("GPL-1")),
        ("GPL-2.0", read("GPL-2")),
        ("GPL-3.0", gpl),
        ("GPL-3.0", gpl[gpl.index("Copyright (C) 2007") :]),
        ("GPL-3.0", rewrapped(gpl[gpl.index(" Everyone is permitted") : gpl.index("How to Apply")], 90)),
        ("GPL-2.0", rewrapped(gpl2[: gpl2.index("How to Apply")].replace("1989, 1991 Free Software Foundation, Inc.,", "1989\n\n"), 40)),
        ("LGPL-2.0", read("LGPL-2")),
        ("LGPL-2.1", read("LGPL-2.1")),
        ("LGPL-3.0", read("LGPL-3")),
        ("MPL-2.0", read("MPL-2.0")),
        ("MPL-2.0", read("MPL-2.0").split("\n", 2)[2]),
    ]
    for title in ("MIT License", "The MIT License (MIT)", ""):
        for line in ("Copyright Foo Inc.", "Copyright (c) Foo Inc.\nCopyright Bar", "© Foo", "Copyright: (c) 2019-2020 Foo\r\nAll rights reserved.\r"):
            files.append(("MIT", f"{title}\n\n{line}\n\n{rewrapped(MIT, 60)}\n"))
    none = [("", apache.replace("irrevocable", "revocable")), ("", "Copyright Foo\n\nCopyright notices are kept."), ("", MIT + "\nNot for sale.")]
    rows = [*files, *none]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: (r["licenses"], r["whole_text"]) for r in licenses.scan(df, licenses.known_licenses(spark)).collect()}
    assert [got[i] for i in range(len(rows))] == [(name, name != "") for name, _ in rows]


def test_no_licences_and_no_documents(spark):
    docs = spark.createDataFrame([(1, MIT)], "doc_id long, text string")
    none = licenses.known_licenses(spark, [("X", "...")])
    assert [r["licenses"] for r in licenses.scan(docs, none).collect()] == [""]
    assert licenses.scan(docs.filter("false"), licenses.known_licenses(spark)).collect() == []


def brute_url(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        cut = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
        path = rest[:cut]
    fits = [(h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return (host, path, best[0] + best[1] if best else None, best[2] if best else default)


URLS = [
    None, "", "no scheme", "http://", "http://COM/", "http://a.com", "http://a.com/", "https://www.Example.com/en/x?y=/z#/q",
    "https://example.com/en", "https://example.com/en/", "ftp://b.www.example.com/en/a#b", "http://notexample.com/en/", "http://x.net/es/",
    "http://net/fr/1", "http://x.net/de/", "http://a.net?x=/es/", "http://a.b/://c.net/es/", "http://a\nb.net/es/\n", "HTTP://É.NET/fr/é",
]


def test_rules_against_a_plain_version(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 2)], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = urls.judge(df, urls.write_rules(rules, scratch_path(spark, "r"))).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == {
        i: brute_url(u, URL_RULES) for i, u in enumerate(URLS * 2)
    }


def test_many_rules_in_several_shards(spark):
    rnd = random.Random(3)
    labels = ["a", "b", "cc", "ddd", "e"]
    rules = {}
    for _ in range(400):
        h = ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 3)))
        p = "".join("/" + rnd.choice(labels) for _ in range(rnd.randint(0, 3))) + rnd.choice(["", "/"])
        rules[h, p] = rnd.choice(["allow", "block"])
    listed = [(h, p, v) for (h, p), v in rules.items()]
    manifest = urls.write_rules(spark.createDataFrame(listed * 2, "host string, path string, verdict string"), scratch_path(spark, "r"), shards=4)
    assert manifest.count() > 1
    texts = []
    for _ in range(600):
        h = ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 5)))
        texts.append(f"http://{h}" + "".join("/" + rnd.choice(labels) for _ in range(rnd.randint(0, 4))) + rnd.choice(["", "/", "?q", "#f"]))
    got = urls.judge(spark.createDataFrame([(i, u) for i, u in enumerate(texts)], "page_id long, url string"), manifest, default="block").collect()
    for r in got:
        host, path, rule, verdict = brute_url(texts[r["page_id"]], listed, "block")
        assert (r["host"], r["path"], r["verdict"]) == (host, path, verdict) or len(r["rule"]) == len(rule)
        assert (r["rule"] is None) == (rule is None)


def test_a_collision_gives_no_verdict(spark, monkeypatch):
    manifest = urls.write_rules(spark.createDataFrame(URL_RULES, "host string, path string, verdict string"), scratch_path(spark, "r"))
    array = urls.DigestArray([(r["keys"], r["rules"]) for r in manifest.orderBy("shard").collect()])
    key = int(array.keys[0][0])
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda raw, seed: key % 2**64)
    stored = [array.rule(0, 0)[0]]
    found = array.find(["other\0/", "com\0", stored[0]])
    assert found[:2] == [None, None] and found[2] is not None
    assert isinstance(array.keys[0], np.memmap)


def test_only_strings_with_an_equal_key_are_read(spark):
    from pyspark.sql import functions as F

    hosts = F.format_string("h%d.com", "id")
    rules = spark.range(40_000).select(hosts.alias("host"), F.lit("/").alias("path"), F.lit("block").alias("verdict"))
    manifest = urls.write_rules(rules, scratch_path(spark, "r"), shards=2).orderBy("shard").collect()
    assert sum(r["n_rules"] for r in manifest) == 40_000 and {tuple(r["path_lengths"]) for r in manifest} == {(1,)}
    array = urls.DigestArray([(r["keys"], r["rules"]) for r in manifest])
    assert array.find([f"x{k}.com\0/" for k in range(10_000)]) == [None] * 10_000 and not array.held
    found = array.find(["h7.com\0/", "h39999.com\0/"])
    assert [array.rule(*at) for at in found] == [("h7.com\0/", "block"), ("h39999.com\0/", "block")]
    assert 1 <= len(array.held) <= 2 and all(b.num_rows <= urls.BATCH_RULES for b in array.held.values())


def test_of_two_equally_long_rules_the_longer_host_stands(spark):
    rules = spark.createDataFrame([("a.b.com", "/", "allow"), ("b.com", "/xx", "block")], "host string, path string, verdict string")
    page = spark.createDataFrame([(1, "http://a.b.com/xx")], "page_id long, url string")
    got = urls.judge(page, urls.write_rules(rules, scratch_path(spark, "r"))).collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [("a.b.com/", "allow")]


def test_no_rules_no_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    manifest = urls.write_rules(rules, scratch_path(spark, "r"))
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in urls.judge(pages, manifest).collect()] == [(1, "http://a.com/", "a.com", "/", None, "allow")]
    assert urls.judge(pages.filter("false"), manifest).collect() == []
