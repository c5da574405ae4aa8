import random
import re

from headway.llm import decontam, html

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    doc = words(text)
    hit, found = set(), set()
    for item_id, t in items:
        w = words(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            win = w[i : i + window]
            for j in range(len(doc) - len(win) + 1):
                if doc[j : j + len(win)] == win:
                    hit.update(range(j, j + len(win)))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(doc), len(hit), sorted(found), bool(hit)


def test_marks_what_a_plain_search_marks(spark):
    rnd = random.Random(5)
    vocabulary = ["a", "b", "The", "rare", "é", "x1", "naïve"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 2, 4, 6, 9])))) for i in range(20)]
    items += [(3, "THE; b... a-a é"), (None, "x1 x1 x1 x1"), (77, None), (78, ""), (100, "a b"), (100, "a b")]
    docs = [(i, rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 20, 60])))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "... !!!"), (63, "THE b a a É é"), (None, "a b"), (63, "again a b"), (64, "x1 " * 5000)]
    df = spark.createDataFrame([(*d, 9, "x") for d in docs], "doc_id long, text string, n_hit int, lang string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for window, blocks in ((4, 1_000_000), (3, 7)):
        got = decontam.decontaminate(df, bench, window=window, block_windows=blocks)
        assert got.columns == ["doc_id", "text", "lang", "n_words", "n_hit", "item_ids", "contaminated"]
        rows = sorted(((str(r["doc_id"]), str(r["text"]), r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in got.collect()))
        assert rows == sorted((str(i), str(t), *brute(t, items, window)) for i, t in docs)
    assert decontam.decontaminate(df.filter("false"), bench, window=4).collect() == []
    none = decontam.decontaminate(df, bench.filter("false"), window=4)
    assert none.filter("contaminated").count() == 0 and none.count() == len(docs)


def test_the_rarest_word_of_a_window_is_its_prefix(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"words": pa.array([b"the the rare of"], pa.binary()), "item_id": [1]}), tmp_path / "part.parquet")
    block = decontam._Block(str(tmp_path))
    block.order({b"the": 900, b"of": 500, b"rare": 2})
    assert block.by_word == {b"rare": {(2, 4)}}
    block.order({b"the": 900, b"of": 500})  # no document has "rare"
    assert block.by_word == {}


def test_many_windows_of_one_rarest_word_are_no_scan(tmp_path):
    import time

    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    windows = [b"rare " + b" ".join(b"w%d" % ((k + j) % 50_000) for j in range(9)) for k in range(50_000)]
    pq.write_table(pa.table({"words": pa.array(windows, pa.binary()), "item_id": range(50_000)}), tmp_path / "part.parquet")
    block = decontam._Block(str(tmp_path))
    block.order({b"rare": 1} | {b"w%d" % k: 2 for k in range(50_000)})
    doc = b" ".join(windows[7] if k % 50 == 0 else b"rare x y" for k in range(5_000)).split(b" ")
    hit, items, begin = np.zeros(len(doc), dtype=bool), set(), time.perf_counter()
    decontam.find_windows(doc, block, hit, items)
    assert time.perf_counter() - begin < 2 and items == {7} and hit.sum() == 1_000


def test_a_window_of_many_items_and_a_block_for_each_worker(spark):
    items = [(k, "one two three four") for k in range(300)] + [(k, f"one two w{k} four") for k in range(300, 600)]
    docs = [(1, "zero one two three four five"), (2, "one two w301 four"), (3, "one two three")]
    marked = decontam.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=4, block_windows=50
    )
    rows = {r["doc_id"]: r for r in marked.collect()}
    assert rows[1]["n_hit"] == 4 and rows[1]["item_ids"] == sorted(map(str, range(300)))
    assert rows[2]["n_hit"] == 4 and rows[2]["item_ids"] == ["301"] and not rows[3]["contaminated"]


def test_blocks_hold_only_their_own_words(spark):
    import glob

    import pyarrow.parquet as pq

    from headway.session import scratch_path

    folder = scratch_path(spark, "blocks")
    items = spark.createDataFrame([(k, f"a{k} b{k} common") for k in range(400)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"a{k} common other{k}") for k in range(0, 400, 2)] * 2, "doc_id long, text string")
    blocks = decontam.write_blocks(decontam.item_windows(items, 3), f"{folder}/windows", 40)
    decontam.write_rarity(docs, f"{folder}/windows", f"{folder}/rarity", len(blocks))
    for k, block in enumerate(blocks):
        held = decontam._Block(block)
        words = {w for x in held.items for w in x.split(b" ")}
        counted = dict(decontam._rows(f"{folder}/rarity/block={k}", ["word", "n"]))
        assert set(counted) <= words and len(held.items) < 100
        assert all(n == (400 if w == b"common" else 2) for w, n in counted.items())
    assert sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{folder.removeprefix('file:')}/windows/*/*.parquet")) == 400


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home widgets">
<header><a href="/">Site name</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies and so on, please accept them all now.</p></div><!-- ad --><div class="ad">Buy this fine thing today</div>
ARTICLE
<aside><p>Something else to read, which is long enough to look like text.</p></aside>
<section id="comments"><div class="comment"><p>I do not agree with this at all, it is a long comment.</p></div></section>
<form><label>Search</label><input></form><footer>&copy; 2020 Someone, all of it</footer><script>var x = "<p>no</p>";</script></body></html>"""

BODY = "<h1>A &amp; B</h1><p><b>First   paragraph\n of the text, with <i>words</i> in it.<br>After a break.</p><p>Be.</p><p>Second&nbsp;one, which is longer than the first one was, by far.<p>Third, unclosed &#233;."
WANT = "A & B\n\nFirst paragraph of the text, with words in it. After a break.\n\nBe.\n\nSecond one, which is longer than the first one was, by far.\n\nThird, unclosed é."


def test_article_and_plain_containers():
    for shell in ("<article>%s</article>", "<main><div>%s</div></main>", '<div class="content"><div id="post">%s</div></div>'):
        assert html.main_text(PAGE.replace("ARTICLE", shell % BODY)) == WANT
    assert html.main_text(PAGE.replace("ARTICLE", "<article>" + BODY).split("<aside")[0]) == WANT  # cut off


def test_layout_classes_and_slug_ids_are_the_articles():
    shells = [
        "<article class='post has-sidebar'>%s</article>",
        "<article class='post' id='related'>%s</article>",
        "<div class='content no-comments'><div>%s</div></div>",
        "<div id='page-with-banner'><div class='post'>%s</div></div>",
        "<div class='widget'><article>%s</article></div>",
        "<div class='overlay'><div>%s</div></div>",
        "<main><div class='sidebar'>%s</div></main>",
    ]
    for shell in shells:
        assert html.main_text(PAGE.replace("ARTICLE", shell % BODY)) == WANT, shell
    parts = "<h2 id='related-work'>Work</h2><section id='menu-design'>Of menus</section><p id='share-prices'>Of prices</p><h2 id='comments'>On it</h2>"
    for shell in ("<article>%s</article>", "<div class='content'><div>%s</div></div>"):
        assert html.main_text(PAGE.replace("ARTICLE", shell % (BODY + parts))) == WANT + "\n\nWork\n\nOf menus\n\nOf prices\n\nOn it"
    replies = "<section id='comments'>" + "<article><p>A reply that is as long as the text itself, or so it seems to be.</p></article>" * 3 + "</section>"
    boxes = "<div class='site-sidebar'>Links</div><div class='ad'>Buy</div><ul class='share-buttons'><li>Send</ul><div class='related-posts'>More</div>"
    assert html.main_text(PAGE.replace("ARTICLE", f"<article>{BODY}{boxes}</article>{replies}")) == WANT


def test_pages_without_an_article_keep_all_of_it():
    long = "a line of the text that goes on and on. " * 60
    blocks = ["<pre>%s</pre>", "<blockquote><p>%s</blockquote>", "<ul><li>%s<li>Item</ul>", "<table><tr><td>%s<td>Cell</table>", "<section><p>%s</section>", "<div>%s</div>"]
    for block in blocks:
        got = html.main_text(PAGE.replace("ARTICLE", "<div class='content'><h1>T</h1><p>Intro</p>" + block % long + "<p>End</p></div>"))
        extra = {"<ul": ["Item"], "<ta": ["Cell"]}.get(block[:3], [])
        assert got == "\n\n".join(["T", "Intro", long.strip(), *extra, "End"]), block
    assert html.main_text(PAGE.replace("ARTICLE", f"<div><h1>T</h1><div class='text'><p>{long}</p><p>End</p></div></div>")) == f"T\n\n{long.strip()}\n\nEnd"
    assert html.main_text(PAGE.replace("ARTICLE", "<h1>T</h1>" + "<div>Menu</div>" * 5 + f"<div><p>{long}</p><p>End</p></div>" + "<div>Menu</div>" * 5)) == f"T\n\n{long.strip()}\n\nEnd"
    part = ("A shorter part of the same text. " * 5).strip()
    two = f"<div id='post'><div class='one'><p>{long}</p><p>Between</p></div><div class='two'><p>Also</p><p>{part}</p><p>End</p></div></div>"
    assert html.main_text(PAGE.replace("ARTICLE", two)).split("\n\n") == [long.strip(), "Between", "Also", part, "End"]


def test_pages_with_little_or_nothing():
    assert html.main_text(None) == html.main_text("") == html.main_text("<p> </p>") == html.main_text("<script>x</script>") == ""
    assert html.main_text("plain text") == "plain text"
    assert html.main_text("<article><p>Be.</p></article><footer>f</footer>") == "Be."
    assert html.main_text("<p>" + "word " * 400_000 + "</p>") == ("word " * 400_000).strip()
    assert html.main_text("<table><tr><td>one<td>two<tr><td>three</table>") == "one\n\ntwo\n\nthree"


def test_smoothing_and_threshold():
    import numpy as np

    flat = html.smooth(np.full(9, 4.0))
    assert np.allclose(flat, 4.0)
    assert 5 < html.threshold(np.array([1.0, 2.0, 1.5, 20.0, 22.0])) < 18
    assert html.threshold(np.array([3.0])) == 3.0


def test_extract_keeps_rows(spark):
    pages = [(1, "u", PAGE.replace("ARTICLE", f"<article>{BODY}</article>")), (2, None, None), (None, "v", ""), (1, "u", "<p>x</p>")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, main_text int")
    got = html.extract(df)
    assert got.columns == ["page_id", "url", "main_text"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "u", WANT), (2, None, ""), (None, "v", ""), (1, "u", "x")]))
    assert html.extract(df.filter("false")).collect() == []
