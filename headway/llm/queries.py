"""The registered queries of the training-data operators, and their SQL.

Each applies its operator to its whole table; digests of what an operator puts
out are taken from that output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import automaton, decontam, html, licenses, packing, partenum, quality, ranked, spelling, tokens, toxicity, urls, warc
from headway.llm.common import read_table, scratch_path

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"

#: host, path, verdict
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), capacity=1024, end_id=2, digests=True)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "tokens")
    tokens.write_token_files(docs, folder, public_tokenizers.path(TOKENIZER), seq_len=1024, end_id=0)
    return tokens.read_documents(spark, folder, digests=True)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder, min_bytes=1000)
    chunks = warc.read_archives(spark, folder, data=False)
    return chunks.filter("is_last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False))
    scored = toxicity.score(docs, model, carry=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    judged = quality.quality_rules(docs, read_table(spark, sf_dir, "labels"), carry=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    manifest = urls.write_rules(rules, scratch_path(spark, "url-rules"))
    return urls.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), manifest).drop("url")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontam.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    n_items, digest = F.size("item_ids").cast("long"), decontam.items_digest(F.col("item_ids"))
    return marked.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), digest.alias("items_sha256"), "contaminated")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(read_table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_groups(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return automaton.encode_documents(docs, public_tokenizers.path(WORD_TOKENIZER), digests=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_best_fit_packing,
        op2_token_files,
        op3_warc,
        op4_license_scan,
        op5_toxicity,
        op6_quality_rules,
        op7_url_filter,
        op8_decontamination,
        op9_html_extraction,
        op10_ngram_jaccard,
        op11_ranked_search,
        op12_spelling_variants,
        op13_bpe_automaton,
    ]
    return {f.__name__: f for f in named}


_WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), g AS (
  SELECT payload, max(page_id) AS target FROM p WHERE payload_bytes >= 1000 GROUP BY payload
)
SELECT page_id, payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM target THEN target END AS refers_to
FROM p LEFT JOIN g ON p.payload = g.payload
"""


def _license_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    spelling = "MAP {" + ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in licenses.EQUIVALENT.items()) + "}"
    known = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in licenses.KNOWN_TEXTS)
    return f"""
WITH units AS (
  SELECT doc_id, true AS whole, text AS unit FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, false, unnest(string_split(text, chr(10))) FROM documents
  UNION ALL SELECT NULL, NULL, text FROM (VALUES {known}) k(license, text)
), forms AS (
  SELECT *, array_to_string(list_transform(string_split(trim(regexp_replace(replace(
      regexp_replace(lower(unit), {quoted(licenses.COPYRIGHT_LINE)}, '', 'g'), '&', ' and '),
      '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '),
      lambda w: coalesce(({spelling})[w], w)), ' ') AS form
  FROM units
), known AS (
  SELECT DISTINCT license, form FROM (VALUES {known}) k(license, text) JOIN forms ON forms.whole IS NULL AND forms.unit = k.text
  WHERE form <> ''
), found AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) FILTER (WHERE NOT whole) AS n_notices,
         bool_or(whole) AS whole_text
  FROM forms JOIN known USING (form) WHERE whole IS NOT NULL GROUP BY doc_id
)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(n_notices, 0) AS n_notices, coalesce(whole_text, false) AS whole_text
FROM documents d LEFT JOIN found f ON d.doc_id IS NOT DISTINCT FROM f.doc_id
"""


def _quality_sql(documents: str = "documents") -> str:
    """The counts, the exact binomial tests and the verdicts."""
    shares = {
        "symbol_share": "n_symbols / greatest(word_chars, 1)::DOUBLE",
        "dup_line_share": "n_dup_lines / greatest(n_lines, 1)::DOUBLE",
        "repeat_share": "n_repeat_words / greatest(n_words, 1)::DOUBLE",
        "capital_share": "n_capitals / greatest(word_chars, 1)::DOUBLE",
        "echo_share": "n_echoes / greatest(n_words, 1)::DOUBLE",
    }
    tests = ", ".join(f"('{r}', {c})" for r in quality.RULES for c in quality.CUTOFFS)
    n_tests = len(quality.RULES) * len(quality.CUTOFFS)
    share = "CASE rule " + " ".join(f"WHEN '{r}' THEN {r}" for r in quality.RULES) + " END"
    p = quality.RISK / len(quality.RULES)
    tail = f"""list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
        + i * ln({p}) + (n - i) * ln(1 - {p}))))"""
    return f"""
WITH words AS (
  SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {documents}
), lines AS (
  SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM words) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY id
), places AS (
  SELECT id, i, w[i:i + 4] AS win, len(w) AS n FROM words, unnest(range(1, len(w) - 3)) r(i)
), twice AS (
  SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, win) AS c FROM places) WHERE c > 1
), repeated AS (
  SELECT id, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(0, 5) s(j) GROUP BY id
), measures AS (
  SELECT words.id, doc_id, coalesce(lang, '') AS stratum, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes
  FROM words LEFT JOIN lines USING (id) LEFT JOIN repeated USING (id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         {', '.join(f'{e} AS {r}' for r, e in shares.items())}
  FROM measures
), holdout AS (
  SELECT stratum, good, {', '.join(quality.RULES)} FROM judged
  JOIN (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l USING (doc_id)
  WHERE NOT base_failed
), tests AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND {share} > cutoff) AS k,
         count(*) FILTER (WHERE NOT good AND {share} > cutoff) AS hits,
         (SELECT count(DISTINCT stratum) FROM holdout) AS strata
  FROM holdout, (VALUES {tests}) t(rule, cutoff) GROUP BY ALL
), passed AS (
  SELECT stratum, rule, cutoff, hits - {quality.GOOD_COST} * k AS gain FROM tests
  WHERE k < n * {p} AND {tail} <= {quality.ERROR} / (strata * {n_tests})
), chosen AS (
  SELECT stratum, rule, cutoff FROM passed WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1
), over AS (
  SELECT DISTINCT id FROM judged JOIN chosen USING (stratum) WHERE {share} > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND id NOT IN (SELECT id FROM over) AS kept
FROM judged
"""


def _url_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
WITH u AS (
  SELECT row_number() OVER () AS id, page_id,
         CASE WHEN contains(url, '://') THEN url[position('://' IN url) + 3:] ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT id, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), best AS (
  SELECT p.id, r.host || r.path AS rule, verdict
  FROM p JOIN (VALUES {rules}) r(host, path, verdict)
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY length(r.host || r.path) DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (id)
"""


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAM_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS win FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) r(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT len(win) AS size FROM windows
), places AS (
  SELECT id, i, size, w[i:i + size - 1] AS win FROM d, sizes, unnest(range(1, len(w) - size + 2)) r(i)
), hits AS (
  SELECT id, i, size, item_id FROM places JOIN windows USING (win)
), hit_words AS (
  SELECT id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(0, size)) s(j) GROUP BY id
), hit_items AS (
  SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT id, item_id::VARCHAR AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (id) LEFT JOIN hit_items USING (id)
"""


def _jaccard_sql(documents: str = "documents") -> str:
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {documents}
), shingles AS (
  SELECT DISTINCT doc_id, w[i:i + 4] AS s FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) r(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, (SELECT min(b) FROM reach WHERE a = d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id)
"""


_RANKED_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), b AS (
  SELECT row_number() OVER () AS item, item_id, list_distinct({_WORDS.format("coalesce(text, '')")}) AS w FROM benchmark
), sizes AS (
  SELECT id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0
), total AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), tfs AS (
  SELECT id, term, count(*)::BIGINT AS tf FROM (SELECT id, unnest(w) AS term FROM d) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tfs, total GROUP BY term
), scores AS (
  SELECT item, item_id, id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM (SELECT item, item_id, unnest(w) AS term FROM b) JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (id), total
  GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
FROM scores JOIN d USING (id) WHERE score > 0 QUALIFY rank <= 10
"""

# crc32 by its definition: a table of 256 entries, then a byte at a time.
_SPELLING_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents
  ) WHERE length(run) >= {spelling.LEAST_LENGTH} GROUP BY ALL
), summed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id || ':' || run, ''),
           lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT] ELSE [192 + (unicode(s) >> 6), 128 + (unicode(s) & 63)] END))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, crc
), vocabulary AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {spelling.DELETES} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k FROM summed
  ) WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {spelling.LEAST_COUNT}
), holes AS (
  SELECT word, n, word[:i] || ' ' || word[i + 2:] AS hole FROM vocabulary, unnest(range(0, length(word))) r(i)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT v.word, h.word, h.n FROM vocabulary v JOIN holes h ON v.word = replace(h.hole, ' ', '')
  UNION SELECT h.word, v.word, v.n FROM vocabulary v JOIN holes h ON v.word = replace(h.hole, ' ', '')
), counted AS (
  SELECT word, count(*) AS n_near, arg_min(struct_pack(other, n), struct_pack(less := -n, other)) AS best FROM near GROUP BY word
), judged AS (
  SELECT word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best.n >= {spelling.FORM_RATIO} * v.n THEN best END AS form
  FROM vocabulary v LEFT JOIN counted USING (word)
), paths AS (
  SELECT word, word AS root FROM judged
  UNION ALL SELECT paths.word, judged.form.other FROM paths JOIN judged ON judged.word = paths.root WHERE judged.form IS NOT NULL
)
SELECT judged.word, form.other AS form, root, judged.n, n_near, form.n AS form_n
FROM judged JOIN paths USING (word) JOIN (SELECT word AS root FROM judged WHERE form IS NULL) USING (root)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": _WARC_SQL,
        "op4_license_scan": _license_sql(),
        "op6_quality_rules": _quality_sql(),
        "op7_url_filter": _url_sql(),
        "op8_decontamination": _DECONTAM_SQL,
        "op10_ngram_jaccard": _jaccard_sql(),
        "op11_ranked_search": _RANKED_SQL,
        "op12_spelling_variants": _SPELLING_SQL,
    }
