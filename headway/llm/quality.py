"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects a document whose measure exceeds the rule's cutoff for the
document's stratum.  Cutoffs come from labelled holdouts: of the good rows of a
stratum, the exact (Clopper-Pearson) upper bound on the share that a cutoff
rejects must be within the rule's part of the allowed risk.  The bound is within
it exactly if a binomial variable of that risk is at most the observed number of
rejections with a probability of no more than the error; the error is divided by
the number of tests (strata x rules x cutoffs).  Of the cutoffs that pass, the
one that rejects most bad rows for the good ones that it costs is taken, the
mildest of equals; where none passes or helps, the rule is off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import written

#: Allowed share of good documents that the rules of a stratum reject together, and the chance that it is exceeded anywhere.
RISK = 0.03
ERROR = 0.05
#: A rejected good row weighs as much as so many rejected bad ones.
GOOD_COST = 10
#: The rules' measures, and the cutoffs that are tried for each.
RULES = ["symbol_share", "dup_line_share", "repeat_share", "capital_share", "echo_share"]
CUTOFFS = [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
WINDOW = 5
#: Ends the sum of a binomial tail when its terms no longer count.
TAIL_TERMS = 60

_SPACES = " \t\n\u000b\f\r"
_SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measure(docs: DataFrame, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all by default) with the counts of the rules.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_lines`` (with a word), ``n_dup_lines`` (equal to an earlier one),
    ``n_repeat_words`` (words in 5-word windows that the text has twice or more),
    ``n_capitals`` and ``n_echoes`` (words equal to the one before).  Null and
    empty texts have counts of 0.  Every row is measured alone; input columns
    with these names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_echoes"]
    kept = [c for c in (docs.columns if carry is None else carry) if c not in names]
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t\\x0B\\f\\r]"))
    split = docs.select(
        *kept,
        (F.length(text) - _without(text, _SPACES)).cast("long").alias("word_chars"),
        _without(text, _SYMBOLS).cast("long").alias("n_symbols"),
        _without(text, _CAPITALS).cast("long").alias("n_capitals"),
        lines.alias("_hw_lines"),
        F.transform(F.array_remove(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), ""), lambda x: F.xxhash64(x)).alias("_hw_words"),
    )
    size = F.size("_hw_words")
    at = F.sequence(F.lit(0), size - WINDOW)
    windows = F.transform(at, lambda i: F.xxhash64(*[F.get("_hw_words", i + k) for k in range(WINDOW)]))
    pairs = F.sequence(F.lit(1), size - 1)
    hashed = split.select(
        *kept,
        "word_chars",
        "n_symbols",
        "n_capitals",
        F.size("_hw_lines").cast("long").alias("n_lines"),
        (F.size("_hw_lines") - F.size(F.array_distinct("_hw_lines"))).cast("long").alias("n_dup_lines"),
        size.cast("long").alias("n_words"),
        F.when(size >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("_hw_windows"),
        F.when(size > 1, F.size(F.filter(pairs, lambda i: F.get("_hw_words", i) == F.get("_hw_words", i - 1)))).otherwise(0).cast("long").alias("n_echoes"),
    )
    # only a text with a repeated window has its windows sorted
    repeated = F.size(F.array_distinct("_hw_windows")) < F.size("_hw_windows")
    ordered = F.array_sort(F.transform("_hw_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    listed = hashed.select("*", F.when(repeated, ordered).alias("_hw_sorted")).drop("_hw_windows")
    same = lambda a, k: F.get("_hw_sorted", k)["h"] == a["h"]
    places = F.array_sort(
        F.array_compact(
            F.transform("_hw_sorted", lambda a, k: F.when(F.coalesce(same(a, k - 1), F.lit(False)) | F.coalesce(same(a, k + 1), F.lit(False)), a["i"]))
        )
    )
    placed = listed.select("*", places.alias("_hw_places")).drop("_hw_sorted")
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        "_hw_places",
        start,
        lambda acc, p: F.struct((p + WINDOW).alias("end"), (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n")),
        lambda acc: acc["n"],
    )
    return placed.select(*kept, *[F.coalesce(covered, F.lit(0).cast("long")).alias(n) if n == "n_repeat_words" else F.col(n) for n in names])


def base_failed() -> Column:
    """The fixed rules: fewer than 10 words, or more than a fifth of the words repeated."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _shares() -> dict[str, Column]:
    share = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)).cast("double")
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "capital_share": share("n_capitals", "word_chars"),
        "echo_share": share("n_echoes", "n_words"),
    }


def _log_gamma(x: Column) -> Column:
    """log Gamma(x) for x >= 1: Stirling's series at x + 8, brought back by the recurrence."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return series - sum((F.log(x + k) for k in range(1, 8)), F.log(x))


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p) where k < n p; 1 elsewhere.

    Summed downwards from k; the terms fall at least as fast as a geometric
    series, whose rest after the last summed term is added as an upper bound.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    odds = (1 - p) / p
    ratio = k * odds / (n - k + 1)
    # so many terms that the rest is far below the first
    terms = F.least(k, F.ceil(F.lit(TAIL_TERMS) / (1 - F.least(ratio, F.lit(0.9999))))).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), terms),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, j: F.struct((acc["term"] * (k - j) * odds / (n - k + j + 1)).alias("term"), (acc["sum"] + acc["term"]).alias("sum")),
        lambda acc: acc["sum"] + F.greatest(acc["term"], F.lit(0.0)) / (1 - F.least(ratio, F.lit(0.9999))),
    )
    return F.when(k < n * p, F.least(top * total, F.lit(1.0))).otherwise(1.0)


def cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    stratum_col: str = "lang",
    label_col: str = "quality",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """``stratum`` and, for each rule, the cutoff ``_hw_<rule>_cut`` (null: off); one row for each stratum with labels.

    Rows that fail the base rules, or whose label or id is null, are left out; of
    several labels of an id the smallest counts.  A null stratum is a stratum of
    its own (the empty string is, too, and joins it).
    """
    known = (
        labels.filter(F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg((F.min(label_col) > 0).alias("_good"))
    )
    rows = measured.filter(~base_failed()).select(F.col(id_col).alias("_id"), _stratum(stratum_col), *[c.alias(r) for r, c in _shares().items()]).join(known, "_id")
    tried = [(r, c) for r in RULES for c in CUTOFFS]
    good, bad = F.col("_good"), ~F.col("_good")
    counted = rows.groupBy("stratum").agg(
        F.count(F.when(good, 1)).alias("n"),
        F.array(
            *[
                F.struct(
                    F.lit(r).alias("rule"),
                    F.lit(c).alias("cutoff"),
                    F.count(F.when(good & (F.col(r) > c), 1)).alias("k"),
                    F.count(F.when(bad & (F.col(r) > c), 1)).alias("hits"),
                )
                for r, c in tried
            ]
        ).alias("tests"),
    )
    strata = F.count("*").over(Window.partitionBy())  # over a row for each stratum
    each = counted.withColumn("strata", strata).select("stratum", "n", "strata", F.explode("tests").alias("t")).select("stratum", "n", "strata", "t.*")
    allowed = F.lit(error) / (F.col("strata") * len(tried))
    passed = each.filter(binomial_at_most(F.col("k"), F.col("n"), risk / len(RULES)) <= allowed)
    gain = F.col("hits") - GOOD_COST * F.col("k")
    best = F.max(F.when(gain > 0, F.struct(gain.alias("gain"), F.col("cutoff").alias("cutoff"))))["cutoff"]
    chosen = passed.groupBy("stratum", "rule").agg(best.alias("cutoff"))
    return chosen.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_hw_{r}_cut") for r in RULES])


def _stratum(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias("stratum")


def judge(measured: DataFrame, chosen: DataFrame, *, stratum_col: str = "lang") -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``; ``chosen`` has a row for each stratum."""
    over = F.lit(False)
    for rule, share in _shares().items():
        over = over | F.coalesce(share > F.col(f"_hw_{rule}_cut"), F.lit(False))
    names = [c for c in measured.columns if c not in ("base_failed", "kept")]
    cuts = chosen.withColumnRenamed("stratum", "_hw_cut_stratum")
    joined = measured.withColumn("_hw_stratum", _stratum(stratum_col)).join(cuts, F.col("_hw_stratum") == F.col("_hw_cut_stratum"), "left")
    return joined.select(*names, base_failed().alias("base_failed"), (~base_failed() & ~over).alias("kept"))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    risk: float = RISK,
    error: float = ERROR,
    carry: list[str] | None = None,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all by default) with the counts, ``base_failed`` and ``kept``.

    The measures are kept in the shared folder, so that every text is read once.
    """
    names = docs.columns if carry is None else carry
    measured = written(measure(docs, text_col=text_col, carry=list(dict.fromkeys([*names, id_col, stratum_col]))), "measures")
    chosen = cutoffs(measured, labels, id_col=id_col, stratum_col=stratum_col, label_col=label_col, risk=risk, error=error)
    judged = judge(measured, written(chosen, "cutoffs"), stratum_col=stratum_col)
    return judged.drop(*{id_col, stratum_col}.difference(names))
