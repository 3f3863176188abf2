"""Quality rules with risk-controlled cutoffs (native DataFrame functions only).

Every rule gives a score per document (more is worse). A labelled holdout
selects, per stratum and rule, the strictest cutoff whose false-rejection rate
among good documents is provably small: cutoffs are tested from the loosest to
the strictest with the exact binomial tail ``P(Bin(n, alpha_r) <= k)``, and the
sequence stops at the first that fails (fixed-sequence testing, so the cutoffs
of one rule need no correction). ``delta`` is split evenly over all (stratum,
rule) sequences and ``alpha`` over the rules (Bonferroni both times): with
probability 1 - delta, no stratum loses more than ``alpha`` of its good
documents to all rules together.

Defined cases: a null text has no words (all counts 0, ``base_failed``);
lines, words and windows are counted over the whole text; a null or unlisted
stratum value is the stratum ``other``; a stratum or rule without enough
labels has no cutoff and rejects nothing; contradicting labels of one id count
as good; an empty table gives no rows; other columns are carried by
``features`` untouched unless they clash with a feature's name, in which case
the feature wins.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.llm.staging import staged, unused

SPACE_CHARS = (" ", "\t", "\n", "\x0b", "\f", "\r")
SYMBOLS = "#*$%&|<>"

#: Strata of the registered query: listed languages, everything else "other".
STRATA = ("en", "de", "fr", "es")
ALPHA = 0.10   # most good documents of a stratum that may be rejected
DELTA = 0.05   # probability that any of the bounds fails

RATIO_GRID = (0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01)
#: rule -> (score, cutoffs from the loosest to the strictest)
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", RATIO_GRID),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", RATIO_GRID),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", RATIO_GRID),
    "word_length": ("word_chars / greatest(n_words, 1)", (40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 13.0, 12.0,
                                                          11.0, 10.0, 9.0, 8.0)),
}


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` but with the rule inputs ``n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words`` (long).

    A word of a 3-word window that occurs twice or more in its text counts
    once. Windows are found in two steps inside the row: window hashes whose
    low bits hold the position are sorted, neighbours with equal high bits are
    candidates, and candidates are compared as strings, so the count is exact."""
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    t = F.coalesce(F.col(text), F.lit(""))
    keep = [c for c in docs.columns if c not in names and c != text]
    # own columns: text, words, their number, hashes, hash mask, windows, candidates, compared ones, places, lines
    own = dict(zip("twnhmscepl", unused(docs, *(f"q_{x}" for x in "twnhmscepl"))))
    e = lambda sql: F.expr(re.sub(r"\b_([a-z])\b", lambda m: f"`{own[m.group(1)]}`", sql))
    d = docs.select(*keep, t.alias(own["t"]))
    # words: other white space becomes a space, empty pieces between spaces go
    spaced = reduce(lambda c, ch: F.replace(c, F.lit(ch), F.lit(" ")), SPACE_CHARS[1:], F.col(own["t"]))
    d = d.withColumn(own["w"], F.array_remove(F.split(spaced, " "), ""))
    d = d.withColumn(own["n"], F.coalesce(F.size(own["w"]), F.lit(0)))
    d = d.withColumn(own["h"], e("transform(_w, x -> xxhash64(x))"))
    # a window's hash with its position in the low bits; _m masks the hash part
    d = d.withColumn(own["m"], e(
        "coalesce(shiftleft(-1L, cast(ceil(log2(_n + 2)) as int)), -1L)"))
    d = d.withColumn(own["s"], e(
        "CASE WHEN _n < 3 THEN cast(array() as array<bigint>) ELSE sort_array(transform("
        "zip_with(zip_with(slice(_h, 1, _n - 2), slice(_h, 2, _n - 2), (a, b) -> xxhash64(a, b)), "
        "slice(_h, 3, _n - 2), (a, b) -> xxhash64(a, b)), (x, i) -> (coalesce(x, 0L) & _m) + i)) END"))
    # candidates: neighbours in hash order with equal hash parts
    d = d.withColumn(own["c"], e(
        "CASE WHEN _n < 4 THEN cast(array() as array<bigint>) ELSE array_distinct(flatten(filter("
        "zip_with(slice(_s, 1, _n - 3), slice(_s, 2, _n - 3), "
        "(a, b) -> CASE WHEN ((a ^ b) & _m) = 0 THEN array(a, b) END), x -> x IS NOT NULL))) END"))
    d = d.withColumn(own["e"], e(
        "array_sort(transform(transform(_c, v -> cast(v & ~_m as int)), "
        "p -> named_struct('g', slice(_w, p + 1, 3), 'p', p)))"))
    d = d.withColumn(own["p"], e(
        "sort_array(transform(filter(_e, (x, j) -> x.g <=> get(_e, j + 1).g OR (j > 0 AND x.g <=> get(_e, j - 1).g)), "
        "x -> x.p))"))
    d = d.withColumn(own["l"], e(rf"filter(split(_t, '\n'), x -> btrim(x, ' \t\n\u000B\f\r') <> '')"))
    return d.select(
        *keep,
        F.col(own["n"]).cast("long").alias("n_words"),
        F.char_length(F.array_join(own["w"], "")).cast("long").alias("word_chars"),
        F.regexp_count(own["t"], F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size(own["l"]).cast("long").alias("n_lines"),
        (F.size(own["l"]) - F.size(F.array_distinct(own["l"]))).cast("long").alias("n_dup_lines"),
        e("aggregate(transform(_p, (p, j) -> least(3, coalesce(get(_p, j + 1) - p, 3))), 0L, (a, x) -> a + x)")
         .alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum(column: str, strata) -> Column:
    return F.when(F.col(column).isin(*strata), F.col(column)).otherwise(F.lit("other"))


def binomial_tail(n: str, k: str, p: float) -> Column:
    """Exact ``P(Bin(n, p) <= k)``, summed in log space; 1 where k >= n * p
    (the tail is then about a half or more, and no test at a small level can
    pass)."""
    logit = f"(ln({p!r}) - ln(1 - {p!r}))"
    return F.expr(f"""
      CASE WHEN {k} >= {n} * {p!r} THEN 1D ELSE
        aggregate(CASE WHEN {k} = 0 THEN cast(array() as array<bigint>) ELSE sequence(0L, {k} - 1) END,
          named_struct('t', {n} * ln(1 - {p!r}), 's', {n} * ln(1 - {p!r})),
          (a, j) -> named_struct(
            't', a.t + ln(({n} - j) / (j + 1D)) + {logit},
            's', greatest(a.s, a.t + ln(({n} - j) / (j + 1D)) + {logit})
                 + ln(1 + exp(-abs(a.s - (a.t + ln(({n} - j) / (j + 1D)) + {logit}))))),
          a -> exp(a.s)) END""")


def cutoffs(scored: DataFrame, labels: DataFrame, strata=STRATA, stratum_col: str = "lang", id_col: str = "doc_id",
            alpha: float = ALPHA, delta: float = DELTA, rules=RULES) -> DataFrame:
    """(stratum, rule, n_good, cutoff, false_rejections, p_value): one row per
    stratum with labels and rule; ``cutoff`` is null where no cutoff can be
    guaranteed. ``scored`` has the columns of ``features``; only documents
    that pass the base rules are counted, as only those can be rejected."""
    good = (labels.groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_q")).filter("_q = 1").select("_id"))
    rows = (scored.filter(~base_failed()).select(F.col(id_col).alias("_id"), stratum(stratum_col, strata).alias("stratum"),
                                                 *(F.expr(s).alias(f"_r_{r}") for r, (s, _) in rules.items()))
            .join(good, "_id", "left_semi"))
    counts = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *(
        F.sum((F.col(f"_r_{r}") > c).cast("long")).alias(f"_k_{r}_{i}")
        for r, (_, grid) in rules.items() for i, c in enumerate(grid)))
    cells = counts.select("stratum", "n_good", F.explode(F.array(*(
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"),
                 F.col(f"_k_{r}_{i}").alias("k")) for r, (_, grid) in rules.items() for i, c in enumerate(grid))
    )).alias("c")).select("stratum", "n_good", "c.*")
    level = delta / ((len(strata) + 1) * len(rules))
    tested = cells.withColumn("p_value", binomial_tail("n_good", "k", alpha / len(rules)))
    # the strictest cutoff before the first failure
    first_failure = F.coalesce(F.min(F.when(F.col("p_value") > level, F.col("step"))), F.lit(1 << 30))
    stops = tested.groupBy("stratum", "rule").agg(first_failure.alias("stop"))
    return (tested.join(stops, ["stratum", "rule"]).groupBy("stratum", "rule", "n_good")
            .agg(F.max(F.when(F.col("step") < F.col("stop"), F.struct("step", "cutoff", "k", "p_value"))).alias("m"))
            .select("stratum", "rule", "n_good", F.col("m.cutoff").alias("cutoff"),
                    F.col("m.k").alias("false_rejections"), F.col("m.p_value").alias("p_value")))


def verdicts(scored: DataFrame, chosen: DataFrame, strata=STRATA, stratum_col: str = "lang", rules=RULES) -> DataFrame:
    """``scored`` with ``base_failed`` and ``kept``. ``chosen`` (from
    ``cutoffs``) has at most (strata + 1) * rules rows, a bound given by the
    parameters, so it is broadcast."""
    which, *names = unused(scored, "stratum", *(f"cut_{r}" for r in rules))
    wide = chosen.groupBy(F.col("stratum").alias(which)).agg(*(
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(n) for r, n in zip(rules, names)))
    over = reduce(lambda a, b: a | b, (F.coalesce(F.expr(s) > F.col(n), F.lit(False)) for n, (s, _) in zip(names, rules.values())))
    d = scored.withColumn(which, stratum(stratum_col, strata)).join(F.broadcast(wide), which, "left")
    d = d.withColumn("base_failed", base_failed())
    return d.withColumn("kept", ~F.col("base_failed") & ~over).drop(which, *names)


def quality_rules(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """Rule inputs, ``base_failed`` and ``kept`` per row of ``docs`` (text left out)."""
    scored = staged(features(docs), "rule-features")
    chosen = cutoffs(scored, labels, **params)
    shared = {k: v for k, v in params.items() if k in ("strata", "stratum_col", "rules")}
    return verdicts(scored, staged(chosen, "rule-cutoffs"), **shared)
