"""Column-expression helpers.

Everything here returns a ``pyspark.sql.Column`` built from JVM-side
functions, so callers stay inside whole-stage codegen. No Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_name(c, collapse_spaces: bool = False) -> Column:
    """H1: non-alphanumerics -> space, trim, upper; optionally collapse runs
    of whitespace afterwards (zones collapse, boroughs do not)."""
    out = F.upper(F.trim(F.regexp_replace(col_or(c), r"[^A-Za-z0-9 ]", " ")))
    if collapse_spaces:
        out = F.regexp_replace(out, r"\s+", " ")
    return out


def similarity(a, b) -> Column:
    """H2: round((1 - levenshtein/max_len) * 100) as int; 0 when both empty."""
    a, b = col_or(a), col_or(b)
    max_len = F.greatest(F.length(a), F.length(b))
    return (
        F.when(max_len == 0, F.lit(0))
        .otherwise(F.round((F.lit(1) - F.levenshtein(a, b) / max_len) * 100).cast("int"))
    )


def max_edits_for(length_col: Column, threshold: int) -> Column:
    """Largest edit distance a pair whose longer name has ``length_col``
    characters may have and still score >= ``threshold``.

    score >= T  <=>  (1 - d/L) * 100 >= T - 0.5  <=>  d <= L * (100.5 - T) / 100
    Computed in integers: d <= floor(L * (201 - 2T) / 200).
    """
    return F.floor(length_col * F.lit(201 - 2 * threshold) / F.lit(200)).cast("int")


def record_hash(*cols) -> Column:
    """H7: md5 of the '|'-joined attributes, NULL read as ''."""
    return F.md5(F.concat_ws("|", *[F.coalesce(col_or(c).cast("string"), F.lit("")) for c in cols]))


def fill_rate(c) -> Column:
    """Share of non-null values (avg of a 0/1 flag); NULL on empty input."""
    return F.avg(col_or(c).isNotNull().cast("int"))


def flag_sum(cond: Column) -> Column:
    """SUM(cond::INT): skips NULL comparisons and is NULL on empty input
    (unlike count_if, which returns 0) — the warehouse metric semantics."""
    return F.sum(cond.cast("int"))


def as_rate(c: Column) -> Column:
    """NUMERIC(10,6) rate as stored by the warehouse metrics."""
    return c.cast("decimal(10,6)")
