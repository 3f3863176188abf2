"""Mixing sources to target weights by Poisson replication (native DataFrame functions only).

Every source gets a mean repetition rate ``rate = weight share * target mass /
source mass`` (mass: characters). A document's number of copies is the inverse
of the Poisson distribution function with that mean at a uniform number hashed
from the seed, its id and its text, so it is the same on every run and on every cluster
size, and needs no coordination between tasks. Documents are exploded by
their count and dealt out globally in the order of a second hash, which is a key of the result.

Skew: sources are never a shuffle key (their masses come from a partial
aggregate, their rates are literals), and the copies are dealt by a hash of
(id, copy), so a source with a third of all rows spreads over all tasks.

Large means: a stratum with little text has a large rate (the null stratum
may hold one short row). A mean above ``PART`` is drawn as the sum of Poisson
parts of equal mean, each inverted at a hash of its own, which is exact at any
mean; such documents are exploded in runs of ``RUN`` copies, and the runs are
spread over the tasks before they become rows.

Defined cases: a null or unlisted source belongs to the stratum ``other``,
which shares the weight named "*" (without one, its documents keep the rate
1); a null text has no mass; rows that repeat an id are drawn by id and text,
rows without an id by text and row number, each for itself (rows that repeat
both id and text are drawn alike); a stratum without mass has rate 0; an empty
table gives no rows. Columns named like the added ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.llm.staging import unit_hash, unused

SEED = "mix-17"
OTHER = "*"
PART = 700.0   # largest mean inverted at one hash: exp(-PART) is a normal double
RUN = 4096     # copies of one document that are exploded in one step

#: Registered target: the one large source is held to a fifth, nineteen others share the rest.
TARGET_WEIGHTS = {"src0": 4.0, **{f"src{i}": 0.8 for i in range(1, 20)}, OTHER: 0.8}


def stratum(weights: dict[str, float], column: str = "source") -> Column:
    named = [k for k in weights if k != OTHER]
    return F.when(F.col(column).isin(*named), F.col(column)).otherwise(F.lit(OTHER)) if named else F.lit(OTHER)


def rates(docs: DataFrame, weights: dict[str, float], target_mass: float | None = None,
          column: str = "source", text: str = "text") -> dict[str, float]:
    """Mean repetitions per stratum. At most ``len(weights) + 1`` sums come to the driver."""
    mass = {r["s"]: float(r["m"]) for r in docs.select(
        stratum(weights, column).alias("s"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n"))
        .groupBy("s").agg(F.sum("n").alias("m")).collect()}
    total = target_mass if target_mass is not None else sum(mass.values())
    share = sum(w for k, w in weights.items() if mass.get(k, 0) > 0)
    out = {k: (w / share * total / mass[k] if mass.get(k, 0) > 0 else 0.0) for k, w in weights.items()}
    out.setdefault(OTHER, 1.0)
    return out


def steps(rate: float) -> list[float]:
    """Distribution function of Poisson(rate) at 0, 1, 2, ... until it is 1 to
    52 bits; ``copies`` splits means above ``PART``."""
    if rate <= 0:
        return []
    if rate > PART:
        raise ValueError(f"the mean {rate:.0f} is to be split into parts of at most {PART:.0f}")
    out, term, total, k = [], math.exp(-rate), 0.0, 0
    while k <= rate or term > 2.0 ** -54:
        total += term
        out.append(min(total, 1.0))
        k += 1
        term *= rate / k
    return out


def identity(id_col: str = "doc_id", text: str = "text") -> Column:
    """What a row is drawn by, as text: its id and the MD5 of its text; without an id
    also its row number, which follows from the place in the input's files."""
    row = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id().cast("string")).otherwise(F.lit(""))
    return F.concat_ws("/", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))), row)


def copies(seed: str, doc: Column, which: Column, by_stratum: dict[str, float]) -> Column:
    """Number of copies: how many steps of the stratum's distribution function
    lie at or below the document's hash; summed over parts for a mean above ``PART``."""
    out = F.lit(0).cast("long")
    for name, rate in sorted(by_stratum.items()):
        parts = max(1, math.ceil(rate / PART))
        cdf = F.array(*map(F.lit, steps(rate / parts))) if rate > 0 else None

        def at(unit: Column, cdf=cdf) -> Column:
            return F.size(F.filter(cdf, lambda c: c <= unit)).cast("long")

        if cdf is None:
            n = F.lit(0).cast("long")
        elif parts == 1:
            n = at(unit_hash(seed, doc))
        else:
            every = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
            units = F.transform(every, lambda j: unit_hash(f"{seed}-part", doc, j))
            n = F.aggregate(units, F.lit(0).cast("long"), lambda a, u: a + at(u))
        out = F.when(which == name, n).otherwise(out)
    return out


def mix(docs: DataFrame, weights: dict[str, float] | None = None, target_mass: float | None = None,
        seed: str = SEED, id_col: str = "doc_id", column: str = "source", text: str = "text") -> DataFrame:
    """Columns of ``docs`` plus ``copy_no`` (0, 1, ...), ``n_copies`` and
    ``mix_key`` (the row's place in the global order within its task)."""
    weights = TARGET_WEIGHTS if weights is None else weights
    base = docs.drop("copy_no", "n_copies", "mix_key")
    by = rates(base, weights, target_mass, column, text)
    which, zero = stratum(weights, column), F.lit(0).cast("long")
    own, = unused(base, "drawn_by")
    base = base.withColumn(own, identity(id_col, text))

    def drawn(rows: DataFrame) -> DataFrame:
        return rows.withColumn("n_copies", copies(seed, F.col(own), which, by)).filter("n_copies > 0")

    large = [k for k, rate in by.items() if rate > PART]
    usual = drawn(base.filter(~which.isin(*large)) if large else base)
    out = usual.withColumn("copy_no", F.explode(F.sequence(zero, F.col("n_copies") - 1)))
    if large:
        runs = (drawn(base.filter(which.isin(*large)))
                .withColumn("copy_no", F.explode(F.sequence(zero, F.col("n_copies") - 1, F.lit(RUN).cast("long"))))
                .repartition(F.rand(17)))
        end = F.least(F.col("copy_no") + RUN, "n_copies") - 1
        out = out.unionByName(runs.withColumn("copy_no", F.explode(F.sequence("copy_no", end))))
    out = out.withColumn("mix_key", unit_hash(f"{seed}-order", F.col(own), F.col("copy_no"))).drop(own)
    return out.repartition("mix_key").sortWithinPartitions("mix_key", "copy_no")
