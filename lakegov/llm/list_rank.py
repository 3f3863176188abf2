"""Distributed list ranking by contraction.

``rank`` takes the cells of one linked list, each with its successor and a
vector of weights, and returns for each cell the sum of the weights before it.
Cells are dealt by ranges of their ids; every task walks the pieces of the list
that lie whole among its cells and replaces each by one cell (head of the
piece, successor of its end, summed weights). Where ids lie scattered along the
list, a round of random mates also joins cells over tasks: of two neighbours,
one with coin 0 takes in its successor with coin 1, a quarter of all cells on
average. This repeats on the contracted list until one task holds at most
``rows`` cells; then the sums are handed back level by level.

No task holds more than about ``rows`` cells at any level, and the levels
shrink geometrically, so the rows moved in total are a small multiple of the list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegov.llm.scan import parts_for
from lakegov.llm.staging import map_arrow, staged

ROWS = 100_000
POOR = 0.6      # a level that keeps more than this share of the cells is followed by random mates


def pieces(c: np.ndarray, k: np.ndarray, nc: np.ndarray, nk: np.ndarray, has_next: np.ndarray,
           weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the head of each cell's piece, weights before the cell in its
    piece, index of the piece's end) for the cells (c, k) of one task with
    successors (nc, nk); pointers are doubled, so a piece of m cells takes log m steps."""
    n = len(c)
    conv = np.unique(c)
    key = (np.searchsorted(conv, c).astype(np.int64) << 33) | k
    at = np.searchsorted(conv, nc)
    known = has_next & (at < len(conv))
    known[known] = conv[at[known]] == nc[known]
    order = np.argsort(key, kind="stable")
    wanted = (at.astype(np.int64) << 33) | nk
    spot = np.minimum(np.searchsorted(key[order], wanted), n - 1)
    succ = order[spot]
    known &= key[succ] == wanted
    pred = np.full(n, -1, np.int64)
    pred[succ[known]] = np.flatnonzero(known)
    before = np.zeros_like(weights)
    inner = pred >= 0
    before[inner] = weights[pred[inner]]
    head = np.where(inner, pred, np.arange(n))
    while True:
        further = head[head]
        if np.array_equal(further, head):
            break
        before = before + np.where((further != head)[:, None], before[head], 0)
        head = further
    end = np.zeros(n, np.int64)
    end[head[~known]] = np.flatnonzero(~known)
    return head, before, end


def _contract(cells: DataFrame, parts: int, names: list[str]) -> DataFrame:
    """Per cell (c, k) its piece's head (hc, hk), the weights before it in the
    piece, and on heads the piece's successor and total."""
    total = [f"t_{w}" for w in names]
    schema = ", ".join(["c long, k long, hc long, hk long", *(f"b_{w} long" for w in names),
                        "nc long, nk long", *(f"{t} long" for t in total), "is_head boolean"])

    def run(batches):
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        t = pa.Table.from_batches(batches)
        c, k = t["c"].to_numpy(), t["k"].to_numpy()
        has = t["nc"].is_valid().to_numpy()
        nc, nk = (t[x].fill_null(0).to_numpy() for x in ("nc", "nk"))
        w = np.stack([t[x].to_numpy() for x in names], axis=1)
        head, before, end = pieces(c, k, nc, nk, has, w)
        is_head = head == np.arange(len(c))
        tail = end[head]
        sums = before[tail] + w[tail]
        out = {"c": c, "k": k, "hc": c[head], "hk": k[head], **{f"b_{x}": before[:, i] for i, x in enumerate(names)}}
        out |= {"nc": pa.array(nc[tail], mask=~has[tail]), "nk": pa.array(nk[tail], mask=~has[tail])}
        out |= {x: sums[:, i] for i, x in enumerate(total)} | {"is_head": is_head}
        yield from pa.table({n: pa.array(v) if isinstance(v, np.ndarray) else v for n, v in out.items()}).to_batches(20_000)

    return map_arrow(cells.repartitionByRange(parts, "c", "k").sortWithinPartitions("c", "k"), run, schema)


def _mates(cells: DataFrame, names: list[str], level: int) -> tuple[DataFrame, DataFrame]:
    """(contracted cells, (c, k, hc, hk, b_...) of the cells taken in)."""
    coin = lambda c, k: F.pmod(F.xxhash64(F.lit(level), c, k), F.lit(2))
    heads = cells.filter(coin(F.col("c"), F.col("k")) == 0)
    tails = cells.filter(coin(F.col("c"), F.col("k")) == 1).select(*(F.col(x).alias(f"r_{x}") for x in cells.columns))
    both = staged(heads.join(tails, (F.col("nc") == F.col("r_c")) & (F.col("nk") == F.col("r_k")), "full_outer"), "mates")
    pair = F.col("c").isNotNull() & F.col("r_c").isNotNull()
    own = F.col("c").isNotNull()
    after = lambda x: F.when(pair | ~own, F.col(f"r_{x}")).otherwise(F.col(x))
    joined = both.select(
        F.when(own, F.col("c")).otherwise(F.col("r_c")).alias("c"), F.when(own, F.col("k")).otherwise(F.col("r_k")).alias("k"),
        after("nc").alias("nc"), after("nk").alias("nk"),
        *((F.coalesce(w, F.lit(0)) + F.coalesce(f"r_{w}", F.lit(0))).cast("long").alias(w) for w in names))
    taken = both.filter(pair).select(F.col("r_c").alias("c"), F.col("r_k").alias("k"), F.col("c").alias("hc"),
                                     F.col("k").alias("hk"), *(F.col(w).alias(f"b_{w}") for w in names))
    return joined, taken


def _hand_back(inner: DataFrame, ranks: DataFrame, names: list[str]) -> DataFrame:
    r = ranks.select(F.col("c").alias("hc"), F.col("k").alias("hk"), *(F.col(w).alias(f"r_{w}") for w in names))
    return inner.join(r, ["hc", "hk"]).select("c", "k", *((F.col(f"b_{w}") + F.col(f"r_{w}")).alias(w) for w in names))


def rank(cells: DataFrame, names: list[str], rows: int = ROWS, level: int = 0) -> DataFrame:
    """(c, k, weights before the cell from the head of the list on). ``cells``:
    (c, k) the cell's id, (nc, nk) its successor or nulls, long weights ``names``."""
    cells = staged(cells, f"list-{level}")
    n = cells.count()
    parts = parts_for(n, rows)
    mapped = staged(_contract(cells, parts, names), f"pieces-{level}")
    if parts == 1:
        return mapped.select("c", "k", *(F.col(f"b_{w}").alias(w) for w in names))
    rest = mapped.filter("is_head").select("c", "k", "nc", "nk", *(F.col(f"t_{w}").alias(w) for w in names))
    if rest.count() > POOR * n:
        joined, taken = _mates(rest, names, level)
        ranks = rank(joined, names, rows, level + 1)
        ranks = staged(ranks.unionByName(_hand_back(taken, ranks, names)), f"ranks-{level}")
    else:
        ranks = staged(rank(rest, names, rows, level + 1), f"ranks-{level}")
    return _hand_back(mapped, ranks, names)
