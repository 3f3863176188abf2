"""Running sums and successors inside ordered segments, spread over range partitions.

A segment (all rows of one key) may hold any share of the table: rows are dealt
by ranges of (key, order), so a large segment spans many tasks, every task sums
its own rows, and what a task must add from the tasks before it follows from
one row of totals per task. Those rows, at most ``parts`` of them, are all that
reaches the driver.

Sums wrap at 64 bits. The order must be total where the sums are to be the same
on every run. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegov.llm.staging import map_arrow, staged

ROWS = 200_000   # rows that one task takes


def parts_for(rows: int, per_task: int) -> int:
    return max(1, math.ceil(rows / per_task))


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """True where a row's key differs from the row before (true at the first)."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    if n:
        out[0] = True
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def segment_sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Inclusive running sums of uint64 ``values`` that restart where ``begins``."""
    total = np.cumsum(values, dtype=np.uint64)
    first = np.flatnonzero(begins)
    before = np.repeat(total[first] - values[first], np.diff(np.r_[first, len(values)]))
    return total - before


def segmented_scan(df: DataFrame, key: list[str], order: list[str], sums: dict[str, str] | None = None,
                   lead: tuple[str, str] | None = None, per_task: int = ROWS) -> DataFrame:
    """``df`` with, per ``sums`` entry {new: column}, the running sum inside the
    row's segment, and with ``lead`` (new, column) the next row's value in the
    segment (null at its end). Key columns, the summed and the led ones are longs without nulls."""
    sums = sums or {}
    spark, names = df.sparkSession, list(df.columns)
    parts = parts_for(df.count(), per_task)
    dealt = df.repartitionByRange(parts, *key, *order).sortWithinPartitions(*key, *order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    added = [*sums, *([lead[0]] if lead else [])]
    local_schema = ", ".join([fields, *(f"`{a}` long" for a in added), "part long", "head boolean", "edge int"])

    def local(batches):
        rows = pa.Table.from_batches(batches).combine_chunks() if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        keys = [rows[k].to_numpy() for k in key]
        begins = changes(keys)
        out = {n: rows[n] for n in names}
        for new, col in sums.items():
            out[new] = pa.array(segment_sums(rows[col].to_numpy().view(np.uint64), begins).view(np.int64))
        n = rows.num_rows
        if lead:
            v = rows[lead[1]].to_numpy()
            out[lead[0]] = pa.array(np.r_[v[1:], 0], mask=np.r_[begins[1:], True])
        out["part"] = pa.array(np.full(n, TaskContext.get().partitionId(), np.int64))
        out["head"] = pa.array(np.cumsum(begins) == 1)        # rows of the segment that may have begun in an earlier task
        edge = np.zeros(n, np.int32)
        edge[0] += 1
        edge[-1] += 2
        out["edge"] = pa.array(edge)
        yield from pa.table(out).to_batches(max_chunksize=20_000)

    rows = staged(map_arrow(dealt, local, local_schema), "scan")
    # one or two rows per task
    ends = rows.filter("edge > 0").select("part", "head", "edge", *key, *sums, *([lead[1]] if lead else [])).collect()
    first = {r["part"]: r for r in ends if r["edge"] & 1}
    last = {r["part"]: r for r in ends if r["edge"] & 2}
    carry: dict[int, list[int]] = {}
    follow: dict[int, int] = {}
    before, running = None, [0] * len(sums)
    for p in sorted(first):
        own = tuple(first[p][k] for k in key)
        if before is not None and own == before:
            carry[p] = list(running)
            if lead:
                follow[previous] = first[p][lead[1]]
        end = tuple(last[p][k] for k in key)
        add = carry.get(p, [0] * len(sums)) if last[p]["head"] else [0] * len(sums)
        running = [(a + last[p][s]) % (1 << 64) for a, s in zip(add, sums)]
        before, previous = end, p

    def joined(batches):
        for b in batches:
            cols = {n: b[n] for n in names}
            part, head = b["part"].to_numpy(), b["head"].to_numpy(zero_copy_only=False)
            edge = b["edge"].to_numpy()
            for i, s in enumerate(sums):
                v = b[s].to_numpy().view(np.uint64).copy()
                for p in np.unique(part):
                    if int(p) in carry:
                        v[(part == p) & head] += np.uint64(carry[int(p)][i])
                cols[s] = pa.array(v.view(np.int64))
            if lead:
                v = b[lead[0]].to_pylist()
                for at in np.flatnonzero(edge & 2):
                    v[at] = follow.get(int(part[at]), v[at])
                cols[lead[0]] = pa.array(v, pa.int64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return map_arrow(rows, joined, ", ".join([fields, *(f"`{a}` long" for a in added)]))
