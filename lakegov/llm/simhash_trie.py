"""SimHash near-duplicates by a binary-trie self-join.

A document's fingerprint has a bit set where more than half of its shingles'
XXH64 hashes have it. Fingerprints link at ``max_bits`` or fewer differing
bits; a component is what is reachable over links.

The join works on distinct fingerprints. A pair within ``max_bits`` agrees on
one of ``max_bits + 1`` equal blocks, so each fingerprint enters one trie per
block, rotated to have that block on top; a trie is one group of the shuffle.
Within a trie, pairs of nodes are traversed together, level by level: the
differing bits add up, and a pair of nodes is pruned once they exceed the
budget. Groups above ``HOT`` members are first expanded into their child node
pairs (four levels at a time) as groups of their own, so no task holds more
than a bounded group, and no pair is lost. Links are folded into spanning
stars where they are found; pairs are never emitted.

Components come from repeated star contraction over staged edge tables; every
round is written to the shared folder.

Defined cases: a null or word-less text has fingerprint zero and links like
any other; fewer words than a shingle give one shingle of all words; repeated
rows and ids share fingerprint and component; null ids get a component but
name none (a component of null ids only has a null id); an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.llm.staging import map_arrow, staged, unused

SHINGLE = 3
MAX_BITS = 3
HOT = 20_000        # members of a trie that one task traverses whole
FRONTIER = 1 << 20  # node pairs expanded at once
STEP = 4            # levels by which a hot trie is split


# -- fingerprints -------------------------------------------------------------
def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    space = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(space + 1).tolist()]
    ends = [*space.tolist(), len(line)][shingle - 1:]
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(ends)
    for lo in range(0, n, 65_536):
        h = np.array([digest(line[s:e], 42) for s, e in zip(starts[lo:lo + 65_536], ends[lo:lo + 65_536])], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` without ``text``, with the fingerprint as a signed 64-bit number."""
    kept = [c for c in docs.columns if c not in (text, name)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), f"`{name}` long"])

    own, = unused(docs, "body")

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py() or "", shingle) for t in b[own]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), pa.array(fp)], names=[*kept, name])

    return map_arrow(docs.select(*kept, F.col(text).alias(own)), run, schema)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- trie traversal in a task -------------------------------------------------
def links(v: np.ndarray, nodes: np.ndarray, depth: int, max_bits: int):
    """Links among sorted values. ``nodes``: rows (lo1, hi1, lo2, hi2, differing
    bits) of node pairs at ``depth``; equal ranges stand for a node with
    itself. Yields index pairs (i, j)."""
    bit_sums: dict[int, np.ndarray] = {}
    stack = [(depth, nodes)]
    while stack:
        depth, p = stack.pop()
        while len(p):
            if len(p) > FRONTIER:
                half = len(p) // 2
                stack.append((depth, p[half:]))
                p = p[:half]
            single = (p[:, 1] - p[:, 0] == 1) & (p[:, 3] - p[:, 2] == 1)
            if single.any():
                i, j = p[single, 0], p[single, 2]
                near = (i != j) & (np.bitwise_count(v[i] ^ v[j]) <= max_bits)
                if near.any():
                    yield i[near], j[near]
                p = p[~single]
            if not len(p) or depth == 64:
                break
            if depth not in bit_sums:
                zeros = np.zeros(len(v) + 1, np.int64)
                np.cumsum((v >> np.uint64(63 - depth)) & np.uint64(1) == 0, out=zeros[1:])
                bit_sums[depth] = zeros
            z = bit_sums[depth]
            a0, a2, b0, b2, e = p.T
            a1, b1 = a0 + z[a2] - z[a0], b0 + z[b2] - z[b0]
            own = (a0 == b0) & (a2 == b2)
            children = [(a0, a1, b0, b1, e), (a1, a2, b1, b2, e), (a0, a1, b1, b2, e + 1)]
            out = [np.stack(c, 1) for c in children]
            out.append(np.stack((a1, a2, b0, b1, e + 1), 1)[~own])  # of a node with itself, once
            p = np.concatenate(out)
            p = p[(p[:, 0] < p[:, 1]) & (p[:, 2] < p[:, 3]) & (p[:, 4] <= max_bits)]
            depth += 1


def fold(n: int, root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots (smallest index) of n nodes after joining i and j."""
    while True:
        a, b = root[i], root[j]
        differ = a != b
        if not differ.any():
            return root
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def rotate(v: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return v if by == 0 else (v << np.uint64(by)) | (v >> np.uint64(64 - by))


def _stars(max_bits: int):
    """Task function: rows sorted by (r, depth, a, b, side, v) to star edges (x, y) of fingerprints."""
    width = 64 // (max_bits + 1)

    def solve(c):
        key = np.stack([c[k] for k in ("r", "depth", "a", "b")], 1)
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        last = np.r_[first[1:], len(key)]
        for r, depth in {(int(r), int(d)) for r, d in key[first, :2]}:
            mine = (key[first, 0] == r) & (key[first, 1] == depth)
            lo, hi = first[mine], last[mine]
            own = key[lo, 2] == key[lo, 3]
            mid = lo + np.array([int((c["side"][x:y] == 0).sum()) for x, y in zip(lo, hi)], np.int64)
            differ = np.bitwise_count((key[lo, 2] ^ key[lo, 3]).view(np.uint64)).astype(np.int64)
            nodes = np.stack((lo, np.where(own, hi, mid), np.where(own, lo, mid), hi, differ), 1)
            v = c["v"].view(np.uint64)
            root = np.arange(len(v))
            for i, j in links(v, nodes, depth, max_bits):
                root = fold(len(v), root, i, j)
            x = np.flatnonzero(root != np.arange(len(v)))
            if len(x):
                back = lambda u: rotate(u, 64 - r * width).view(np.int64)  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays([pa.array(back(v[x])), pa.array(back(v[root[x]]))], names=["x", "y"])

    def run(batches):
        held = None
        for b in batches:
            c = {k: b[k].to_numpy() for k in ("r", "depth", "a", "b", "side", "v")}
            if held is not None:
                c = {k: np.concatenate((held[k], c[k])) for k in c}
            if not len(c["v"]):
                continue
            # the last group may go on in the next batch
            same = np.ones(len(c["v"]), bool)
            for k in ("r", "depth", "a", "b"):
                same &= c[k] == c[k][-1]
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = {k: x[cut:] for k, x in c.items()}
            if cut:
                yield from solve({k: x[:cut] for k, x in c.items()})
        if held is not None and len(held["v"]):
            yield from solve(held)

    return run


NODE_ROWS = "r long, depth long, a long, b long, side long, v long"


def _split(max_bits: int):
    """Task function: members of hot node pairs to the child node pairs they belong to."""
    wide = 1 << STEP

    def run(batches):
        kids = np.arange(wide)
        for batch in batches:
            c = {k: batch[k].to_numpy() for k in ("r", "depth", "a", "b", "side", "v")}
            n = len(c["v"])
            if not n:
                continue
            kid = ((c["v"].view(np.uint64) >> (np.uint64(64 - STEP) - c["depth"].view(np.uint64))) & np.uint64(wide - 1)).astype(np.int64)
            row = np.repeat(np.arange(n), wide)
            mine, other = kid[row], np.tile(kids, n)
            own = c["a"][row] == c["b"][row]
            # of a node with itself the smaller child comes first
            first = np.where(own, np.minimum(mine, other), np.where(c["side"][row] == 0, mine, other))
            second = np.where(own, np.maximum(mine, other), np.where(c["side"][row] == 0, other, mine))
            a, b = (c["a"][row] << STEP) | first, (c["b"][row] << STEP) | second
            side = np.where(own, (mine != first).astype(np.int64), c["side"][row])
            keep = np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits
            cols = (c["r"][row], c["depth"][row] + STEP, a, b, side, c["v"][row])
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in cols], names=["r", "depth", "a", "b", "side", "v"])

    return run


def trie_links(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT, fp: str = "fp") -> DataFrame:
    """Edges (x, y) that connect distinct fingerprints exactly as all links
    within ``max_bits`` do (spanning stars of the links found in each task)."""
    if not 0 <= max_bits <= 7 or 64 % (max_bits + 1):
        raise ValueError("max_bits must be 0, 1, 3 or 7, so that blocks are equal")
    width = 64 // (max_bits + 1)
    v = F.col(fp)
    rotated = [F.when(F.lit(r == 0), v).otherwise(
        F.shiftleft(v, r * width % 64).bitwiseOR(F.shiftrightunsigned(v, 64 - r * width if r else 0)))
        for r in range(max_bits + 1)]
    rows = fps.select(F.posexplode(F.array(*rotated)).alias("r", "v"))
    top = F.shiftrightunsigned("v", 64 - width) if width < 64 else F.col("v")
    rows = rows.select(F.col("r").cast("long").alias("r"), F.lit(width).cast("long").alias("depth"), top.alias("a"),
                       top.alias("b"), F.lit(0).cast("long").alias("side"), "v")
    key = ["r", "depth", "a", "b"]
    edges = None
    while True:
        sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), (F.max("side") - F.min("side") + 1).alias("sides"))
        # two different nodes of which one has no members hold no pair
        large = staged(sizes.filter((F.col("n") > hot) & ((F.col("a") == F.col("b")) | (F.col("sides") == 2))).select(*key),
                       "hot-tries")
        any_hot = bool(large.head(1))
        usual = rows.join(large, key, "left_anti") if any_hot else rows
        found = map_arrow(usual.repartition(*key).sortWithinPartitions(*key, "side", "v"), _stars(max_bits), "x long, y long")
        found = staged(found.distinct(), "trie-links")
        edges = found if edges is None else edges.unionByName(found)
        if not any_hot:
            return edges
        # the longest path is 64 levels, so this ends; at depth 64 a node is one fingerprint
        rows = staged(map_arrow(rows.join(large, key, "left_semi"), _split(max_bits), NODE_ROWS), "trie-children")


# -- components ---------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (x, y) with the smallest node it
    reaches. Alternates large-star and small-star contraction until nothing
    changes; the number of rounds grows with the logarithm of the size."""
    e = staged(edges.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "cc")
    seen = None
    while True:
        both = e.union(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m"))
        large = (both.filter("y > x").join(low, "x").select(F.col("y").alias("x"), F.least("m", "x").alias("y"))
                 .filter("x <> y").distinct())
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x")
        small = (small.select(F.col("y").alias("x"), F.col("m").alias("y")).union(small.select("x", F.col("m").alias("y")))
                 .filter("x <> y").distinct())
        e = staged(small, "cc")
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("x", "y"))).first()
        if state == seen:
            break
        seen = state
    return e.select(F.col("x").alias("node"), F.col("y").alias("root")).union(
        e.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct())


def classes(docs_fp: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT, id_col: str = "doc_id") -> DataFrame:
    """(fp, component_id, root): one row per distinct fingerprint of a staged
    (id, fp) table."""
    each = staged(docs_fp.groupBy("fp").agg(F.min(id_col).alias("low")), "fp-low")
    roots = components(trie_links(each, max_bits, hot))
    joined = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    joined = staged(joined, "fp-roots")
    named = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    return staged(joined.join(named, "root").select("fp", "component_id", "root"), "fp-classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``."""
    fps = staged(fingerprints(docs.select(F.col(id_col).cast("long").alias(id_col), text), shingle, text), "fingerprints")
    named = classes(fps, max_bits, hot, id_col)
    return fps.join(named, "fp", "left").select(id_col, hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT, id_col: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``docs`` with one row per component: the smallest id (null last), then
    the smallest hash of the text; rows that repeat both are one. Rows are
    keyed by id and text hash, so no key is hot."""
    null, own, digest = key = unused(docs, "null", "id_", "digest")
    keyed = docs.withColumns({null: F.col(id_col).isNull(), own: F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
                              digest: F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    rows = keyed.select(F.col(null).alias("null"), F.col(own).alias("own"), F.col(digest).alias("digest"), F.col(text).alias("t"))
    fps = staged(fingerprints(rows, shingle, "t"), "fingerprints")
    named = classes(fps, max_bits, hot, "own")
    chosen = fps.join(named.select("fp", "root"), "fp").groupBy("root").agg(F.min(F.struct("null", "own", "digest")).alias("k"))
    chosen = staged(chosen.select(F.col("k.null").alias(null), F.col("k.own").alias(own), F.col("k.digest").alias(digest)), "representatives")
    return keyed.join(chosen, key).dropDuplicates(key).select(*docs.columns)
