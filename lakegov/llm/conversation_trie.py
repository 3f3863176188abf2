"""Conversation prefix trie by the Euler-tour technique.

Conversations that begin with the same turns share those turns' nodes. A node is
named by its smallest member and its depth, as a conversation has one node at
each depth. Steps:

1. Turns are numbered and rebuilt rows get 128-bit prefix digests (running sums
   of position-tagged turn digests), both by ``segmented_scan``, so that a
   conversation may hold any share of the turns.
2. Rows with the same depth and digest are one node (partial aggregates); its
   parent's digest is the sum before its own turn.
3. Children are laid out in the order of their names; every node gets an enter
   and an exit arc: enter leads to the first child's enter or to the own exit,
   exit to the next sibling's enter or to the parent's exit.
4. The tour is list-ranked (``list_rank``) with the weights (1, leaf, saving) on
   the enter arcs, so the rank of an arc is the prefix sums at its position. A
   subtree's leaves and savings are the sums at its exit less those at its enter.

Rebuilding (``rebuild``): conversation c takes the first h turns of the
conversation ``c - c % GROUP`` (all if it has fewer, none if it is absent) in
place of its own first h, h = crc32(decimal c) % ``SHARED``.

The digest of a node's members ends (conversations of exactly its length) is
SHA-256 of their ids in numeric order; ids are gathered by blocks of ``BLOCK``
consecutive numbers, so a node where a third of all conversations end is
joined from bounded texts that stream through the digest.

Defined cases: null roles and texts are empty; null turn numbers come first;
equal ones are ordered by role, then by the text's digest; repeated rows are
turns of their own; rows without a conversation id belong to no conversation
and are left out; a conversation that loses all its turns is a member of the
root alone; an empty table gives no rows (there is no root without members);
other columns are not read. Lengths are code points.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegov.llm.list_rank import ROWS as RANK_ROWS
from lakegov.llm.list_rank import rank
from lakegov.llm.scan import ROWS, segmented_scan
from lakegov.llm.staging import map_arrow, staged

GROUP = 100
SHARED = 6
BLOCK = 4096     # ids whose text is one piece of a members digest
WEIGHTS = ["at", "leaves", "saved"]


def numbered_turns(conversations: DataFrame, per_task: int = ROWS) -> DataFrame:
    """(c, pos from 1, d1, d2, chars) per turn; texts stay behind, two digests go on."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("d1"), F.xxhash64(F.lit(2), text, role).alias("d2"),
        F.char_length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("one"))
    # a null turn number comes first, also before the smallest number
    t = t.withColumn("dated", F.col("turn").isNotNull().cast("long")).withColumn("turn", F.coalesce("turn", F.lit(0)))
    t = staged(t, "turns")
    return staged(segmented_scan(t, ["c"], ["dated", "turn", "role", "d1", "d2"], {"pos": "one"}, per_task=per_task)
                  .select("c", "pos", "d1", "d2", "chars"), "numbered-turns")


def rebuild(turns: DataFrame) -> DataFrame:
    """(c, d, length, t1, t2, chars): rebuilt turns and a textless row d = 0 for
    every conversation; (t1, t2) are digests of turn and place."""
    lengths = staged(turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "lengths")
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(SHARED)).cast("long")
    lent = (turns.filter((F.expr(f"c % {GROUP}") == 0) & (F.col("pos") < SHARED)).groupBy("c")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "d1", "d2", "chars"))).alias("lent"))
            .select(F.col("c").alias("base"), "lent"))      # at most SHARED - 1 turns each
    convs = lengths.withColumns({"h": h, "base": F.expr(f"c - c % {GROUP}")}).join(lent, "base", "left")
    head = F.slice(F.coalesce("lent", F.expr("cast(array() as array<struct<pos: bigint, d1: bigint, d2: bigint, chars: bigint>>)")),
                   F.lit(1), F.col("h").cast("int"))
    convs = convs.withColumn("head", head).withColumn("k", F.size("head").cast("long"))
    convs = staged(convs.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).drop("lent", "n"), "rebuilt")
    root = convs.select("c", F.lit(0).cast("long").alias("d"), "length", *(F.lit(0).cast("long").alias(x) for x in ("d1", "d2", "chars")))
    first = convs.select("c", "length", F.explode("head").alias("x")).select(
        "c", F.col("x.pos").alias("d"), "length", "x.d1", "x.d2", "x.chars")
    own = turns.join(convs.select("c", "h", "k", "length"), "c").filter("pos > h").select(
        "c", (F.col("pos") - F.col("h") + F.col("k")).alias("d"), "length", "d1", "d2", "chars")
    rows = root.unionByName(first).unionByName(own)
    tag = lambda s, x: F.when(F.col("d") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(s), "d", x))
    return staged(rows.select("c", "d", "length", tag(3, "d1").alias("t1"), tag(4, "d2").alias("t2"), "chars"), "rebuilt-turns")


def members_digest(ends: DataFrame) -> DataFrame:
    """(d, p1, p2, ends_sha256) of the nodes (d, p1, p2) where conversations ``c`` end."""
    node = ["d", "p1", "p2"]
    pieces = (ends.groupBy(*node, F.floor(F.col("c") / BLOCK).alias("block"))
              .agg(F.array_join(F.sort_array(F.collect_list("c")), ",").alias("ids")))
    pieces = pieces.repartition(*node).sortWithinPartitions(*node, "block")

    def run(batches):
        now, digest, done = None, None, []
        for b in batches:
            for *key, ids in zip(*(b[x].to_pylist() for x in (*node, "ids"))):
                if key == now:
                    digest.update(b"," + ids.encode())
                else:
                    if now is not None:
                        done.append([*now, digest.hexdigest()])
                    now, digest = key, hashlib.sha256(ids.encode())
            if len(done) > 20_000:
                yield pa.RecordBatch.from_pylist([dict(zip((*node, "ends_sha256"), r)) for r in done])
                done = []
        if now is not None:
            done.append([*now, digest.hexdigest()])
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip((*node, "ends_sha256"), r)) for r in done])

    return map_arrow(pieces, run, "d long, p1 long, p2 long, ends_sha256 string")


def nodes(rows: DataFrame, per_task: int = ROWS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, chars, next_conv_id, n_children,
    first_conv_id, ends_sha256) per distinct prefix; next is the next sibling."""
    prefix = staged(segmented_scan(rows, ["c"], ["d"], {"p1": "t1", "p2": "t2"}, per_task=per_task), "prefixes")
    node = staged(prefix.groupBy("d", "p1", "p2").agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.max("t1").alias("t1"), F.max("t2").alias("t2")), "nodes")
    empty = hashlib.sha256(b"").hexdigest()
    digests = staged(members_digest(prefix.filter("d = length").select("d", "p1", "p2", "c")), "members")
    node = node.join(digests, ["d", "p1", "p2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))
    node = staged(with_parents(node), "parents")
    top = node.filter("d = 0").select("*", F.lit(None).cast("long").alias("next_conv_id"))
    below = segmented_scan(node.filter("d > 0"), ["parent_conv_id", "d"], ["conv_id"], lead=("next_conv_id", "conv_id"), per_task=per_task)
    node = top.unionByName(below)
    children = staged(below.groupBy("parent_conv_id", "d").agg(F.count(F.lit(1)).alias("n_children"), F.min("conv_id").alias("first_conv_id"))
                      .select(F.col("parent_conv_id").alias("conv_id"), (F.col("d") - 1).alias("d"), "n_children", "first_conv_id"), "children")
    node = node.join(children, ["conv_id", "d"], "left")
    return staged(node.select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "chars", "next_conv_id",
                              F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "first_conv_id", "ends_sha256"), "trie")


def with_parents(node: DataFrame) -> DataFrame:
    """``node`` with the parent's name, looked up by the digest before the own turn."""
    fields = ["d", "conv_id", "n_convs", "chars", "ends_sha256"]

    def before(batches):
        for b in batches:
            out = {x: b[x] for x in fields}
            for p, t, q in (("p1", "t1", "q1"), ("p2", "t2", "q2")):
                out[q] = pa.array((b[p].to_numpy().view("u8") - b[t].to_numpy().view("u8")).view("i8"))
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    child = map_arrow(node, before, "d long, conv_id long, n_convs long, chars long, ends_sha256 string, q1 long, q2 long")
    child = staged(child, "children-keys")
    named = node.select(F.col("d").alias("up"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    return child.withColumn("up", F.col("d") - 1).join(named, ["up", "q1", "q2"], "left").select(*fields, "parent_conv_id")


def tour(trie: DataFrame) -> DataFrame:
    """The arcs as cells of one list: (c, k) with k = 2 depth for enter and
    2 depth + 1 for exit, (nc, nk) the next arc, weights on the enter arcs."""
    d, null = F.col("depth"), F.lit(None).cast("long")
    inner = F.col("n_children") > 0
    leaf = (~inner).cast("long")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    nc = F.when(inner, F.col("first_conv_id")).otherwise(F.col("conv_id"))
    enter = F.struct((2 * d).alias("k"), nc.alias("nc"), F.when(inner, 2 * d + 2).otherwise(2 * d + 1).alias("nk"),
                     F.lit(1).cast("long").alias("at"), leaf.alias("leaves"), saved.alias("saved"))
    more = F.col("next_conv_id").isNotNull()
    zero = F.lit(0).cast("long")
    leave = F.struct((2 * d + 1).alias("k"), F.when(more, F.col("next_conv_id")).otherwise(F.col("parent_conv_id")).alias("nc"),
                     F.when(more, 2 * d).when(d > 0, 2 * d - 1).otherwise(null).alias("nk"),
                     F.lit(1).cast("long").alias("at"), zero.alias("leaves"), zero.alias("saved"))
    return trie.select(F.col("conv_id").alias("c"), F.explode(F.array(enter, leave)).alias("x")).select("c", "x.*")


def conversation_trie(conversations: DataFrame, per_task: int = ROWS, rank_rows: int = RANK_ROWS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, enter_at, exit_at) per node; the last two are
    the arcs' places in the tour."""
    trie = nodes(rebuild(numbered_turns(conversations, per_task)), per_task)
    ranked = rank(tour(trie), WEIGHTS, rank_rows)
    way = lambda side, w: F.max(F.when(F.col("k") % 2 == side, F.col(w)))
    sums = ranked.groupBy(F.col("c").alias("conv_id"), F.expr("k div 2").alias("depth")).agg(
        way(0, "at").alias("enter_at"), way(1, "at").alias("exit_at"),
        (way(1, "leaves") - way(0, "leaves")).alias("n_leaves"), (way(1, "saved") - way(0, "saved")).alias("saved_tokens"))
    return staged(trie.join(sums, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
        "enter_at", "exit_at"), "conversation-trie")
