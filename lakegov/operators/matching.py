"""Master-data matching and stewardship status.

Semantics (per block of equal normalised block value, each unordered pair of
records once): score = round((1 - levenshtein(n1, n2) / max_len) * 100), 0
when both names are empty; pairs below the steward threshold are dropped,
pairs at or above the auto threshold are AUTO_MERGE/HIGH, the rest
STEWARD_REVIEW/MEDIUM. The recommended survivor is the record with the
longer raw name, ties to the smaller id.

Plan at scale — no pair enumeration inside a block:

1. records collapse to *name groups* (block, normalised name, member count,
   best member) with a partial aggregate, so a name held by a third of all
   rows is one row after the map side;
2. candidate pairs of *distinct* names come from an exact signature
   equi-join (pigeonhole on d+1 segments, where d is the largest edit
   distance that can still reach the threshold) — lossless, and the join
   keys spread a hot block over many partitions; a signature that a whole
   family of names shares is cut by further signatures of what else the
   names hold, and what stays heavy is joined in cells of ``HEAVY`` rows;
3. candidates are verified with the real score; identical-name pairs are
   scored by count (m*(m-1)/2 pairs at score 100, or 0 for empty names).

The match table is therefore kept at name-pair level with a ``pair_count``;
``expand_pairs`` produces the record-level pair table when that is wanted
(bounded inputs such as a zone file).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.functions.expr import max_edits_for, norm_name, similarity
from lakegov.session import checkpoint_root

# --- fixed values: match vocabulary ----------------------------------------
AUTO_MERGE, STEWARD_REVIEW = "AUTO_MERGE", "STEWARD_REVIEW"
HIGH, MEDIUM = "HIGH", "MEDIUM"
APPROVED, PENDING, REJECTED = "APPROVED", "PENDING", "REJECTED"


# H1 --------------------------------------------------------------------------
def normalize_members(records: DataFrame, key: str, name: str, block: str | None,
                      collapse_spaces: bool = True) -> DataFrame:
    """Member rows: (_id, _block, _name, _raw_len, raw block, raw name)."""
    blk = norm_name(block) if block else F.lit("")
    return records.select(
        F.col(key).alias("_id"),
        blk.alias("_block"),
        norm_name(name, collapse_spaces).alias("_name"),
        F.length(F.col(name)).alias("_raw_len"),
        (F.col(block) if block else F.lit(None).cast("string")).alias("_block_raw"),
        F.col(name).alias("_name_raw"),
    )


def name_groups(members: DataFrame) -> DataFrame:
    """(block, name) -> member count and best member (longest raw name,
    smallest id on ties); one partial aggregate.

    For int ids the (length, id) order is packed into one bigint
    (length << 32 | (2^31 - 1 - id)), so the aggregate stays a hash aggregate
    (no per-task sort of all members); other key types use a struct max."""
    if dict(members.dtypes)["_id"] in ("int", "smallint", "tinyint"):
        packed = (F.col("_raw_len").cast("bigint") * F.lit(1 << 32)
                  + (F.lit((1 << 31) - 1) - F.col("_id").cast("bigint")))
        g = members.groupBy("_block", "_name").agg(F.count(F.lit(1)).alias("_n"), F.max(packed).alias("_p"))
        return g.select("_block", "_name", "_n",
                        F.shiftright(F.col("_p"), 32).cast("int").alias("_best_len"),
                        (F.lit((1 << 31) - 1) - F.col("_p").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int")
                        .alias("_best_id"))
    best = F.max(F.struct(F.col("_raw_len").alias("len"), (-F.col("_id").cast("bigint")).alias("neg_id")))
    return (members.groupBy("_block", "_name")
            .agg(F.count(F.lit(1)).alias("_n"), best.alias("_best"))
            .select("_block", "_name", "_n",
                    F.col("_best.len").alias("_best_len"), (-F.col("_best.neg_id")).alias("_best_id")))


# C1 (candidate generation) ---------------------------------------------------
HEAVY = 2_000          # rows of one signature that a task takes on either side
HEAVY_PAIRS = 4_000_000  # pairs of one signature that are compared without cutting it further
SAMPLE = 16            # one name in SAMPLE is looked at to find heavy signatures
LEVELS = 5             # signatures that a heavy group may be cut by
GAP = "\u0001"         # stands for a matched signature in what is left of a name


def _seg(i: Column, length: Column, d: Column) -> tuple[Column, Column]:
    """0-based start and length of segment i when a string of ``length`` is cut
    into d+1 near-equal segments."""
    q = F.floor(length / (d + 1)).cast("int")
    rem = (length - q * (d + 1)).cast("int")
    start = i * q + F.least(i, rem)
    seg_len = q + F.when(i < rem, 1).otherwise(0)
    return start, seg_len


def _rest(x: Column, start: Column, n: Column) -> Column:
    """``x`` with the ``n`` characters from 0-based ``start`` on replaced by one gap."""
    return F.concat(F.substring(x, F.lit(1), start), F.lit(GAP), F.substring(x, start + n + 1, F.length(x)))


def _index(rows: DataFrame) -> DataFrame:
    """Every segment of what is left of the longer name: (_block, key, r, x, d)
    becomes one row per segment with the key of the signature."""
    rows = rows.select("_block", "key", "r", "x", "d", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("i"))
    st, ln = _seg(F.col("i"), F.length("x"), F.col("d"))
    return rows.select("_block", F.xxhash64("key", "i", F.substring("x", st + 1, ln)).alias("key"), "r",
                       _rest(F.col("x"), st, ln).alias("x"), "d", ln.alias("ln"))


def _probe(rows: DataFrame) -> DataFrame:
    """Every substring of what is left of a name that may equal a segment of a
    partner whose rest has ``lx`` characters: (_block, key, s, y, lx, d)."""
    rows = rows.select("_block", "key", "s", "y", "lx", "d", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("i"))
    st, ln = _seg(F.col("i"), F.col("lx"), F.col("d"))
    rows = rows.select("*", st.alias("st"), ln.alias("ln"))
    lo = F.greatest(F.lit(0), F.col("st") - F.col("d"))
    hi = F.least(F.length("y") - F.col("ln"), F.col("st") + F.col("d"))
    rows = rows.filter(hi >= lo).select("*", F.explode(F.sequence(lo, hi)).alias("p"))
    return rows.select("_block", F.xxhash64("key", "i", F.substring(F.col("y"), F.col("p") + 1, F.col("ln"))).alias("key"), "s",
                       _rest(F.col("y"), F.col("p"), F.col("ln")).alias("y"), (F.col("lx") - F.col("ln") + 1).alias("lx"), "d", "ln")


def _heavy_keys(idx: DataFrame, pr: DataFrame, heavy: int) -> DataFrame:
    """(key, ni, np): signatures that may hold more than ``heavy`` rows on a side,
    with their sizes as the sampled names tell them. A wrong estimate moves rows
    between the plain and the split join, never in or out of the result."""
    each = heavy if heavy < SAMPLE * 64 else heavy // SAMPLE
    rate = 1 if each == heavy else SAMPLE
    picked = lambda c: F.pmod(F.xxhash64(F.lit(5), c), F.lit(rate)) == 0
    ni = idx.filter(picked("r")).groupBy("key").agg((F.count(F.lit(1)) * rate).alias("ni"), F.max("d").alias("d"))
    np = pr.filter(picked("s")).groupBy("key").agg((F.count(F.lit(1)) * rate).alias("np"))
    return ni.join(np, "key").filter(f"ni > {heavy} OR np > {heavy}")


def _split_join(idx: DataFrame, pr: DataFrame, sizes: DataFrame, heavy: int) -> DataFrame:
    """Join of heavy signatures: both sides are dealt into cells of about
    ``heavy`` rows and repeated over the other side's cells, so every pair
    meets once and no task takes a whole signature."""
    cells = sizes.select("key", F.ceil(F.col("ni") / heavy).cast("int").alias("ci"), F.ceil(F.col("np") / heavy).cast("int").alias("cp"))
    deal = lambda c, n: F.pmod(F.xxhash64(F.lit(9), c), n).cast("int")
    i = idx.join(cells, "key").withColumn("a", deal("r", F.col("ci"))).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("cp") - 1)))
    p = pr.join(cells, "key").withColumn("b", deal("s", F.col("cp"))).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("ci") - 1)))
    return i.select("_block", "key", "a", "b", "r", "d").join(p.select("_block", "key", "a", "b", "s"), ["_block", "key", "a", "b"])


def _hits(idx: DataFrame, pr: DataFrame, heavy: int, level: int = 1) -> DataFrame:
    """(_block, r, s, d): names that share a signature. A signature that more than
    ``heavy`` names share on a side and that would mean more than
    ``HEAVY_PAIRS`` pairs says little about its pairs: the shared
    segment is taken out of both names, and what is left must again agree
    in one of d + 1 segments, as all d edits are there. This repeats while
    it takes fewer rows than there are pairs, at most ``LEVELS`` times;
    the groups left are joined in cells."""
    plain = lambda i, p: i.select("_block", "key", "r", "d").join(p.select("_block", "key", "s"), ["_block", "key"])
    sizes = _heavy_keys(idx, pr, heavy).checkpoint(eager=True)
    if sizes.isEmpty():
        return plain(idx, pr).select("_block", "r", "s", "d")
    out = plain(idx.join(sizes, "key", "left_anti"), pr.join(sizes, "key", "left_anti")).select("_block", "r", "s", "d")
    # cutting repeats a name (d + 1) (2 d + 1) times and finds a pair up to d + 1 times: only where that is less than the pairs
    big = ((F.col("ni") * F.col("np") > min(HEAVY_PAIRS, heavy * heavy)) & F.lit(level < LEVELS)
           & (F.col("ni") > (F.col("d") + 1) * (F.col("d") + 1) * (2 * F.col("d") + 1)))
    cut = F.col("ln") >= 2          # a shorter segment leaves nothing to cut further
    small = sizes.filter(~big)
    large = sizes.filter(big)
    heavy_i, heavy_p = idx.join(sizes, "key", "left_semi"), pr.join(sizes, "key", "left_semi")
    rest_i, rest_p = heavy_i.join(large, "key", "left_semi").filter(~cut), heavy_p.join(large, "key", "left_semi").filter(~cut)
    for i, p in ((heavy_i.join(small, "key", "left_semi"), heavy_p.join(small, "key", "left_semi")), (rest_i, rest_p)):
        out = out.unionByName(_split_join(i, p, sizes, heavy).select("_block", "r", "s", "d"))
    deeper_i = _index(heavy_i.join(large, "key", "left_semi").filter(cut)).checkpoint(eager=True)
    deeper_p = _probe(heavy_p.join(large, "key", "left_semi").filter(cut)).checkpoint(eager=True)
    return out.unionByName(_hits(deeper_i, deeper_p, heavy, level + 1))


def name_hits(groups: DataFrame, threshold: int, seek: DataFrame | None = None, heavy: int = HEAVY) -> DataFrame:
    """(_block, r, s): candidate pairs of distinct names, r not shorter than s,
    possibly repeated; every pair that scores >= ``threshold`` (1 to 100) is
    among them. With ``seek`` (_block, _name) only pairs with a sought name.

    Pigeonhole: if lev(r, s) <= d and r is cut into d+1 segments, one segment
    survives intact in s, within d positions of where it was in r. The longer
    name r (d from its length) publishes its segments; every name s probes,
    for each possible longer length, the substrings that could equal a
    segment. An equi-join on the signature (a hash of block, length, segment
    number and text) finds every qualifying pair; a hash clash only adds a candidate."""
    T = int(threshold)
    names = groups.select("_block", "_name").filter(F.length("_name") > 0)
    block_max = names.groupBy("_block").agg(F.max(F.length("_name")).alias("_maxlen"), F.count(F.lit(1)).alias("_names"))
    # no signature holds more names than a block: small blocks need no look for heavy ones
    largest = names.groupBy("_block").count().agg(F.max("count")).first()[0] or 0

    def sides(index_names: DataFrame, probe_names: DataFrame) -> DataFrame:
        L = F.length("_name")
        idx = _index(index_names.select("_block", F.xxhash64("_block", L).alias("key"), F.col("_name").alias("r"),
                                        F.col("_name").alias("x"), max_edits_for(L, T).alias("d")))
        # longer lengths Lr with Lr - d(Lr) <= Ls, i.e. Lr <= Ls * 200 / (2T - 1)
        # (capped at the longest name of the block: no longer partner exists)
        lr_max = F.least(F.floor(L * F.lit(200) / F.lit(2 * T - 1)).cast("int"), F.col("_maxlen"))
        pr = probe_names.join(block_max, "_block").select("_block", F.col("_name").alias("s"), F.explode(F.sequence(L, lr_max)).alias("lx"))
        pr = pr.withColumn("d", max_edits_for(F.col("lx"), T)).filter(F.col("lx") - F.col("d") <= F.length("s"))
        pr = _probe(pr.select("_block", F.xxhash64("_block", "lx").alias("key"), "s", F.col("s").alias("y"), "lx", "d"))
        if largest > heavy:
            found = _hits(idx, pr, heavy)
        else:
            found = idx.select("_block", "key", "r", "d").join(pr.select("_block", "key", "s"), ["_block", "key"])
        return found.filter(F.col("r") != F.col("s")).filter(F.levenshtein("r", "s", heavy_bound(T)) >= 0).select("_block", "r", "s")

    def heavy_bound(t: int) -> int:
        # the comparison stops as soon as a pair is beyond the most edits of the longest name
        return int(longest * (201 - 2 * t) // 200)

    longest = names.agg(F.max(F.length("_name"))).first()[0] or 0
    if seek is None:
        return sides(names, names)
    sought = names.join(seek.select("_block", "_name"), ["_block", "_name"], "left_semi")
    return sides(names, sought).unionByName(sides(sought, names))


def candidate_name_pairs(groups: DataFrame, steward_threshold: int, heavy: int = HEAVY) -> DataFrame:
    """Unordered pairs of distinct names in one block that may score >= T."""
    T = int(steward_threshold)
    names = groups.select("_block", "_name").filter(F.length("_name") > 0)
    if T < 1:
        # every pair scores >= T: the answer itself is all pairs of the block
        a, b = names.alias("a"), names.alias("b")
        return a.join(b, (F.col("a._block") == F.col("b._block")) & (F.col("a._name") < F.col("b._name"))).select(
            F.col("a._block").alias("_block"), F.col("a._name").alias("name_1"), F.col("b._name").alias("name_2"))
    if T > 100:
        return names.select(F.col("_block"), F.col("_name").alias("name_1"),
                            F.col("_name").alias("name_2")).limit(0)
    hits = name_hits(groups, T, heavy=heavy)
    return (hits.select("_block", F.least("r", "s").alias("name_1"), F.greatest("r", "s").alias("name_2"))
            .dropDuplicates())


# H2–H4 -----------------------------------------------------------------------
def _classify(pairs: DataFrame, auto_threshold: int, steward_threshold: int) -> DataFrame:
    s = F.col("score")
    return (pairs.filter(s >= F.lit(steward_threshold))
            .withColumn("action", F.when(s >= F.lit(auto_threshold), F.lit(AUTO_MERGE)).otherwise(F.lit(STEWARD_REVIEW)))
            .withColumn("confidence_tier", F.when(s >= F.lit(auto_threshold), F.lit(HIGH)).otherwise(F.lit(MEDIUM))))


def match_names(groups: DataFrame, auto_threshold: int, steward_threshold: int, heavy: int = HEAVY) -> DataFrame:
    """Scored and classified name pairs with their record-pair counts and the
    recommended survivor (best member across both name groups)."""
    g = groups.select("_block", "_name", "_n", "_best_len", "_best_id")
    g1 = g.toDF("_block", "name_1", "n1", "l1", "b1")
    g2 = g.toDF("_block", "name_2", "n2", "l2", "b2")
    cand = candidate_name_pairs(groups, steward_threshold, heavy)
    cross = (cand.join(g1, ["_block", "name_1"]).join(g2, ["_block", "name_2"])
             .select("_block", "name_1", "name_2",
                     (F.col("n1") * F.col("n2")).cast("bigint").alias("pair_count"),
                     similarity("name_1", "name_2").alias("score"),
                     F.when(F.col("l1") > F.col("l2"), F.col("b1"))
                      .when(F.col("l2") > F.col("l1"), F.col("b2"))
                      .otherwise(F.least("b1", "b2")).alias("recommended_golden_id")))
    same = (g.filter(F.col("_n") >= 2)
            .select("_block", F.col("_name").alias("name_1"), F.col("_name").alias("name_2"),
                    F.expr("CASE WHEN _n % 2 = 0 THEN (_n div 2) * (_n - 1) ELSE _n * ((_n - 1) div 2) END")
                    .alias("pair_count"),
                    F.when(F.length("_name") == 0, F.lit(0)).otherwise(F.lit(100)).alias("score"),
                    F.col("_best_id").alias("recommended_golden_id")))
    return _classify(cross.unionByName(same), auto_threshold, steward_threshold)


def match_records(records: DataFrame, key: str, name: str, block: str | None,
                  auto_threshold: int, steward_threshold: int, batch_id: str | None = None,
                  collapse_spaces: bool = True, materialize: bool = True, heavy: int = HEAVY) -> DataFrame:
    """C1 + H1–H4 as one plan: the name-level match table.

    Columns: batch_id, block, name_1, name_2, score, confidence_tier, action,
    pair_count, recommended_golden_id."""
    # as in an equi-join, records without a block or a name have no partner
    members = (normalize_members(records, key, name, block, collapse_spaces)
               .filter(F.col("_block").isNotNull() & F.col("_name").isNotNull()))
    groups = name_groups(members)
    if materialize:
        # the groups feed six branches of the plan (index, probe, block
        # lengths, both pair sides, same-name pairs): compute them once and cut
        # the lineage in the shared checkpoint folder instead of re-scanning
        checkpoint_root(records.sparkSession)
        groups = groups.checkpoint(eager=True)
    m = match_names(groups, auto_threshold, steward_threshold, heavy)
    return m.select(F.lit(batch_id).cast("string").alias("batch_id"), F.col("_block").alias("block"),
                    "name_1", "name_2", "score", "confidence_tier", "action", "pair_count",
                    F.col("recommended_golden_id").cast(dict(records.dtypes)[key]).alias("recommended_golden_id"))


# review queue ------------------------------------------------------------------
def best_partners(groups: DataFrame, auto_threshold: int, steward_threshold: int, heavy: int = HEAVY) -> DataFrame:
    """(_block, _name, score, partner_name, partner_id): of every name with a
    pair of different names under review (steward <= score < auto) the best such partner:
    highest score, then longest raw name, then smallest id.

    A top-1 similarity join without a pair table: scored candidates go straight
    into a maximum per name (a partial aggregate per task). Names are searched from the upper half of
    the scores down; a name with a partner there is done, and only the
    others look for partners among the many more candidates of the lower half."""
    top, low = min(int(auto_threshold), 101) - 1, max(int(steward_threshold), 1)
    info = groups.select("_block", F.col("_name").alias("partner_name"), "_best_len", "_best_id")
    steps = sorted({(top + low + 1) // 2, low}, reverse=True)
    done, seek = None, None
    for floor in steps:
        if floor > top:
            continue
        hits = name_hits(groups, floor, seek, heavy).withColumn("score", similarity("r", "s")).filter(F.col("score").between(floor, top))
        ways = hits.select("_block", "score", F.explode(F.array(F.struct(F.col("r").alias("_name"), F.col("s").alias("partner_name")),
                                                                F.struct(F.col("s").alias("_name"), F.col("r").alias("partner_name")))).alias("w"))
        ways = ways.select("_block", "score", "w.*")
        if seek is not None:
            ways = ways.join(seek, ["_block", "_name"], "left_semi")
        # the best score first, on narrow rows; then the best of the partners that have it
        best = ways.groupBy("_block", "_name").agg(F.max("score").alias("score"))
        rank = F.struct("_best_len", (-F.col("_best_id").cast("bigint")).alias("neg"), "partner_name")
        found = (ways.join(best, ["_block", "_name", "score"]).join(info, ["_block", "partner_name"])
                 .groupBy("_block", "_name", "score").agg(F.max(rank).alias("k"))
                 .select("_block", "_name", "score", F.col("k.partner_name").alias("partner_name"), (-F.col("k.neg")).alias("partner_id")))
        found = found.checkpoint(eager=True)
        done = found if done is None else done.unionByName(found)
        seek = groups.select("_block", "_name").join(done, ["_block", "_name"], "left_anti")
    if done is None:
        return groups.select("_block", "_name", F.lit(0).alias("score"), F.col("_name").alias("partner_name"),
                             F.col("_best_id").cast("bigint").alias("partner_id")).limit(0)
    return done


def _second_members(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(_block, _name, second_id): the best member beside the best one."""
    rest = members.join(groups.filter("_n > 1").select("_block", "_name", "_best_id"), ["_block", "_name"]).filter("_id <> _best_id")
    return rest.groupBy("_block", "_name").agg(F.max(F.struct("_raw_len", (-F.col("_id").cast("bigint")).alias("neg"))).alias("k")).select(
        "_block", "_name", (-F.col("k.neg")).alias("second_id"))


def review_queue(records: DataFrame, key: str, name: str, block: str | None, auto_threshold: int, steward_threshold: int,
                 batch_id: str | None = None, collapse_spaces: bool = True, heavy: int = HEAVY) -> DataFrame:
    """What a steward works through: one row per record under review with its
    best partner (batch_id, key, block, name, partner id and name, score), the
    raw names as given. Where equal names are under review too (an auto
    threshold above 100) the partner is the best other member of the name."""
    members = (normalize_members(records, key, name, block, collapse_spaces)
               .filter(F.col("_block").isNotNull() & F.col("_name").isNotNull()))
    checkpoint_root(records.sparkSession)
    groups = name_groups(members).checkpoint(eager=True)
    best = best_partners(groups, auto_threshold, steward_threshold, heavy)
    rows = members.select("_block", "_name", "_id", "_block_raw", "_name_raw")
    if auto_threshold > 100 >= steward_threshold:
        equal = groups.filter("_n > 1").filter(F.length("_name") > 0).select("_block", "_name", "_best_id")
        equal = equal.join(_second_members(members, groups), ["_block", "_name"])
        rows = rows.join(equal, ["_block", "_name"], "left").join(best, ["_block", "_name"], "left")
        other = F.when(F.col("_best_id") == F.col("_id"), F.col("second_id")).otherwise(F.col("_best_id"))
        same = F.col("_best_id").isNotNull()
        rows = rows.withColumns({"score": F.when(same, F.lit(100)).otherwise(F.col("score")),
                                 "partner_id": F.when(same, other.cast("bigint")).otherwise(F.col("partner_id")),
                                 "partner_name": F.when(same, F.col("_name")).otherwise(F.col("partner_name"))}).filter("score IS NOT NULL")
    else:
        rows = rows.join(best, ["_block", "_name"])
    kind = dict(records.dtypes)[key]
    return rows.select(F.lit(batch_id).cast("string").alias("batch_id"), F.col("_id").alias(key), F.col("_block_raw").alias("block"),
                       F.col("_name_raw").alias("name"), F.col("partner_id").cast(kind).alias("best_partner_id"),
                       "partner_name", "score")


# expansion to record-level pairs (bounded inputs) ------------------------------
def expand_pairs(matches: DataFrame, records: DataFrame, key: str, name: str, block: str | None,
                 collapse_spaces: bool = True) -> DataFrame:
    """The record-level pair table (id_1 < id_2) of a name-level match table:
    borough / name of the smaller id first, per-pair recommended survivor.
    Output size is the sum of ``pair_count`` — use on bounded inputs."""
    mem = normalize_members(records, key, name, block, collapse_spaces)
    a = mem.select(F.col("_block").alias("block"), F.col("_name").alias("name_1"),
                   F.col("_id").alias("a_id"), F.col("_block_raw").alias("a_blk"),
                   F.col("_name_raw").alias("a_raw"))
    b = mem.select(F.col("_block").alias("block"), F.col("_name").alias("name_2"),
                   F.col("_id").alias("b_id"), F.col("_block_raw").alias("b_blk"),
                   F.col("_name_raw").alias("b_raw"))
    j = (matches.join(a, ["block", "name_1"]).join(b, ["block", "name_2"])
         .filter(F.col("a_id") != F.col("b_id")))
    # same-name pairs appear in both orientations: keep a_id < b_id there
    j = j.filter((F.col("name_1") != F.col("name_2")) | (F.col("a_id") < F.col("b_id")))
    first_a = F.col("a_id") < F.col("b_id")
    id1 = F.when(first_a, F.col("a_id")).otherwise(F.col("b_id"))
    id2 = F.when(first_a, F.col("b_id")).otherwise(F.col("a_id"))
    z1 = F.when(first_a, F.col("a_raw")).otherwise(F.col("b_raw"))
    z2 = F.when(first_a, F.col("b_raw")).otherwise(F.col("a_raw"))
    blk = F.when(first_a, F.col("a_blk")).otherwise(F.col("b_blk"))
    rec = (F.when(F.length(z1) > F.length(z2), id1).when(F.length(z2) > F.length(z1), id2)
           .otherwise(F.least(id1, id2)))
    return j.select("batch_id", id1.alias(f"{key}_1"), id2.alias(f"{key}_2"), blk.alias("borough"),
                    z1.alias(f"{name}_1"), z2.alias(f"{name}_2"), "score", "confidence_tier", "action",
                    rec.alias("recommended_golden_id"))


# G1 / D10 --------------------------------------------------------------------
def pending_names(matches: DataFrame) -> DataFrame:
    """(block, name) of every name in a STEWARD_REVIEW pair."""
    return (matches.filter(F.col("action") == STEWARD_REVIEW)
            .select("block", F.explode(F.array("name_1", "name_2")).alias("name"))
            .dropDuplicates())


def pending_ids(matches: DataFrame, records: DataFrame, key: str, name: str, block: str | None,
                collapse_spaces: bool = True) -> DataFrame:
    """G1: distinct ids on either side of a STEWARD_REVIEW pair, found by a
    semi-join of the members to the pending names (no pair expansion)."""
    mem = normalize_members(records, key, name, block, collapse_spaces)
    # the pending-name set is derived: AQE broadcasts it at runtime when its
    # measured size is small, else keeps the shuffle join (skew-split by AQE)
    pn = pending_names(matches).withColumnsRenamed({"block": "_block", "name": "_name"})
    return mem.join(pn, ["_block", "_name"], "left_semi").select(F.col("_id").alias(key)).dropDuplicates()


# H5 / C2 ---------------------------------------------------------------------
def stage_records(records: DataFrame, matches: DataFrame, key: str, name: str, block: str | None,
                  batch_id: str, source_file: str | None = None, collapse_spaces: bool = True) -> DataFrame:
    """H5: record-table rows for a batch: APPROVED unless the record is in a
    STEWARD_REVIEW pair (then PENDING). AUTO_MERGE pairs change nothing."""
    blk = norm_name(block) if block else F.lit("")
    pn = pending_names(matches).select(F.col("block").alias("_b"), F.col("name").alias("_nm"),
                                       F.lit(True).alias("_pending"))
    keyed = records.withColumns({"_b": blk, "_nm": norm_name(name, collapse_spaces)})
    out = keyed.join(pn, ["_b", "_nm"], "left")  # AQE picks broadcast from measured size
    return (out.withColumn("status", F.when(F.col("_pending"), F.lit(PENDING)).otherwise(F.lit(APPROVED)))
            .drop("_b", "_nm", "_pending")
            .withColumns({"batch_id": F.lit(batch_id), "source_file": F.lit(source_file).cast("string")}))


# H6 --------------------------------------------------------------------------
def apply_decisions(records: DataFrame, decisions: DataFrame, key: str,
                    attrs: tuple[str, ...] = ()) -> DataFrame:
    """H6: steward decisions (batch_id, key, decision, optional corrected
    attributes) set the status and correct values; undecided rows keep theirs.
    Only decisions with a valid status apply."""
    d = decisions.filter(F.col("decision").isin(APPROVED, REJECTED, PENDING))
    dcols = [c for c in attrs if c in d.columns]
    d = d.select("batch_id", key, F.col("decision").alias("_decision"),
                 *[F.col(c).alias(f"_fix_{c}") for c in dcols])
    j = records.join(d, ["batch_id", key], "left")
    repl = {"status": F.coalesce(F.col("_decision"), F.col("status"))}
    for c in dcols:
        repl[c] = F.coalesce(F.col(f"_fix_{c}"), F.col(c))
    return j.withColumns(repl).drop("_decision", *[f"_fix_{c}" for c in dcols])
