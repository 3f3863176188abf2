"""Exact removal of repeated byte strings by suffix sorting.

Every byte covered by a ``span``-byte string that also starts anywhere else in
the corpus (matches never cross documents) is removed.

1. Anchors: each ``span``-byte window names its least ``GRAM``-byte gram (by
   hash, leftmost of equals), so equal windows name equal anchors at equal
   offsets. Consecutive windows of one anchor form a segment. Per segment one
   narrow row (text hash, place, anchor, segment hash) is written.
2. Anchors that occur once settle their windows. Segments of an anchor that
   are all equal are copies of one another and go whole. Only the different
   segments of a repeated anchor are compared as bytes, one copy of each.
3. Those are grouped by anchor and suffix-sorted by two-stage sorting: only
   suffixes smaller than their successor are sorted directly, the rest is
   induced by one scan over the buckets of first bytes; then neighbours'
   common prefixes are computed, and a window whose common prefix with a
   neighbour reaches ``span`` is repeated.
4. The runs found are carried back to the documents and cut.

Skew: counts are partial aggregates; joins on anchors and texts are plain
equi-joins whose large side AQE may split. An anchor with more than ``HOT``
different segments is not sorted in one task: its segments are cut into blocks
of ``BLOCKS`` windows at equal offsets from the anchor and regrouped by the
hash of the bytes that all windows of a block share, at last by the hash of
the whole window, where a group is one string. Equal windows stay together in
every regrouping, so this is exact.

Documents are keyed by a 64-bit hash of the text with 16 further bits, and
segments by two independent 64-bit hashes.

Defined cases: a null text is empty; texts shorter than ``span`` lose nothing;
repeated rows (also of one id) are copies and lose all of ``span`` bytes or
more; null ids are kept as they are; an empty table gives no rows; other
columns are untouched by ``cut`` and not read otherwise.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.llm import textnum as X
from lakegov.llm.staging import drop_staged, map_arrow, staged, unused

SPAN = 200
GRAM = 32
SECTION = 1 << 21      # starts per section of a very long text
ORDER_BITS = 24        # low bits of a gram's order that hold its place in the section
HOT = 8_192            # different segments of one anchor that one task sorts
BLOCKS = (16, 1)       # windows per block when a hot anchor is regrouped
SORT_BYTES = 1 << 19   # bytes of segments sorted at once


# -- 1. anchors and segments ---------------------------------------------------
def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least gram (leftmost of equals) of every ``width`` consecutive ones."""
    n = len(h)
    low = X.U64((1 << ORDER_BITS) - 1)
    v = (h & ~low) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, ~X.U64(0))
    padded[:n] = v
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(back[:m], ahead[width - 1:width - 1 + m]) & low).astype(np.int64)


def segments(raw: np.ndarray, at: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """(document, first window, number of windows, anchor's offset in the
    segment, anchor hash, segment hash) of every segment of a slice."""
    gram = min(span, max(4, span * GRAM // SPAN))
    width = span - gram + 1
    parts = []
    for base in range(0, max(1, len(raw) - span + 1), SECTION):
        piece = raw[base:base + SECTION + span - 1]
        if len(piece) < span:
            break
        sums = X.PrefixHash(piece)
        n = len(piece) - gram + 1
        h = X.finish((sums.sums[gram:] - sums.sums[:n]) * sums.down[:n])
        anchor = sliding_least(h, width)
        # windows inside one document
        inside = np.zeros(len(anchor) + 1, np.int64)
        begin = np.clip(at[:-1] - base, 0, len(anchor))
        end = np.clip(at[1:] - base - span + 1, begin, len(anchor))
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        if not len(starts):
            continue
        a = anchor[starts]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1)])
        s, last = starts[first], starts[np.r_[first[1:], len(starts)] - 1]
        p = a[first]
        doc = np.searchsorted(at, s + base, "right") - 1
        parts.append((doc, s + base - at[doc], last - s + 1, p - s, h[p].view(np.int64), sums.of(s, last + span).view(np.int64)))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _check(text: Column) -> Column:
    return F.pmod(F.crc32(text), F.lit(1 << 16))


def segment_rows(docs: DataFrame, span: int = SPAN, text: str = "text") -> DataFrame:
    """(d, at, rel, anchor, seg): text hash; place, number of windows and 16
    check bits of the text in one number; anchor's offset; the two hashes."""
    def run(batches):
        for b in batches:
            raw, at = X.text_bytes(b["t"])
            d, check = b["d"].to_numpy(), b["c"].to_numpy()
            for lo, _, r, a in X.slices(raw, at):
                doc, s, n, rel, anchor, seg = segments(r, a, span)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d[lo + doc]), pa.array((s << 32) | (n << 16) | check[lo + doc]),
                     pa.array(rel.astype(np.int16)), pa.array(anchor), pa.array(seg)],
                    names=["d", "at", "rel", "anchor", "seg"])

    t = _text(text)
    return map_arrow(docs.select(t.alias("t"), F.xxhash64(t).alias("d"), _check(t).alias("c")), run,
                     "d long, at long, rel short, anchor long, seg long")


# -- 3. two-stage suffix sorting -----------------------------------------------
def two_stage_order(buf: bytes, begin: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all strings' windows (and the few suffixes behind them that
    inducing needs) in the order of their first ``depth`` bytes or more. String
    ``k`` is ``buf[begin[k]:end[k]]``; one byte behind each stands for its end,
    which is smaller than any byte."""
    n = len(buf)
    t = np.frombuffer(buf, np.uint8).astype(np.int16) + 1
    t[end] = 0
    # type: smaller than its successor, or larger (ends count as smaller)
    step = np.zeros(n, np.int16)
    step[:-1] = t[1:] - t[:-1]
    step[end] = 1
    decided = np.where(step != 0, np.arange(n), n - 1)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    smaller = step[decided] > 0
    next_smaller = np.minimum.accumulate(np.where(smaller, np.arange(n), n - 1)[::-1])[::-1]
    # only windows are wanted; inducing needs what follows up to the next smaller one
    until = next_smaller[np.maximum(end - depth, begin)]
    wanted = np.zeros(n + 1, np.int8)
    np.add.at(wanted, begin, 1)
    np.add.at(wanted, until + 1, -1)
    wanted = np.cumsum(wanted[:-1]) > 0
    # first stage: sort the smaller ones directly
    direct = np.flatnonzero(wanted & smaller)
    stop = np.minimum(direct + depth, end[np.searchsorted(end, direct)])
    keys = [buf[a:b] for a, b in zip(direct.tolist(), stop.tolist())]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    # second stage: scan the buckets of first letters in order; whoever precedes
    # a scanned suffix and is larger than it enters its own bucket next
    first_of = t[direct]
    cuts = np.searchsorted(first_of, np.arange(258))
    larger = wanted & ~smaller
    starts = np.zeros(n, bool)
    starts[begin] = True
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    order = []

    def before(of: np.ndarray) -> np.ndarray:
        of = of[~starts[of]] - 1
        return of[larger[of]]

    for letter in range(257):
        scanned = []
        new = np.concatenate(waiting[letter]) if waiting[letter] else direct[:0]
        while len(new):
            scanned.append(new)
            ahead = before(new)
            same = t[ahead] == letter      # runs of one letter go into the bucket being scanned
            new = ahead[same]
        scanned.append(direct[cuts[letter]:cuts[letter + 1]])
        bucket = np.concatenate(scanned)
        if not len(bucket):
            continue
        order.append(bucket)
        ahead = before(bucket)
        ahead = ahead[t[ahead] > letter]
        into = t[ahead]
        by = np.argsort(into, kind="stable")
        into, ahead = into[by], ahead[by]
        edges = np.flatnonzero(np.r_[True, into[1:] != into[:-1]]) if len(into) else []
        for lo, hi in zip(edges, [*edges[1:], len(into)]):
            waiting[int(into[lo])].append(ahead[lo:hi])
        waiting[letter] = []
    return np.concatenate(order) if order else direct


def repeated_windows(contents: list[bytes], span: int = SPAN) -> list[np.ndarray]:
    """Per string, the windows (by start) whose common prefix with a neighbour in suffix order reaches ``span``."""
    sizes = np.array([len(c) for c in contents], np.int64)
    end = np.cumsum(sizes + 1) - 1
    begin = end - sizes
    buf = b"\0".join(contents) + b"\0"
    order = two_stage_order(buf, begin, end, span)
    which = np.searchsorted(end, order)
    order = order[order + span <= end[which]]
    # adjacent common prefixes, eight bytes at a time
    raw = np.frombuffer(buf + b"\0" * 8, np.uint8)
    words = np.ndarray((len(buf),), np.uint64, raw, strides=(1,))
    a, b = order[:-1], order[1:]
    for at in range(0, span, 8):
        if span - at >= 8:
            same = words[a + at] == words[b + at]
        else:
            same = np.ones(len(a), bool)
            for k in range(at, span):
                same &= raw[a + k] == raw[b + k]
        a, b = a[same], b[same]
    hit = np.unique(np.concatenate((a, b)))
    cuts = np.searchsorted(hit, begin[1:])
    return [x - s for x, s in zip(np.split(hit, cuts), begin.tolist())]


def cover(starts: np.ndarray, span: int) -> tuple[list[int], list[int]]:
    """Maximal runs of bytes that the windows cover."""
    if not len(starts):
        return [], []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + span)
    return starts[np.r_[0, gap + 1]].tolist(), (starts[np.r_[gap, len(starts) - 1]] + span).tolist()


RUNS = "anchor long, seg long, runs array<struct<a: int, b: int>>"
_RUN_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _sort_groups(span: int):
    """Task function: (anchor, seg, n, content) sorted by anchor to the runs of each segment."""
    def solve(rows):
        found = repeated_windows([r[3] for r in rows], span)
        out = []
        for (anchor, seg, n, content), starts in zip(rows, found):
            a, b = ([0], [len(content)]) if n > 1 else cover(starts, span)
            if a:
                out.append((anchor, seg, [{"a": x, "b": y} for x, y in zip(a, b)]))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
             pa.array([r[2] for r in out], _RUN_TYPE)], names=["anchor", "seg", "runs"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for r in zip(*(b[k].to_pylist() for k in ("anchor", "seg", "n", "content"))):
                if size >= SORT_BYTES and r[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[3])
        if held:
            yield solve(held)

    return run


def _regroup(span: int, block: int):
    """Task function: segments of hot anchors to blocks of ``block`` windows at
    equal offsets, keyed by the bytes that all windows of such a block share."""
    def run(batches):
        names = ["anchor", "seg", "n", "rel", "content", "of_anchor", "of_seg", "of_at"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
        for b in batches:
            out = [[] for _ in names]
            for anchor, seg, n, rel, content in zip(*(b[k].to_pylist() for k in ("anchor", "seg", "n", "rel", "content"))):
                windows, s = len(content) - span + 1, 0
                while s < windows:
                    offset = rel - s                       # of the anchor in window s
                    low = offset // block * block
                    stop = min(windows, rel - low + 1)     # windows s .. stop-1 have offsets in [low, low + block)
                    sub = content[s:stop - 1 + span]
                    # shared by all windows whose offsets lie in the block: from the last one's start to the first one's end
                    core = content[rel - low: rel - low - block + 1 + span]
                    key = hashlib.blake2b(b"%d %d " % (anchor, low) + core, digest_size=8).digest()
                    sub_key = hashlib.blake2b(sub, digest_size=8).digest()
                    row = (int.from_bytes(key, "little", signed=True), int.from_bytes(sub_key, "little", signed=True), n,
                           rel - s, sub, anchor, seg, s)
                    for col, v in zip(out, row):
                        col.append(v)
                    s = stop
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return run


def resolve(contents: DataFrame, span: int = SPAN, hot: int = HOT, blocks=BLOCKS) -> DataFrame:
    """Runs of repeated bytes of each different segment (anchor, seg, n, rel, content)."""
    sizes = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("members"))
    large = staged(sizes.filter(F.col("members") > hot).select("anchor"), "hot-anchors")
    any_hot = bool(large.head(1))
    usual = contents.join(large, "anchor", "left_anti") if any_hot and blocks else contents
    sort = usual.select("anchor", "seg", "n", "content").repartition("anchor").sortWithinPartitions("anchor")
    found = staged(map_arrow(sort, _sort_groups(span), RUNS), "runs")
    if not any_hot or not blocks:
        return found
    parts = staged(map_arrow(contents.join(large, "anchor", "left_semi"), _regroup(span, blocks[0]),
                             "anchor long, seg long, n long, rel short, content binary, of_anchor long, of_seg long, of_at int"),
                   "hot-blocks")
    each = parts.groupBy("anchor", "seg").agg(F.sum("n").alias("n"), F.first("rel").alias("rel"), F.first("content").alias("content"))
    inner = resolve(staged(each, "hot-contents"), span, hot, blocks[1:])
    back = (parts.select("anchor", "seg", "of_anchor", "of_seg", "of_at").join(inner, ["anchor", "seg"])
            .select(F.col("of_anchor").alias("anchor"), F.col("of_seg").alias("seg"),
                    F.transform("runs", lambda r: F.struct((r["a"] + F.col("of_at")).alias("a"), (r["b"] + F.col("of_at")).alias("b"))).alias("runs")))
    return staged(found.unionByName(back), "runs-with-hot")


# -- 2., 4. the whole job ----------------------------------------------------------
def repeated_runs(docs: DataFrame, span: int = SPAN, hot: int = HOT, text: str = "text") -> DataFrame:
    """(d, runs): per different text (by hash) its repeated byte runs as (check, start, end), unmerged."""
    segs = staged(segment_rows(docs, span, text), "segments")
    repeated = (segs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("lo"), F.max("seg").alias("hi"))
                .filter("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")))
    repeated = staged(repeated, "repeated-anchors")   # a join of two plain exchanges, which AQE can split
    marked = staged(segs.join(repeated, "anchor"), "repeated-segments")
    drop_staged(segs)
    # one copy of each different segment of the anchors that have several
    place = F.struct("d", "at")
    different = (marked.filter("mixed").groupBy("anchor", "seg")
                 .agg(F.count(F.lit(1)).alias("n"), F.first("rel").alias("rel"), F.min(place).alias("p")))
    asked = different.groupBy(F.col("p.d").alias("d")).agg(F.collect_list(F.struct("p.at", "anchor", "seg", "n", "rel")).alias("asked"))
    asked = staged(asked, "asked-segments")   # a join of two plain exchanges, which AQE can split
    t = _text(text)
    texts = docs.select(t.alias("t"), F.xxhash64(t).alias("d"), _check(t).alias("c")).filter(F.octet_length("t") >= span)

    def take(batches):
        for b in batches:
            out = [[] for _ in range(5)]
            for raw, check, asks in zip(b["t"], b["c"].to_pylist(), b["asked"].to_pylist()):
                raw = raw.as_py().encode()
                for x in asks:
                    if x["at"] & 0xFFFF == check:
                        s = x["at"] >> 32
                        for col, v in zip(out, (x["anchor"], x["seg"], x["n"], x["rel"], raw[s:s + (x["at"] >> 16 & 0xFFFF) - 1 + span])):
                            col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.binary()))],
                names=["anchor", "seg", "n", "rel", "content"])

    contents = map_arrow(texts.join(asked, "d").select("t", "c", "asked"), take,
                         "anchor long, seg long, n long, rel short, content binary")
    contents = staged(contents.dropDuplicates(["anchor", "seg"]), "contents")
    runs = resolve(contents, span, hot)
    whole = marked.filter("NOT mixed").select("d", "at", F.expr(
        f"array(named_struct('a', 0, 'b', cast(shiftright(at, 16) & 65535 as int) - 1 + {span}))").alias("runs"))
    parts = marked.filter("mixed").select("d", "at", "anchor", "seg").join(runs, ["anchor", "seg"]).select("d", "at", "runs")
    rows = whole.unionByName(parts).select("d", (F.col("at").bitwiseAND(0xFFFF)).alias("c"), F.shiftright("at", 32).alias("s"),
                                           F.explode("runs").alias("r"))
    each = rows.select("d", F.struct("c", (F.col("s") + F.col("r.a")).alias("a"), (F.col("s") + F.col("r.b")).alias("b")).alias("x"))
    out = staged(each.groupBy("d").agg(F.collect_set("x").alias("runs")), "document-runs")
    drop_staged(marked)
    drop_staged(asked)
    drop_staged(contents)
    return out


def _merged(check: int, runs) -> tuple[np.ndarray, np.ndarray]:
    mine = sorted((r["a"], r["b"]) for r in runs or () if r["c"] == check)
    a, b = [], []
    for x, y in mine:
        if b and x <= b[-1]:
            b[-1] = max(b[-1], y)
        else:
            a.append(x)
            b.append(y)
    return a, b


def _with_runs(docs: DataFrame, runs: DataFrame, columns: list[str], text: str) -> tuple[DataFrame, list[str]]:
    """The columns beside (text, its check, its runs) under the names that are returned."""
    t, names = _text(text), unused(docs, "body", "check", "found", "digest")
    body, check, found, digest = names
    d = docs.select(*columns, F.col(text).alias(body), F.xxhash64(t).alias(digest), _check(t).alias(check))
    return d.join(runs.select(F.col("d").alias(digest), F.col("runs").alias(found)), digest, "left").drop(digest), names


def report(docs: DataFrame, runs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    def run(batches):
        for b in batches:
            out = []
            for t, check, found in zip(b[names[0]], b[names[1]].to_pylist(), b[names[2]].to_pylist()):
                raw = (t.as_py() or "").encode()
                a, e = _merged(check, found)
                kept = b"".join(raw[x:y] for x, y in zip([0, *e], [*a, len(raw)]))
                out.append((len(raw), len(raw) - len(kept), len(a), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b[id_col], *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                             names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    d = docs.select(F.col(id_col).cast("long").alias(id_col), text)
    rows, names = _with_runs(d, runs, [id_col], text)
    return map_arrow(rows, run,
                     f"{id_col} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def suffix_dedup(docs: DataFrame, span: int = SPAN, hot: int = HOT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    return report(docs, repeated_runs(docs, span, hot, text), id_col, text)


def cut(docs: DataFrame, span: int = SPAN, hot: int = HOT, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated bytes cut from the text (null stays null; a
    character cut in two goes whole) and ``length``, if given, made anew."""
    columns = [c for c in docs.columns if c != text]
    fields = [f for f in docs.schema if f.name != text]

    def run(batches):
        for b in batches:
            out = []
            for t, check, found in zip(b[names[0]], b[names[1]].to_pylist(), b[names[2]].to_pylist()):
                t = t.as_py()
                if t is not None:
                    raw = t.encode()
                    a, e = _merged(check, found)
                    t = b"".join(raw[x:y] for x, y in zip([0, *e], [*a, len(raw)])).decode(errors="ignore")
                out.append(t)
            yield pa.RecordBatch.from_arrays([*(b[c] for c in columns), pa.array(out, pa.string())], names=[*columns, text])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{text}` string"])
    rows, names = _with_runs(docs, repeated_runs(docs, span, hot, text), columns, text)
    done = map_arrow(rows, run, schema)
    if length in docs.columns:
        done = done.withColumn(length, F.when(F.col(text).isNotNull(), F.char_length(text)).cast(docs.schema[length].dataType))
    return done.select(*docs.columns)
