"""Cross-tokenizer alignment with external spill counting of token pairs.

Every text is encoded by two tokenizers whose tokens cover the same bytes. Byte
offsets where tokens of both end cut a text into groups; an A and a B token
whose byte ranges overlap are linked. A pair of token ids counts in how many
documents of the corpus it is linked.

1. A task encodes runs of whole documents (``RUN_BYTES`` of text, or one longer
   document). A run's pairs are sorted side-major (radix of the A id, A id,
   B id) and numbered; it is spilled as zstd frames: per radix the sorted pairs
   with the number of the run's documents that hold each, and the
   pair-document records (per document its sorted pair numbers and how often
   it links each). A pair that is in a third of all documents is one number per run.
2. The pair frames are radix-partitioned by A id. A task merges the runs of one
   radix with a heap over the frames at hand, one frame per run in memory, and
   sums each pair. At most ``FAN`` runs meet in one merge; more are merged in
   groups first, level by level.
3. In the last merge all pairs of an A id stand together, so side-major order
   yields each A id's largest count; counts and "is the largest" stream back to
   every run in the order of its own numbering, down the same levels.
4. A run's records meet its returned counts, and every document gets its sums.

Memory: a task of step 1 and 4 holds one run, a merge the summed pairs of one
radix of A ids (bounded by the vocabularies) and a frame per run. Nothing is
gathered on the driver but the number of runs.

Defined cases: null and empty texts have no tokens, nor do texts whose joined
tokens are not the text behind one space (a tokenizer that normalises);
strings of special tokens inside texts are ordinary text; repeated rows are
documents of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegov.llm.staging import map_arrow, staged

RUN_BYTES = 4 << 20
RADIX = 64        # buckets of A ids
FRAME = 4096      # pairs of one zstd frame
FAN = 256         # runs that one merge takes

#: The splitting pattern of the byte-level vocabulary (fixed).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# -- tokenizers ----------------------------------------------------------------
class Pair:
    """The two tokenizers: ids of a text behind one space, and the bytes of each id."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_path, "rb"))}
        self.a = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        bytes_a = dict(zip(ranks.values(), ranks))
        self.bytes_a = [bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        n = max(len(self.bytes_a), len(self.bytes_b))
        #: an id behind a comma, a semicolon, a bar
        self.said = [s + b"%d" % i for s in (b",", b";", b"|") for i in range(n)]
        self.n_said = n

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Per text the ids of both sides, or None where a side does not give the text back."""
        out: list = [None] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        for i, b in zip(some, self.b.encode([texts[i] for i in some], num_threads=1)):
            want = b" " + texts[i].encode()
            if b"".join(map(self.bytes_b.__getitem__, b)) == want:
                a = np.array(self.a.encode_ordinary(" " + texts[i]), np.int64)
                if int(self.size_a[a].sum()) == len(want):
                    out[i] = (a, np.array(b, np.int64))
        return out


_PAIRS: dict[tuple[str, str], Pair] = {}


def tokenizers(byte_path: str, piece_path: str) -> Pair:
    """One pair per Python worker."""
    key = (byte_path, piece_path)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(*key)
    return _PAIRS[key]


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


# -- zstd frames -----------------------------------------------------------------
def pack(x: np.ndarray) -> bytes:
    """One frame: the bytes of the numbers by place (low bytes first), compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(frame: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def pack_steps(x: np.ndarray) -> bytes:
    """A frame of non-decreasing numbers, as steps."""
    return pack(np.diff(x, prepend=x[:1] * 0).astype(x.dtype))


def unpack_steps(frame: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(frame, dtype), dtype=dtype)


def side_major(a: np.ndarray, b: np.ndarray, radix: int) -> np.ndarray:
    """Sort key of a pair: radix of the A id, A id, B id, 20 bits each."""
    return ((a % radix) << 40) | (a << 20) | b


# -- step 1: runs ------------------------------------------------------------------
def align(ids: list[tuple[np.ndarray, np.ndarray]], pair: Pair):
    """For texts that both sides cover: (per text n_a, n_b, n_groups, n_links,
    digest of the groups; A id, B id and text of every link, in order)."""
    a, b = np.concatenate([x for x, _ in ids]), np.concatenate([x for _, x in ids])
    na, nb = np.array([len(x) for x, _ in ids]), np.array([len(x) for _, x in ids])
    end_a, end_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    stop_a, stop_b = np.zeros(end_a[-1] + 1, bool), np.zeros(end_a[-1] + 1, bool)
    stop_a[end_a], stop_b[end_b] = True, True
    ends = np.flatnonzero(stop_a | stop_b)
    # links: the stretches between neighbouring ends, each inside one token of both sides
    link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    text_end = end_a[np.cumsum(na) - 1]
    link_text = np.searchsorted(text_end, ends)
    group_ends = ends[stop_a[ends] & stop_b[ends]]
    n_links = np.bincount(link_text, minlength=len(ids))
    n_groups = np.bincount(np.searchsorted(text_end, group_ends), minlength=len(ids))
    # all tokens in the order of the groups, A before B in each
    group_a, group_b = np.searchsorted(group_ends, end_a), np.searchsorted(group_ends, end_b)
    in_a, in_b = (np.bincount(g, minlength=len(group_ends)) for g in (group_a, group_b))
    first_a, first_b = np.r_[True, group_a[1:] != group_a[:-1]], np.r_[True, group_b[1:] != group_b[:-1]]
    said = np.empty(len(a) + len(b), np.int64)
    said[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a + first_a * pair.n_said
    said[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b + first_b * 2 * pair.n_said
    cuts = np.r_[0, np.cumsum(na + nb)]
    word = pair.said.__getitem__
    digests = [hashlib.sha256(b"".join(map(word, said[lo:hi].tolist()))[1:]).digest() for lo, hi in zip(cuts[:-1], cuts[1:])]
    return na, nb, n_groups, n_links, digests, a[link_a], b[link_b], link_text


RUN_ROW = pa.schema([("run", pa.string()), ("radix", pa.int32()), ("numbers", pa.list_(pa.binary())),
                     ("counts", pa.list_(pa.binary()))])


def _row(run: str, radix: int, numbers: list[bytes], counts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([run]), pa.array([radix], pa.int32()), pa.array([numbers], pa.list_(pa.binary())),
                                       pa.array([counts], pa.list_(pa.binary()))], schema=RUN_ROW)


def pair_rows(run: str, keys: np.ndarray, counts: np.ndarray, radix: int) -> Iterator[pa.RecordBatch]:
    """A run's sorted pairs as one row per radix, a frame per ``FRAME`` pairs."""
    border = np.searchsorted(keys, np.arange(radix + 1) << 40)
    for r in range(radix):
        spans = [(lo, min(lo + FRAME, border[r + 1])) for lo in range(border[r], border[r + 1], FRAME)]
        if spans:
            yield _row(run, r, [pack_steps(keys[lo:hi]) for lo, hi in spans], [pack(counts[lo:hi]) for lo, hi in spans])


def run_rows(ids: list[int | None], texts: list[str | None], pair: Pair, radix: int) -> Iterator[pa.RecordBatch]:
    """The rows of one run; radix -1 holds the documents and their records."""
    run = uuid.uuid4().hex
    encoded = pair.encode([t or "" for t in texts])
    good = [i for i, e in enumerate(encoded) if e is not None]
    figures = np.zeros((4, len(texts)), np.int64)
    said = [b""] * len(texts)
    per_doc, steps, times = np.zeros(len(texts), np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    if good:
        na, nb, n_groups, n_links, digests, a, b, doc = align([encoded[i] for i in good], pair)
        figures[:, good] = na, nb, n_groups, n_links
        for i, d in zip(good, digests):
            said[i] = d
        key = side_major(a, b, radix)
        order = np.argsort(key, kind="stable")                  # documents stay in order inside a pair
        key, doc = key[order], doc[order]
        new_pair = np.r_[True, key[1:] != key[:-1]]
        new_record = new_pair | np.r_[True, doc[1:] != doc[:-1]]
        number = np.cumsum(new_pair) - 1
        at = np.flatnonzero(new_record)
        counts = np.bincount(number[at])                        # documents of the run that hold the pair
        yield from pair_rows(run, key[new_pair], counts.astype(np.uint64), radix)
        times = np.diff(np.r_[at, len(key)]).astype(np.uint32)
        back = np.argsort(doc[at], kind="stable")               # records by document, pair numbers ascending
        numbers, times = number[at][back].astype(np.uint32), times[back]
        steps = np.diff(numbers, prepend=numbers[:1] * 0)       # wraps where a document begins, and back
        per_doc[good] = np.bincount(doc[at], minlength=len(good))
    known = np.array([i is not None for i in ids])
    frames = [pack(np.array([i or 0 for i in ids], np.int64)), pack(known.view(np.uint8)), *map(pack, figures), pack(per_doc),
              b"".join(s or bytes(32) for s in said)]
    yield _row(run, -1, frames, [pack(steps.astype(np.uint32)), pack(times)])


def runs(docs: DataFrame, byte_path: str, piece_path: str, radix: int = RADIX, run_bytes: int = RUN_BYTES,
         id_col: str = "doc_id", text: str = "text") -> DataFrame:
    def spill(batches):
        pair = tokenizers(byte_path, piece_path)
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b["id"].to_pylist(), b["t"]):
                t = t.as_py()
                if texts and size + len(t or "") > run_bytes:
                    yield from run_rows(ids, texts, pair, radix)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t or "") + 16
        if texts:
            yield from run_rows(ids, texts, pair, radix)

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"))
    return map_arrow(d, spill, "run string, radix int, numbers array<binary>, counts array<binary>")


# -- steps 2 and 3: merges and what streams back ----------------------------------------
def merge(streams: list[tuple[list[bytes], list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct pairs of all streams and their summed counts. The heap
    holds, per stream, the last pair of the frame at hand; all frames are
    consumed up to the smallest of these, and the stream it belongs to loads its next frame."""
    hand: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))] * len(streams)
    heap: list[tuple[int, int]] = []
    following = [0] * len(streams)

    def load(s: int) -> None:
        numbers, counts = streams[s]
        if following[s] < len(numbers):
            k = unpack_steps(numbers[following[s]], np.int64)
            hand[s] = (k, unpack(counts[following[s]], np.uint64))
            following[s] += 1
            heapq.heappush(heap, (int(k[-1]), s))

    for s in range(len(streams)):
        load(s)
    keys, counts = [], []
    while heap:
        limit, _ = heap[0]
        taken_k, taken_c = [], []
        for s, (k, c) in enumerate(hand):
            n = int(np.searchsorted(k, limit, "right"))
            if n:
                taken_k.append(k[:n])
                taken_c.append(c[:n])
                hand[s] = (k[n:], c[n:])
        k, c = np.concatenate(taken_k), np.concatenate(taken_c)
        order = np.argsort(k, kind="stable")
        k, c = k[order], c[order]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        keys.append(k[first])
        counts.append(np.add.reduceat(c, first))
        while heap and heap[0][0] == limit:
            load(heapq.heappop(heap)[1])
    return (np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def largest_per_a(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 where a pair's count is the largest of its A id, in side-major order."""
    a = keys >> 20
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    most = np.maximum.reduceat(counts, first)
    return (counts == np.repeat(most, np.diff(np.r_[first, len(keys)]))).astype(np.uint8)


def _by_group(batches, fields: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of one (radix, grp) at a time from a sorted stream."""
    now, rows = None, []
    for b in batches:
        for r in zip(*(b[f].to_pylist() for f in fields)):
            if r[:2] != now and rows:
                yield now, rows
                rows = []
            now = r[:2]
            rows.append(r[2:])
    if rows:
        yield now, rows


def _grouped(level: DataFrame, groups: int) -> DataFrame:
    grp = F.lit("all") if groups == 1 else F.pmod(F.xxhash64("run"), F.lit(groups)).cast("string")
    return level.withColumn("grp", grp)


def _answers(run: str, radix: int, numbers: list[bytes], keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    own = np.concatenate([unpack_steps(n, np.int64) for n in numbers])
    at = np.searchsorted(keys, own)
    return _row(run, radix, [pack(best[at])], [pack(counts[at])])


FIELDS = "run string, radix int, numbers array<binary>, counts array<binary>"


def returned_counts(level: DataFrame, fan: int = FAN, depth: int = 0) -> DataFrame:
    """(run, radix, numbers: best flags, counts: corpus-wide counts) in the order of each run's pairs."""
    k = level.select("run").distinct().count()
    groups = -(-k // fan)
    grouped = _grouped(level, groups).select("radix", "grp", "run", "numbers", "counts")
    order = ["radix", "grp", "run", "numbers", "counts"]
    if groups <= 1:
        def last(batches):
            for (radix, _), rows in _by_group(batches, order):
                keys, counts = merge([(n, c) for _, n, c in rows])
                best = largest_per_a(keys, counts)
                for run, numbers, _ in rows:
                    yield _answers(run, radix, numbers, keys, counts, best)

        return staged(map_arrow(grouped.repartition("radix").sortWithinPartitions("radix"), last, FIELDS), "pair-counts")

    def up(batches):
        for (radix, grp), rows in _by_group(batches, order):
            keys, counts = merge([(n, c) for _, n, c in rows])
            spans = [(lo, lo + FRAME) for lo in range(0, len(keys), FRAME)]
            yield _row(f"{depth}-{grp}", radix, [pack_steps(keys[lo:hi]) for lo, hi in spans], [pack(counts[lo:hi]) for lo, hi in spans])

    merged = staged(map_arrow(grouped.repartition("radix", "grp").sortWithinPartitions("radix", "grp"), up, FIELDS), f"merged-{depth}")
    above = returned_counts(merged, fan, depth + 1)
    parent = merged.select("radix", F.col("run").alias("grp"), F.col("numbers").alias("pairs")).join(
        above.select("radix", F.col("run").alias("grp"), F.col("numbers").alias("best"), F.col("counts").alias("sums")), ["radix", "grp"])
    none = F.lit(None).cast("array<binary>")
    rows = parent.select("radix", "grp", F.lit(None).cast("string").alias("run"), "pairs", "best", "sums").unionByName(
        grouped.select("radix", F.concat(F.lit(f"{depth}-"), "grp").alias("grp"), "run", F.col("numbers").alias("pairs"),
                       none.alias("best"), none.alias("sums")))

    def down(batches):
        now = None
        for b in batches:
            for radix, grp, run, pairs, best, sums in zip(*(b[f].to_pylist() for f in ("radix", "grp", "run", "pairs", "best", "sums"))):
                if run is None:      # the group's own row stands first
                    now = (np.concatenate([unpack_steps(p, np.int64) for p in pairs]),
                           np.concatenate([unpack(s, np.uint64) for s in sums]), np.concatenate([unpack(x, np.uint8) for x in best]))
                else:
                    yield _answers(run, radix, pairs, *now)

    return staged(map_arrow(rows.repartition("radix", "grp").sortWithinPartitions("radix", "grp", F.col("run").asc_nulls_first()), down, FIELDS),
                  f"counts-{depth}")


# -- step 4 -----------------------------------------------------------------------------
OUT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def document_sums(spilled: DataFrame, answers: DataFrame, id_col: str = "doc_id") -> DataFrame:
    def finish(frames: list[bytes], records: list[bytes], best: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        ids, known = unpack(frames[0], np.int64), unpack(frames[1], np.uint8).astype(bool)
        figures = [unpack(f, np.int64) for f in frames[2:6]]
        per_doc, said = unpack(frames[6], np.int64), frames[7]
        numbers, times = np.cumsum(unpack(records[0], np.uint32), dtype=np.uint32), unpack(records[1], np.uint32).astype(np.int64)
        n_best, count_sum = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        some = np.flatnonzero(per_doc)
        if len(some):
            at = (np.cumsum(per_doc) - per_doc)[some]
            flag, count = np.concatenate(best), np.concatenate(counts).astype(np.int64)
            n_best[some] = np.add.reduceat(flag[numbers] * times, at)
            count_sum[some] = np.add.reduceat(count[numbers] * times, at)
        digests = [said[32 * i:32 * i + 32].hex() if n else "" for i, n in enumerate(figures[0])]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=~known), *(pa.array(x) for x in (*figures, n_best, count_sum)), pa.array(digests)],
            names=[id_col, *OUT, "groups_sha256"])

    def run(batches):
        now, held, best, counts = None, None, [], []
        for b in batches:
            for name, radix, numbers, sums in zip(*(b[f].to_pylist() for f in ("run", "radix", "numbers", "counts"))):
                if radix == -1:      # a run's documents stand first
                    if held:
                        yield finish(*held, best, counts)
                    held, best, counts = (numbers, sums), [], []
                else:
                    best.append(unpack(numbers[0], np.uint8))
                    counts.append(unpack(sums[0], np.uint64))
        if held:
            yield finish(*held, best, counts)

    rows = spilled.filter("radix = -1").unionByName(answers)
    schema = ", ".join([f"`{id_col}` long", *(f"{x} long" for x in OUT), "groups_sha256 string"])
    return map_arrow(rows.repartition("run").sortWithinPartitions("run", "radix"), run, schema)


def token_alignment(docs: DataFrame, byte_path: str, piece_path: str, radix: int = RADIX, run_bytes: int = RUN_BYTES,
                    fan: int = FAN, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``."""
    spilled = staged(runs(docs, byte_path, piece_path, radix, run_bytes, id_col, text), "token-runs")
    answers = returned_counts(spilled.filter("radix >= 0"), fan)
    return staged(document_sums(spilled, answers, id_col), "token-alignment")
