"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

A document is contaminated by an item if some part of it is within
``max_edit`` edits (a share of the item's length) of the item. Both sides are
lower-cased (ASCII) with white space collapsed.

Every document is searched whole, in three steps inside the task:

1. windows: item-sized windows start at words. A window is looked at if it
   shares enough word pairs with an item near one diagonal: ``e`` edits leave at
   least ``W - 1 - 3e`` of an item's ``W - 1`` pairs whole, so no window within
   the budget is lost where that is two or more. Where it is less, and for
   items of fewer than four words (one word, in a script without spaces), the
   item is cut into ``e + 1`` pieces, of which ``e`` edits leave one whole: its
   first ``GRAM`` bytes are looked up at every byte of the text, and what holds
   the piece goes to step 3 at once, so that nothing within the budget is lost.
   Items shorter than ``GRAM`` bytes are looked up as whole words.
2. CGK and LSH: a random walk copies a window into a longer string, moving on in
   the window by a random bit that depends on the step and the letter, so that
   few edits become few differing positions. ``WALKS`` walks with ``BANDS`` bands
   of ``SAMPLES`` sampled positions each give ``WALKS * BANDS`` band keys (size,
   walk, band, sampled letters). The items' keys are the buckets of one sorted
   table; every item found in a bucket of the window is a candidate,
   whichever item's word pairs led to the window. Measured recall of the whole search at the
   full edit budget, random edits: above 0.95 (asserted in the tests).
3. exact verification: the smallest edit distance between the item and any
   part of the text around the window (bit-parallel dynamic program).

The benchmark is a stated query set; it is taken in blocks of about
``BLOCK`` items (by hash), one pass over the documents per block, so that what
a task holds has a fixed bound.

Defined cases: null and empty texts match nothing; items without words are
skipped; null ids are reported as they are; repeated rows are reported each;
equal items are each reported; empty tables give no rows; other columns are
not read (``clean`` keeps them all).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegov.llm import textnum as X
from lakegov.llm.staging import map_arrow

MAX_EDIT = 0.05
WALKS, BANDS, SAMPLES = 8, 10, 5
GRAM = 8
BLOCK = 5_000
SEED = 20_177

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Spreads eight bytes over the sieve of grams.
_SPREAD = X.U64(0x9E3779B97F4A7C15)


def moves(walk: int, step: int, letter: np.ndarray) -> np.ndarray:
    """The walk's random bit at a step, by letter."""
    at = (walk * 0xD6E8FEB86659FD93 + (step + 1) * 0xA24BAED4963EE407 + SEED) % (1 << 64)
    return (X.finish((letter.astype(X.U64) + X.U64(1)) * _SPREAD + X.U64(at)) & X.U64(1)).astype(np.int64)


def normal(text: str | None) -> bytes:
    """ASCII lower case, words joined by one space."""
    return b" ".join((text or "").encode().lower().split())


def edit_distance_within(pattern: str, text: str) -> int:
    """Least edits between ``pattern`` and any part of ``text``: one column of
    the table at a time, its differences held in the bits of two numbers."""
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        where[ch] = where.get(ch, 0) | (1 << i)
    rises, falls, cost = mask, 0, m
    best = m
    for ch in text:
        eq = where.get(ch, 0)
        across = (((eq & rises) + rises) ^ rises) | eq
        diag = across | falls
        up = falls | (mask & ~(across | rises))
        down = rises & across
        if up & top:
            cost += 1
        elif down & top:
            cost -= 1
        up, down = (up << 1) & mask, (down << 1) & mask   # a part may begin anywhere: the first row is 0
        rises = down | (mask & ~(diag | up))
        falls = up & diag
        if cost < best:
            best = cost
    return best


class Items:
    """One block of benchmark items with their lookup tables."""

    def __init__(self, rows: list[tuple[int, str]], max_edit: float = MAX_EDIT):
        pairs = [(i, normal(t)) for i, t in rows]
        pairs = [(i, b) for i, b in pairs if b]
        self.ids = [i for i, _ in pairs]
        self.text = [b for _, b in pairs]
        self.string = [b.decode() for b in self.text]
        self.budget = np.array([int(max_edit * len(s)) for s in self.string], np.int64)
        self.size = np.array([len(b) for b in self.text], np.int64)
        raw = np.frombuffer(b"".join(self.text), np.uint8)
        at = np.r_[0, np.cumsum(self.size)].astype(np.int64)
        starts, ends, first = X.words(raw, at)
        n_words = np.diff(first)
        self.shift, self.slack = 2 * self.budget, max_edit
        by_word = n_words < 4
        self.need = np.where(by_word, np.maximum(1, n_words - 2 * self.budget), np.maximum(2, n_words - 1 - 3 * self.budget))
        item = np.repeat(np.arange(len(self.ids)), n_words)
        place = np.arange(len(starts)) - first[item]
        one, two = seeds(raw, starts, ends)
        both = item[1:] == item[:-1]
        # items that word pairs may lose, and their pieces: one is whole within the budget
        weak = by_word | (n_words - 1 - 3 * self.budget < 2)
        cut = {i: self.pieces_of(i) for i in np.flatnonzero(weak).tolist()}
        by_piece = np.zeros(len(self.ids), bool)
        by_piece[[i for i, found in cut.items() if min(len(x) for _, _, x in found) >= GRAM]] = True
        self.pieces = sorted((x for i, found in cut.items() if by_piece[i] for x in found),
                             key=lambda x: int.from_bytes(x[2][:GRAM], "little"))
        self.gram = np.array([int.from_bytes(x[:GRAM], "little") for _, _, x in self.pieces], np.uint64)
        self.gram_sieve = np.zeros(1 << 20, bool)
        self.gram_sieve[(self.gram * _SPREAD >> X.U64(44)).astype(np.int64)] = True
        use2, use1 = both & ~(by_word | by_piece)[item[:-1]], (by_word & ~by_piece)[item]
        seed = np.concatenate((two[use2], one[use1]))
        order = np.argsort(seed, kind="stable")
        self.seed = seed[order]
        self.seed_item = np.concatenate((item[:-1][use2], item[use1]))[order]
        self.seed_place = np.concatenate((place[:-1][use2], place[use1]))[order]
        self.any_word = bool((by_word & ~by_piece).any())
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.seed >> X.U64(44)).astype(np.int64)] = True
        # sampled steps per band of the CGK walks, as shares of the walk
        self.share = np.random.default_rng(SEED).random((WALKS, BANDS * SAMPLES))
        every = np.arange(len(self.ids))
        own = self.embed([np.frombuffer(b, np.uint8) for b in self.text], every)
        bucket = self.band_keys(own, every).reshape(len(self.ids), WALKS * BANDS)
        order = np.argsort(bucket.ravel(), kind="stable")
        self.bucket, self.bucket_item = bucket.ravel()[order], np.repeat(every, bucket.shape[1])[order]

    def pieces_of(self, i: int) -> list[tuple[int, int, bytes]]:
        """(item, byte offset, piece): the item in budget + 1 pieces of whole code points."""
        s, n = self.string[i], int(self.budget[i]) + 1
        cuts = [len(s) * k // n for k in range(n + 1)]
        return [(i, len(s[:a].encode()), s[a:b].encode()) for a, b in zip(cuts, cuts[1:])]

    def embed(self, strings: list[np.ndarray], item: np.ndarray) -> np.ndarray:
        """Sampled letters of each string's walks (string x walk x sample); the
        samples lie within twice the item's size. 0 stands behind the end."""
        n, size = len(strings), self.size[item]
        width = int(size.max(initial=0)) + 1
        table = np.zeros((n, width), np.uint8)
        for k, s in enumerate(strings):
            table[k, :min(len(s), size[k])] = s[:size[k]]
        out = np.zeros((n, WALKS, BANDS * SAMPLES), np.uint8)
        rows, flat = np.arange(n) * width, table.ravel()
        walked = np.zeros((2 * width, n), np.uint8)
        for w in range(WALKS):
            place = np.zeros(n, np.int64)
            for step in range(2 * (width - 1)):
                letter = walked[step] = flat[rows + place]
                place = np.minimum(place + moves(w, step, letter), width - 1)
            sampled = (self.share[w][None, :] * (2 * size[:, None])).astype(np.int64)
            out[:, w] = walked[sampled, np.arange(n)[:, None]]
        return out

    def band_keys(self, samples: np.ndarray, item: np.ndarray) -> np.ndarray:
        """(string x walk x band) bucket keys of sampled letters, by item size."""
        parts = samples.reshape(len(samples), WALKS, BANDS, SAMPLES).astype(np.uint64)
        key = np.zeros(parts.shape[:3], np.uint64) + self.size[item].astype(np.uint64)[:, None, None]
        for k in range(SAMPLES):
            key = key * X.U64(257) + parts[..., k]
        walk, band = np.arange(WALKS, dtype=np.uint64)[None, :, None], np.arange(BANDS, dtype=np.uint64)[None, None, :]
        return X.finish((key * X.U64(WALKS) + walk) * X.U64(BANDS) + band)

    def candidates(self, windows: list[np.ndarray], item: np.ndarray) -> list[tuple[int, int]]:
        """(window, item) of all items that share a bucket with a window of their size."""
        keys = self.band_keys(self.embed(windows, item), item).reshape(len(windows), WALKS * BANDS)
        lo, hi = np.searchsorted(self.bucket, keys, "left"), np.searchsorted(self.bucket, keys, "right")
        window, _ = np.nonzero(hi > lo)
        lo, n = lo[hi > lo], (hi - lo)[hi > lo]
        entry = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        found = np.unique(np.stack([np.repeat(window, n), self.bucket_item[entry]], axis=1), axis=0)
        return [(int(w), int(i)) for w, i in found if self.size[i] == self.size[item[w]]]

    def windows(self, raw: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, bytes, bytes]]:
        """(document, item, word number, item-sized window, text around it) of
        all windows of a slice of documents that may be within an item's budget."""
        raw = _LOWER[raw]
        starts, ends, first = X.words(raw, at)
        if not len(starts) or not self.ids:
            return []
        doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
        one, two = seeds(raw, starts, ends)
        hit_at, hit_seed = self.lookup(two, doc[1:] == doc[:-1])
        if self.any_word:
            more_at, more_seed = self.lookup(one, np.ones(len(one), bool))
            hit_at, hit_seed = np.concatenate((hit_at, more_at)), np.concatenate((hit_seed, more_seed))
        if not len(hit_at):
            return []
        # hits in order of (document, item, diagonal)
        item, diagonal = self.seed_item[hit_seed], hit_at - self.seed_place[hit_seed]
        pair = doc[hit_at] * len(self.ids) + item
        order = np.lexsort((diagonal, pair))
        pair, diagonal, hit_at, place = pair[order], diagonal[order], hit_at[order], self.seed_place[hit_seed][order]
        key = pair * (1 << 32) + (diagonal + (1 << 30))
        item = pair % len(self.ids)
        hi = np.searchsorted(key, np.minimum(key + self.shift[item] + 1, (pair + 1) << 32))
        enough = np.flatnonzero(hi - np.arange(len(key)) >= self.need[item])
        # of these runs, those with enough different places on both sides; a window per diagonal
        chosen = set()
        for k in enough.tolist():
            e, i = int(hi[k]), int(item[k])
            if min(len(set(place[k:e].tolist())), len(set(hit_at[k:e].tolist()))) >= self.need[i]:
                chosen.update((int(pair[k]) // len(self.ids), i, x) for x in set(diagonal[k:e].tolist()))
        out = []
        for d, i, x in sorted(chosen):
            begin = min(max(x, int(first[d])), int(first[d + 1]) - 1)
            out.append((d, i, begin - int(first[d]), *self.cut(raw, starts, ends, first, d, begin, int(self.size[i]))))
        return out

    def piece_windows(self, raw: np.ndarray, at: np.ndarray):
        """(document, item, word number, text around it) of all places of a slice
        of documents that hold a whole piece of an item."""
        if not len(self.gram) or len(raw) < GRAM:
            return
        space = X.IS_SPACE[raw]
        kept = np.ones(len(raw), bool)
        kept[1:] = ~(space[1:] & space[:-1])
        text = np.where(space, 32, _LOWER[raw]).astype(np.uint8)[kept]
        first = np.r_[0, np.cumsum(kept)][at]
        if len(text) < GRAM:
            return
        grams = np.array(np.ndarray((len(text) - GRAM + 1,), "<u8", text, 0, (1,)))
        place = np.flatnonzero(self.gram_sieve[(grams * _SPREAD >> X.U64(44)).astype(np.int64)])
        lo, hi = np.searchsorted(self.gram, grams[place], "left"), np.searchsorted(self.gram, grams[place], "right")
        doc = np.searchsorted(first, place, "right") - 1
        whole, seen = text.tobytes(), set()
        for k in np.flatnonzero(hi > lo).tolist():
            p, d = int(place[k]), int(doc[k])
            begin, end = int(first[d]), int(first[d + 1])
            for i, offset, piece in self.pieces[lo[k]:hi[k]]:
                start = p - offset
                if (d, i, start) in seen or p + len(piece) > end or not whole.startswith(piece, p):
                    continue
                seen.add((d, i, start))
                slack = 4 * int(self.budget[i]) + 4   # a code point has up to four bytes
                at_word = max(start, begin)
                inside = begin < at_word and whole[at_word - 1] != 32
                word = len(whole[begin:at_word].split()) - int(inside)
                yield d, i, word, whole[max(begin, start - slack):min(end, start + int(self.size[i]) + slack)]

    def search(self, raw: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, item, edits, word number of the window): the best match of
        every matching document and item."""
        found = [(lo + d, *rest) for lo, _, r, a in X.slices(raw, at) for d, *rest in self.windows(r, a)]
        best: dict[tuple[int, int], tuple[int, int]] = {}

        def verify(d: int, i: int, word: int, around: bytes) -> None:
            known = best.get((d, i))
            if known and known[0] == 0:
                return
            edits = 0 if self.text[i] in around else edit_distance_within(self.string[i], around.decode(errors="replace"))
            if edits <= self.budget[i] and (known is None or edits < known[0]):
                best[d, i] = (edits, word)

        for lo, _, r, a in X.slices(raw, at):
            for d, i, word, around in self.piece_windows(r, a):
                verify(lo + d, i, word, around)
        for lo in range(0, len(found), 4096):
            part = found[lo:lo + 4096]
            for k, i in self.candidates([np.frombuffer(w[3], np.uint8) for w in part], np.array([w[1] for w in part])):
                d, _, word, _, around = part[k]
                verify(d, i, word, around)
        return [(d, i, e, w) for (d, i), (e, w) in sorted(best.items())]

    def lookup(self, seed: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, entry of the seed table) of all equal seeds."""
        place = np.flatnonzero(usable & self.sieve[(seed >> X.U64(44)).astype(np.int64)])
        lo, hi = np.searchsorted(self.seed, seed[place], "left"), np.searchsorted(self.seed, seed[place], "right")
        n = hi - lo
        entry = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return np.repeat(place, n), entry

    def cut(self, raw, starts, ends, first, d: int, begin: int, size: int) -> tuple[bytes, bytes]:
        """The item-sized window at a word of document ``d``, and the text with
        the budget's slack on both sides of it."""
        def joined(b: int, want: int, stop: int, step: int) -> tuple[int, list[bytes]]:
            out, got = [], 0
            while b != stop and got < want:
                out.append(raw[starts[b]:ends[b]].tobytes())
                got += len(out[-1]) + 1
                b += step
            return b, out

        slack = int(self.slack * size) + 2
        end, words = joined(begin, size + 1, int(first[d + 1]), 1)
        _, behind = joined(end, slack, int(first[d + 1]), 1)
        _, before = joined(begin - 1, slack, int(first[d]) - 1, -1)
        return b" ".join(words)[:size], b" ".join([*before[::-1], *words, *behind])


def seeds(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of neighbouring word pairs (those across groups are the caller's to drop)."""
    one = X.PrefixHash(raw).of(starts, ends)
    two = X.finish(one[:-1] * X.U64(0xA24BAED4963EE407) + one[1:])
    return one, two


def blocks(benchmark: DataFrame, max_edit: float = MAX_EDIT, block: int = BLOCK):
    """The query set as ``Items`` of about ``block`` items each."""
    n = benchmark.count()
    parts = -(-n // block)
    for k in range(parts):
        rows = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), parts) == k).select("item_id", "text").collect()
        yield Items(sorted((r["item_id"], r["text"] or "") for r in rows), max_edit)


def matches(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, block: int = BLOCK,
            id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, item_id, edits, word_no): the best window of every matching (row, item)."""
    schema = f"{id_col} long, item_id long, edits long, word_no long"
    out = None
    for items in blocks(benchmark, max_edit, block):
        def run(batches, items=items):
            for b in batches:
                raw, at = X.text_bytes(b["t"])
                found = items.search(raw, at)
                row = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b["id"].take(row), pa.array([items.ids[f[1]] for f in found], pa.int64()),
                     pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64())],
                    names=[id_col, "item_id", "edits", "word_no"])

        part = map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")), run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, block: int = BLOCK,
          text: str = "text") -> DataFrame:
    """The rows of ``docs`` that match no item, all columns; rows are dropped
    where they are read, so no text is shuffled."""
    out = docs
    for items in blocks(benchmark, max_edit, block):
        def run(batches, items=items):
            for b in batches:
                raw, at = X.text_bytes(b[text])
                dirty = np.zeros(b.num_rows, bool)
                dirty[[f[0] for f in items.search(raw, at)]] = True
                yield b.filter(pa.array(~dirty))

        out = map_arrow(out, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
    return out
