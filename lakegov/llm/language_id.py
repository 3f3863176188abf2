r"""Language identification by error-correcting output codes.

Every learned language gets a codeword of bits: the exhaustive code up to
``EXHAUSTIVE`` languages (2^(L-1) - 1 bits, every pair of words 2^(L-2) bits
apart), beyond that the best of ``DRAWS`` seeded random codes. Each bit has a
binary linear classifier over hashed byte n-grams (1 to 4 bytes of the
lower-cased text, ASCII marks, digits and white space as one blank): the log
ratio of the n-gram frequencies of the languages with the bit and those
without it, each language counting alike. The sum over a text is divided by
the root of its n-grams and calibrated per bit by a logistic fit on labelled
texts that the frequencies have not seen.

Decoding is loss-weighted: a language's loss is the logistic loss of each
margin against its bit, weighted by how often that bit's classifier is right
on that language's calibration texts (weights sum to 1 per language). The
nearest codeword wins; equal losses go to the smaller name. ``score`` is the
winner's share of exp(-loss * bits), in 0 to 1; ``ambiguous`` marks texts whose
runner-up comes within ``MARGIN`` of the winner's share, so that no codeword
is clearly the nearest.

Learning reads only ``text`` and non-null ``lang`` of rows outside the held-out
fifth (crc32 of the decimal id, mod 5, is 0), from a sample of about
``PER_LANGUAGE`` texts per language (a fixed hash share; all texts where there
are fewer): what reaches the driver is bounded by it, by the number of
languages and by ``BUCKETS``. Prediction reads the text alone, whole, in one
pass without a shuffle.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
so are all texts if nothing can be learned; with one learned language every
text with a letter has it; a null id counts as empty decimal text, so it is
held out; repeated rows are predicted alike; a language is learned if it has a
text with a letter; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.llm import textnum as X
from lakegov.llm.staging import map_arrow, staged, unit_hash

BUCKETS = 1 << 15
LENGTHS = (1, 2, 3, 4)
PER_LANGUAGE = 2_000
EXHAUSTIVE = 5
RANDOM_BITS = 40
DRAWS = 50
PRIOR = 0.5
MARGIN = 0.2
UNKNOWN = "und"
SEED = "language-1"

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def held_out(id_col: str = "doc_id") -> Column:
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(5)) == 0


def code(n: int) -> np.ndarray:
    """Codewords (language x bit) of -1 and 1; no bit is constant and no bit is
    another's complement or copy in the exhaustive code."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= EXHAUSTIVE:
        number = np.arange(1, 1 << (n - 1))
        rows = [np.ones(len(number))] + [np.where(number >> i & 1, -1.0, 1.0) for i in range(n - 1)]
        return np.stack(rows)
    best, far = None, -1
    for seed in range(DRAWS):
        words = np.where(np.random.default_rng(seed).random((n, RANDOM_BITS)) < 0.5, -1.0, 1.0)
        split = np.abs(words.sum(0)) < n
        apart = min(int((words[i] != words[j]).sum()) for i in range(n) for j in range(i))
        if split.all() and apart > far:
            best, far = words, apart
    if best is None:
        raise ValueError(f"no code for {n} languages")
    return best


def grams(column: pa.Array):
    """Slices (first row, end row, n-grams per row, [(bucket of the n-gram that
    starts at each byte or BUCKETS, starts of the rows)]) of whole lower-cased texts."""
    raw, at = X.text_bytes(pc.utf8_lower(column))
    for lo, hi, r, a in X.slices(raw, at):
        n = len(r)
        size = np.diff(a)
        left = np.repeat(a[1:], size) - np.arange(n)     # bytes up to the end of the own text
        letter = _PLAIN[r].astype(np.uint32)
        parts, total = [], np.zeros(hi - lo, np.int64)
        number = np.zeros(n, np.uint32)
        for k in range(max(LENGTHS)):
            number = number << np.uint32(8)
            number[:n - k] |= letter[k:]
            if k + 1 in LENGTHS:
                h = (number * np.uint32(0x9E3779B1) + np.uint32((k + 1) * 0x85EBCA6B & 0xFFFFFFFF))
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                bucket = (h >> np.uint32(32 - 15)).astype(np.int64)
                bucket[left <= k] = BUCKETS
                total += np.maximum(size - k, 0)
                parts.append(bucket)
        yield lo, hi, total, parts, a


def row_sums(parts: list[np.ndarray], at: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of ``table`` rows (one more than ``BUCKETS``, the last zero) over each text's n-grams."""
    out = np.zeros((len(at) - 1, table.shape[1]))
    some = np.flatnonzero(np.diff(at))
    if len(some):
        for bucket in parts:
            out[some] += np.add.reduceat(table[bucket], at[:-1][some], axis=0)
    return out


@dataclass
class Languages:
    names: list[str]
    words: np.ndarray       # language x bit, -1 or 1
    table: np.ndarray       # bucket x bit, float32, with a zero row at the end
    slope: np.ndarray
    offset: np.ndarray
    trust: np.ndarray       # language x bit, rows sum to 1

    def margins(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), self.words.shape[1]))
        for lo, hi, total, parts, at in grams(column):
            out[lo:hi] = row_sums(parts, at, self.table) / np.sqrt(total + 1.0)[:, None]
        return out * self.slope + self.offset

    def losses(self, margins: np.ndarray) -> np.ndarray:
        wrong = np.logaddexp(0, -np.clip(margins, -30, 30)[:, None, :] * self.words[None])
        return (wrong * self.trust[None]).sum(2)


def sample(docs: DataFrame, id_col: str, text: str, lang: str, per_language: int) -> DataFrame:
    """(lang, t, fit): the labelled texts with a letter that are learned from."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(id_col))
    counts = rows.groupBy(lang).count().collect()         # one row per language
    if not counts:
        share: Column = F.lit(0.0)
    else:
        known = F.create_map(*(F.lit(x) for r in counts for x in (r[lang], min(1.0, per_language / r["count"]))))
        share = F.element_at(known, F.col(lang))
    u = unit_hash(SEED, F.col(id_col))
    rows = rows.filter(u < share).filter(F.col(text).rlike(r"\p{L}"))
    half = F.pmod(F.xxhash64(F.lit(11), F.col(id_col)), F.lit(2)) == 0
    return staged(rows.select(F.col(lang).alias("lang"), F.col(text).alias("t"), half.alias("fit")), "language-sample")


def bucket_counts(rows: DataFrame, names: list[str]) -> np.ndarray:
    """language x BUCKETS counts of the sample's fitting half."""
    index = {n: i for i, n in enumerate(names)}

    def run(batches):
        found = np.zeros((len(names), BUCKETS + 1), np.int64)
        for b in batches:
            own = np.array([index[x] for x in b["lang"].to_pylist()], np.int64)
            for lo, hi, _, parts, at in grams(b["t"]):
                row = np.repeat(own[lo:hi], np.diff(at))
                for bucket in parts:
                    found += np.bincount(row * (BUCKETS + 1) + bucket, minlength=found.size).reshape(found.shape)
        which, bucket = np.nonzero(found[:, :BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(bucket), pa.array(found[which, bucket])], names=["l", "b", "n"])

    sums = staged(map_arrow(rows.filter("fit").select("lang", "t"), run, "l long, b long, n long")
                  .groupBy("l", "b").agg(F.sum("n").alias("n")), "language-counts").toArrow()
    out = np.zeros((len(names), BUCKETS))
    out[sums["l"].to_numpy(), sums["b"].to_numpy()] = sums["n"].to_numpy()
    return out


def calibration(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of y (-1, 1) on z, kept off infinity by a small ridge."""
    w = np.array([1.0, 0.0])
    x = np.stack([z, np.ones(len(z))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - (y > 0)) + 1e-2 * (w - [1.0, 0.0])
        hess = (x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return (float(max(w[0], 1e-3)), float(w[1]))


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE) -> Languages:
    rows = sample(docs, id_col, text, lang, per_language)
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    words = code(len(names))
    bits = words.shape[1]
    if not bits:
        return Languages(names, words, np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0), np.zeros(0), np.zeros((len(names), 0)))
    n = bucket_counts(rows, names) + PRIOR
    share = n / n.sum(1, keepdims=True)
    table = np.zeros((BUCKETS + 1, bits), np.float32)
    for j in range(bits):
        table[:-1, j] = np.log(share[words[:, j] > 0].mean(0)) - np.log(share[words[:, j] < 0].mean(0))
    model = Languages(names, words, table, np.ones(bits), np.zeros(bits), np.full(words.shape, 1.0 / bits))

    def run(batches):
        for b in batches:
            m = model.margins(b["t"])
            yield pa.RecordBatch.from_arrays([b["lang"], pa.array(list(m), pa.list_(pa.float64()))], names=["lang", "m"])

    # about per_language / 2 margins per language
    seen = staged(map_arrow(rows.filter("NOT fit").select("lang", "t"), run, "lang string, m array<double>"), "language-margins")
    seen = seen.orderBy("lang", "m").collect()
    own = np.array([names.index(r["lang"]) for r in seen], np.int64)
    margin = np.array([r["m"] for r in seen]).reshape(len(seen), bits)
    for j in range(bits):
        y = words[own, j]
        if len(set(y)) == 2:
            model.slope[j], model.offset[j] = calibration(margin[:, j], y)
    right = (margin * model.slope + model.offset) * words[own] > 0
    for i in range(len(names)):
        k, m = right[own == i].sum(0), (own == i).sum()
        model.trust[i] = (k + 1.0) / (m + 2.0)
    model.trust /= model.trust.sum(1, keepdims=True)
    return model


def identify(docs: DataFrame, model: Languages, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score, runner_up, ambiguous) per row of ``docs``."""
    names = np.array([*model.names, UNKNOWN], object)

    def run(batches):
        for b in batches:
            t = b["t"].fill_null("")
            letter = pc.match_substring_regex(t, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
            n, known = len(t), len(model.names)
            first, second = np.full(n, known), np.full(n, known)
            score, unsure = np.zeros(n), np.zeros(n, bool)
            if known == 1:
                first, score = np.where(letter, 0, known), letter.astype(float)
            elif known:
                loss = model.losses(model.margins(t)) * model.words.shape[1]
                share = np.exp(loss.min(1, keepdims=True) - loss)
                share /= share.sum(1, keepdims=True)
                order = np.argsort(loss, axis=1, kind="stable")
                rows = np.arange(n)
                first, second = np.where(letter, order[:, 0], known), np.where(letter, order[:, 1], known)
                score = np.where(letter, share[rows, order[:, 0]], 0.0)
                unsure = letter & (score - share[rows, order[:, 1]] < MARGIN)
            yield pa.RecordBatch.from_arrays(
                [b["id"], b["h"], pa.array(names[first], pa.string()), pa.array(score),
                 pa.array(np.where(second == known, None, names[second]), pa.string()), pa.array(unsure)],
                names=[id_col, "held_out", "lang_pred", "score", "runner_up", "ambiguous"])

    schema = f"`{id_col}` long, held_out boolean, lang_pred string, score double, runner_up string, ambiguous boolean"
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("h"), F.col(text).alias("t")), run, schema)
