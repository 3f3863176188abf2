"""Toxicity categories by a classifier chain of linear models.

Categories are predicted one after the other; each model sees the text's
features and the probabilities of the categories before it. For training, the
earlier probabilities are out-of-fold predictions, so a later model learns
from what the earlier ones say about texts they have not seen.

Features: presence of a word and of its first 4, 5 and 6 letters (lower case),
hashed to ``BUCKETS``; a category's models use at most ``FEATURES`` of them,
those whose document counts differ most between the classes (|z| >= ``MIN_Z``).
Models are L2 logistic regressions.

Fitting takes at most ``MAX_TOXIC + MAX_CLEAN`` labelled documents (smallest
hashes of the id), so what reaches the driver is bounded by these parameters;
scoring covers every document and whole texts and needs no shuffle.

Categories of the registered query: the labels name only ``toxic``, so two
narrower ones are read off labelled toxic texts by seed words (insulting
nouns, contemptuous adjectives) and stand before it in the chain.

Defined cases: null and word-less texts have no features (the intercepts
decide); null ids are never labelled but scored; repeated rows score alike, and
of the texts of a repeated id the one with the smallest hash is learned from; a
category with only one class in the sample gets that class's smoothed rate, and
without any labels all probabilities are 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.llm import textnum as X
from lakegov.llm.staging import map_arrow, staged

BUCKETS = 1 << 18
FEATURES = 1024
MIN_Z = 4.0
MAX_TOXIC, MAX_CLEAN = 1500, 2500
FOLDS = 3
THRESHOLD = 0.5
PREFIXES = (4, 5, 6)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Seed words of the registered query's narrower categories, in chain order.
SEED_WORDS = {"insult": "idiot|moron|clown|scum|trash|loser", "contempt": "stupid|pathetic|worthless|disgusting"}


def category_labels(seed_words: dict[str, str] | None = None) -> dict[str, Column]:
    """Chain order; columns over ``toxic`` and ``text``. ``seed_words`` (name ->
    words) makes the narrower categories out of the one label; with {} the chain
    is that label alone. Callers with labels of their own pass their own columns to ``fit``."""
    toxic = F.col("toxic") == 1
    has = lambda words: F.lower("text").rlike(rf"\b({words})\b")
    words = SEED_WORDS if seed_words is None else seed_words
    return {name: toxic & has(w) for name, w in words.items()} | {"toxic": toxic}


def document_features(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every feature, with repeats. Letters outside ASCII
    count by their bytes in the prefixes, alike in fitting and scoring."""
    raw = _LOWER[raw]
    starts, ends, first = X.words(raw, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    # punctuation at the end is no part of the word
    mark = np.isin(raw, np.frombuffer(b".,;:!?", np.uint8))
    for _ in range(2):
        trim = (ends - starts > 1) & mark[ends - 1] if len(ends) else np.zeros(0, bool)
        ends = ends - trim
    hashes = X.PrefixHash(raw)
    docs, buckets = [doc], [hashes.of(starts, ends)]
    for n in PREFIXES:
        long = ends - starts > n
        docs.append(doc[long])
        buckets.append(hashes.of(starts[long], starts[long] + n) * X.U64(2 * n + 1))
    return np.concatenate(docs), (np.concatenate(buckets) >> X.U64(46)).astype(np.int64)


@dataclass
class Chain:
    """Per category: weights by bucket slot, weights of the earlier probabilities, intercept."""

    names: list[str]
    slot: np.ndarray          # bucket -> column of ``weights`` or -1
    weights: np.ndarray       # category x slot
    earlier: np.ndarray       # category x category, strictly lower triangular
    intercept: np.ndarray

    def probabilities(self, column: pa.Array) -> np.ndarray:
        raw, at = X.text_bytes(column)
        out = np.zeros((len(at) - 1, len(self.names)))
        for lo, hi, r, a in X.slices(raw, at):
            doc, bucket = document_features(r, a)
            slot = self.slot[bucket]
            pair = np.unique(doc[slot >= 0] * self.weights.shape[1] + slot[slot >= 0])
            doc, slot = pair // self.weights.shape[1], pair % self.weights.shape[1]
            for c in range(len(self.names)):
                z = np.bincount(doc, self.weights[c, slot], minlength=hi - lo) + self.intercept[c]
                z += out[lo:hi, :c] @ self.earlier[c, :c]
                out[lo:hi, c] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """L2 logistic regression by Newton steps with a backtracking line search;
    the intercept is free."""
    n, m = x.shape
    if y.min() == y.max():
        rate = (y.sum() + 0.5) / (n + 1)
        return np.zeros(m), float(np.log(rate / (1 - rate)))
    full = np.hstack([x, np.ones((n, 1))])
    penalty = np.r_[np.full(m, l2), 1e-6]
    w = np.zeros(m + 1)
    loss = lambda u: np.logaddexp(0, full @ u).sum() - y @ (full @ u) + 0.5 * penalty @ (u * u)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        grad = full.T @ (p - y) + penalty * w
        hess = (full.T * np.maximum(p * (1 - p), 1e-6)) @ full + np.diag(penalty)
        step, size, now = np.linalg.solve(hess, grad), 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str, text: str) -> DataFrame:
    """(fold, category columns, buckets) of the bounded labelled sample."""
    one = labels.groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("toxic")).filter("_id IS NOT NULL")
    order = (F.xxhash64("_id"), F.col("_id"))
    ids = (one.filter("toxic = 1").orderBy(*order).limit(MAX_TOXIC)
           .unionByName(one.filter("toxic = 0").orderBy(*order).limit(MAX_CLEAN)))
    ids = staged(ids, "toxicity-sample")   # at most MAX_TOXIC + MAX_CLEAN ids
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text")).join(F.broadcast(ids), "_id")
    # one text per id, whatever the partitioning: the one with the smallest hash
    one_text = F.min(F.struct(F.xxhash64(F.coalesce("text", F.lit(""))), "text"))
    rows = rows.groupBy("_id", "toxic").agg(one_text.alias("t")).select("_id", "toxic", "t.text")
    names = list(categories)
    rows = rows.select("_id", "text", *(c.cast("int").alias(k) for k, c in categories.items()))

    def run(batches):
        for b in batches:
            raw, at = X.text_bytes(b["text"])
            found = []
            for lo, hi, r, a in X.slices(raw, at):
                doc, bucket = document_features(r, a)
                pair = np.unique(doc * BUCKETS + bucket)
                cuts = np.searchsorted(pair // BUCKETS, np.arange(1, hi - lo))
                found += [x.astype(np.int32) for x in np.split(pair % BUCKETS, cuts)]
            yield pa.RecordBatch.from_arrays([b["_id"], *(b[k] for k in names), pa.array(found, pa.list_(pa.int32()))],
                                             names=["_id", *names, "buckets"])

    schema = ", ".join(["_id long", *(f"`{k}` int" for k in names), "buckets array<int>"])
    return staged(map_arrow(rows, run, schema), "toxicity-features")


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column] | None = None, id_col: str = "doc_id",
        text: str = "text") -> Chain:
    categories = category_labels() if categories is None else categories
    names = list(categories)
    rows = sorted(sample(docs, labels, categories, id_col, text).collect(), key=lambda r: r["_id"])
    n = len(rows)
    y = np.array([[r[k] or 0 for k in names] for r in rows], float).reshape(n, len(names))
    doc = np.repeat(np.arange(n), [len(r["buckets"]) for r in rows])
    bucket = np.concatenate([np.array(r["buckets"], np.int64) for r in rows]) if n else np.zeros(0, np.int64)
    # features: document counts that differ most from the category's rate
    count = np.bincount(bucket, minlength=BUCKETS).astype(float)
    z = np.zeros(BUCKETS)
    for c in range(len(names)):
        rate = y[:, c].mean() if n else 0.0
        if 0 < rate < 1:
            own = np.bincount(bucket, y[doc, c], minlength=BUCKETS)
            z = np.maximum(z, np.abs(own - count * rate) / np.sqrt(np.maximum(count, 1) * rate * (1 - rate)))
    chosen = np.argsort(-z, kind="stable")[:FEATURES]
    chosen = np.sort(chosen[z[chosen] >= MIN_Z])
    slot = np.full(BUCKETS, -1, np.int64)
    slot[chosen] = np.arange(len(chosen))
    x = np.zeros((n, max(1, len(chosen))))
    known = slot[bucket] >= 0
    x[doc[known], slot[bucket[known]]] = 1
    # the chain: every model is fitted on out-of-fold probabilities of those before it
    fold = np.arange(n) % FOLDS
    weights, earlier, intercept = np.zeros((len(names), x.shape[1])), np.zeros((len(names),) * 2), np.full(len(names), -30.0)
    held = np.zeros((n, len(names)))
    for c in range(len(names) if n else 0):
        full = np.hstack([x, held[:, :c]])
        w, intercept[c] = logistic(full, y[:, c])
        weights[c], earlier[c, :c] = w[:x.shape[1]], w[x.shape[1]:]
        for f in range(FOLDS):
            out = fold == f
            w, b = logistic(full[~out], y[~out, c]) if out.any() and (~out).any() else (w, intercept[c])
            held[out, c] = 1 / (1 + np.exp(-np.clip(full[out] @ w + b, -30, 30)))
    return Chain(names, slot, weights, earlier, intercept)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, p_<category> ..., is_<category> ...) per row."""
    names = chain.names

    def run(batches):
        for b in batches:
            p = chain.probabilities(b["t"])
            yield pa.RecordBatch.from_arrays(
                [b["id"], *(pa.array(p[:, c]) for c in range(len(names))),
                 *(pa.array(p[:, c] >= threshold) for c in range(len(names)))],
                names=[id_col, *(f"p_{k}" for k in names), *(f"is_{k}" for k in names)])

    schema = ", ".join([f"{id_col} long", *(f"`p_{k}` double" for k in names), *(f"`is_{k}` boolean" for k in names)])
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")), run, schema)
