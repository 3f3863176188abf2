"""corpus_pipeline.run() and the resampling query on a small fixture, against plain-Python forms of every stage."""

import hashlib
import math
import random
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from test_corpus_operators import edit_by_hand, fingerprint_by_hand, least_reachable

import corpus_pipeline
from lakegov.llm import catalog, importance

ODD, BASE, FULL = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """(folder, documents, good ids, items): good and bad words, copies, a long repeated passage, leaks, a row without source."""
    r = random.Random(11)
    good, bad = [["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 8))) for _ in range(150)] for _ in range(2)]
    text = lambda words, n: " ".join(r.choice(words) for _ in range(n))
    items = [(0, text(good, 24)), (1, text(good, 5))]
    texts = [text(good, r.randint(40, 90)) for _ in range(40)] + [text(bad, r.randint(40, 90)) for _ in range(12)]
    passage = text(good, 45)
    for i in (3, 9, 14):
        texts[i] += f" é {passage} {i}"
    texts[5] += " " + items[0][1].upper() + " behind"
    edited = items[1][1][:9] + "#" + items[1][1][10:]   # one letter, and one pair of words is left whole or two
    texts[7] = "before " + edited.replace(" ", "\n") + " " + texts[7]
    texts += [texts[0], texts[1].upper(), "abc"]
    docs = [(i, t, "en", None if t == "abc" else f"src{i % 4}", len(t)) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("small"))
    labels = [(i, int(i < 40), 0) for i in range(52)]
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
                               ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return folder, {d[0]: d for d in docs}, set(range(40)), items


def unit(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


# -- importance resampling ------------------------------------------------------------
def finish(h):
    h ^= h >> 32
    h = h * BASE & FULL
    h ^= h >> 29
    h = h * ODD & FULL
    return h ^ h >> 32


def buckets(text):
    def word(b):
        mixed = [((c + 1) * ODD & FULL ^ ((c + 1) * BASE & FULL) >> 17) | 1 for c in b]
        return finish((sum(m * pow(BASE, j, 1 << 64) for j, m in enumerate(mixed)) + len(b) * ODD) & FULL)

    h = [word(w) for w in text.encode().split()]
    return [x % 10_000 for x in h] + [finish((x * 0xA24BAED4963EE407 + y) & FULL) % 10_000 for x, y in zip(h, h[1:])]


def scores_by_hand(docs, good):
    """Per document (log weight, noisy score, kept)."""
    seed = xxhash.xxh64_intdigest(struct.pack("<i", 7), 42)
    fit = {i for i in good if xxhash.xxh64_intdigest(struct.pack("<q", i), seed) % 2 == 0}
    grams = {i: buckets(d[1]) for i, d in docs.items()}
    raw = Counter(b for g in grams.values() for b in g)
    target = Counter(b for i in fit for b in grams[i])
    n_raw, n_target = sum(raw.values()) + 10_000, sum(target.values()) + 10_000
    ratio = lambda b: math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw)
    weight = {i: 1000 * sum(map(ratio, g)) / (len(g) + 100) for i, g in grams.items()}
    score = {i: w / 10 - math.log(-math.log(unit("importance-1", i) + 2**-54)) for i, w in weight.items()}
    reach = np.quantile([score[i] for i in good - fit], 0.002)
    k = sum(x >= reach for x in score.values())
    drawn = sorted(score, key=lambda i: -score[i])[:k]
    return {i: (weight[i], score[i], i in drawn) for i in docs}


def test_resampling_query(spark, small):
    folder, docs, good, _ = small
    want = scores_by_hand(docs, good)
    got = {r.doc_id: r for r in catalog.op1_importance_resampling(spark, folder).collect()}
    assert got.keys() == want.keys() and 0 < sum(not w[2] for w in want.values()) < len(docs)
    for i, (weight, score, kept) in want.items():
        assert (got[i].log_weight, got[i].score) == pytest.approx((weight, score)) and got[i].kept == kept


def test_top_k_draws_in_proportion_to_weights(spark):
    """Over seeds, the first of three documents drawn follows weight^(1 / temperature): 1 : 2 : 4."""
    weights = [(i, importance.TEMPERATURE * math.log(w)) for i, w in enumerate((1, 2, 4))]
    df = spark.createDataFrame(weights, "doc_id long, log_weight double")
    rows = df.select(*(importance.noisy(seed=f"seed {s}").alias(f"s{s}") for s in range(700))).collect()
    first = Counter(max(range(3), key=lambda i: rows[i][s]) for s in range(700))
    for i, share in enumerate((1 / 7, 2 / 7, 4 / 7)):
        assert abs(first[i] - 700 * share) < 4.5 * math.sqrt(700 * share * (1 - share))


def test_cut_of_top_k_is_the_kth_score(spark):
    scores = [random.Random(5).gauss(0, 5) for _ in range(500)] + [1.5] * 20
    df = spark.createDataFrame([(x,) for x in scores], "score double")
    for k in (1, 77, 300, 519):
        assert importance.cut_of_top_k(df, k) == sorted(scores, reverse=True)[k - 1]
    assert importance.cut_of_top_k(df, 520) == float("-inf") and importance.cut_of_top_k(df, 0) == float("inf")


# -- the whole pipeline -----------------------------------------------------------------
def cut_by_hand(texts, span=200):
    seen = Counter(b[i:i + span] for b in (t.encode() for t in texts.values()) for i in range(len(b) - span + 1))
    out = {}
    for k, t in texts.items():
        b = t.encode()
        gone = {j for i in range(len(b) - span + 1) if seen[b[i:i + span]] > 1 for j in range(i, i + span)}
        out[k] = bytes(c for j, c in enumerate(b) if j not in gone).decode(errors="ignore")
    return out


def copies_by_hand(texts, docs, named):
    """Registered weights: 4 for src0, 0.8 for every other stratum."""
    stratum = {i: docs[i][3] if docs[i][3] in named else "*" for i in texts}
    mass = Counter()
    for i, t in texts.items():
        mass[stratum[i]] += len(t)
    weight = {s: 4.0 if s == "src0" else 0.8 for s, m in mass.items() if m}
    out = {}
    for i in texts:
        rate = weight[stratum[i]] / sum(weight.values()) * sum(mass.values()) / mass[stratum[i]]
        parts = max(1, math.ceil(rate / 700))
        own = f"{i}/{hashlib.md5(texts[i].encode()).hexdigest()}/"
        us = [unit("mix-17", own)] if parts == 1 else [unit("mix-17-part", own, j) for j in range(parts)]
        mean, out[i] = rate / parts, 0
        for u in us:
            k, term, total = 0, math.exp(-mean), 0.0
            while (total := total + term) <= u:
                k += 1
                term *= mean / k
            out[i] += k
    return out


def test_run(spark, small):
    folder, docs, good, items = small
    texts = {i: docs[i][1] for i, w in scores_by_hand(docs, good).items() if w[2]}
    sizes = [len(docs), len(texts)]
    fps = {i: fingerprint_by_hand(t) for i, t in texts.items()}
    distinct = sorted(set(fps.values()))
    group = dict(zip(distinct, least_reachable(distinct, 3)))
    first = {}
    for i in sorted(texts):
        first.setdefault(group[fps[i]], i)
    texts = {i: texts[i] for i in first.values()}
    sizes.append(len(texts))
    before = sum(map(len, texts.values()))
    texts = cut_by_hand(texts)
    assert sum(map(len, texts.values())) < before
    plain = lambda t: b" ".join(t.encode().lower().split()).decode()
    texts = {i: t for i, t in texts.items()
             if all(edit_by_hand(plain(s), plain(t)) > int(0.05 * len(plain(s))) for _, s in items)}
    sizes.append(len(texts))
    assert all(a > b for a, b in zip(sizes, sizes[1:]))   # every stage has something to do
    n = copies_by_hand(texts, docs, {f"src{i}" for i in range(20)})
    want = Counter((i, docs[i][2], docs[i][3], t, len(t), n[i], c) for i, t in texts.items() for c in range(n[i]))
    out = corpus_pipeline.run(spark, folder)
    assert Counter((r.doc_id, r.lang, r.source, r.text, r.n_chars, r.n_copies, r.copy_no) for r in out.collect()) == want
