"""Corpus-wide operators against brute force; edge rows; the pipeline."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lakegov.llm import decontaminate, simhash_trie, source_mix, suffix_dedup, textnum

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


# -- suffix-array deduplication ----------------------------------------------------
def removed_by_hand(texts, span):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + span] for b in raws for i in range(len(b) - span + 1))
    out = []
    for b in raws:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if seen[b[i:i + span]] > 1:
                gone[i:i + span] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def test_two_stage_order_and_windows():
    r = random.Random(5)
    for _ in range(150):
        span = r.choice([8, 9, 20])
        strings = []
        for _ in range(r.randint(1, 8)):
            strings.append("".join(r.choice("abc") for _ in range(r.randint(span, 60))).encode())
            if r.random() < 0.5:
                strings.append(b"\xff\x00"[: r.randint(0, 2)] + r.choice(strings) + b"q" * r.randint(0, 2))
        seen = Counter(c[i:i + span] for c in strings for i in range(len(c) - span + 1))
        want = [[i for i in range(len(c) - span + 1) if seen[c[i:i + span]] > 1] for c in strings]
        assert [x.tolist() for x in suffix_dedup.repeated_windows(strings, span)] == want
        # the order itself
        end = np.cumsum([len(c) + 1 for c in strings]) - 1
        begin = end - np.array([len(c) for c in strings])
        order = suffix_dedup.two_stage_order(b"\0".join(strings) + b"\0", begin, end, span)
        buf = b"\0".join(strings) + b"\0"
        keys = [buf[i:min(i + span, end[np.searchsorted(end, i)])] for i in order]
        assert keys == sorted(keys)


def planted(n, seed):
    r = random.Random(seed)
    words = ["alpha", "be", "gamma", "é", "dé", "zz", "omega", "x"]
    passages = [" ".join(r.choice(words) for _ in range(12)) for _ in range(6)]
    texts = [None, "", "zz " * 60, "zz " * 60]
    for _ in range(n):
        t = " ".join(r.choice(words) for _ in range(r.randint(0, 30)))
        if r.random() < 0.7:
            t = t[: len(t) // 2] + r.choice(passages) + t[len(t) // 2:]
        texts.append(r.choice(texts) if r.random() < 0.1 else t)
    return texts


@pytest.mark.parametrize("hot", [10**6, 6])
def test_suffix_dedup(spark, hot):
    texts = planted(150, hot)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(df, 25, hot).collect()}
    assert [got[i] for i in range(len(texts))] == removed_by_hand(texts, 25)


def test_suffix_dedup_takes_texts_by_a_join_that_can_be_split(spark, monkeypatch):
    plans, stored = {}, suffix_dedup.staged

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(suffix_dedup, "staged", spy)
    texts = planted(60, 1)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(df, 25).collect()}
    assert [got[i] for i in range(len(texts))] == removed_by_hand(texts, 25)
    assert "Join" in plans["contents"] and "collect_list" not in plans["contents"]


def test_suffix_dedup_query_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(docs).collect()}
    assert [got[r.doc_id] for r in rows] == removed_by_hand([r.text for r in rows], 200)
    edge = spark.createDataFrame([(None, "é" * 300, "x", None, 0), (None, "é" * 300, "x", None, 0), (3, None, None, "s", 1)], DOC)
    cut = suffix_dedup.cut(edge)
    assert cut.columns == edge.columns and sorted(r.n_chars or 0 for r in cut.collect()) == [0, 0, 0]
    assert suffix_dedup.suffix_dedup(edge.limit(0)).count() == 0


# -- SimHash -------------------------------------------------------------------------
def fingerprint_by_hand(t):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def least_reachable(values, bits):
    a = np.array(values, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= bits
    label = np.arange(len(a))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(a))])
        if (new == label).all():
            return label.tolist()
        label = new


@pytest.mark.parametrize("hot", [10**6, 150])
def test_trie_join_loses_no_link(spark, hot):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 120).tolist()
    values = set(base) | {base[0] ^ (i << 3) for i in range(200)}
    for b in base[:40]:
        for _ in range(12):
            x = b
            for _ in range(rng.integers(1, 5)):
                x ^= 1 << int(rng.integers(0, 63))
            values.add(x)
    values = sorted(values)
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash_trie.classes(df, 3, hot).collect()}
    assert [got[v] for v in values] == least_reachable(values, 3)


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, " \n"), (-3, "Two WORDS"), (-3, "Two WORDS"), (None, "two words")], docs.schema)
    both = docs.unionByName(extra)
    rows = both.collect()
    fps = [fingerprint_by_hand(r.text) for r in rows]
    got = Counter(tuple(r) for r in simhash_trie.near_duplicates(both).collect())
    distinct = sorted(set(fps))
    group = dict(zip(distinct, least_reachable(distinct, 3)))
    low = {}
    for r, f in zip(rows, fps):
        if r.doc_id is not None:
            low[group[f]] = min(low.get(group[f], r.doc_id), r.doc_id)
    assert got == Counter((r.doc_id, f"{f:016x}", low.get(group[f])) for r, f in zip(rows, fps))
    kept = simhash_trie.keep_one(both)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(set(low.values()))
    assert simhash_trie.near_duplicates(both.limit(0)).count() == 0


# -- decontamination -------------------------------------------------------------------
def edit_by_hand(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_edit_distance():
    r = random.Random(0)
    for _ in range(200):
        p = "".join(r.choice("abcé") for _ in range(r.randint(1, 12)))
        t = "".join(r.choice("abcé") for _ in range(r.randint(0, 20)))
        assert decontaminate.edit_distance_within(p, t) == edit_by_hand(p, t)


def test_decontamination(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.matches(docs, bench, block=15).collect()}
    items = {r.item_id: decontaminate.normal(r.text).decode() for r in bench.collect()}
    texts = {r.doc_id: decontaminate.normal(r.text).decode() for r in docs.collect()}
    exact = {(d, i) for i, s in items.items() for d, t in texts.items() if f" {s} " in f" {t} "}
    assert exact <= got.keys()
    for (d, i), e in got.items():
        assert e <= int(0.05 * len(items[i])) and edit_by_hand(items[i], texts[d]) <= e
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len({d for d, _ in got})
    odd = spark.createDataFrame([(None, None), (1, ""), (2, items[0].upper()), (2, items[0].upper())], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.matches(odd, bench).collect()] == [(2, 0), (2, 0)]
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0


def test_decontamination_recall_at_full_budget():
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    items = decontaminate.Items(list(zip(t["item_id"], t["text"])))
    r, hit, n = random.Random(5), 0, 200
    for _ in range(n):
        i = r.randrange(len(items.ids))
        s = list(items.string[i])
        for _ in range(int(items.budget[i])):
            q = r.randrange(len(s))
            s[q:q + r.randint(0, 1)] = r.choice(["", "a", "x", " "])
        raw, at = textnum.text_bytes(pa.array(["Some words before that " + "".join(s) + " and some behind it too"]))
        hit += any(f[1] == i for f in items.search(raw, at))
    assert hit / n >= 0.95


@pytest.mark.parametrize("words", [18, 30, 60, 120])
def test_decontamination_recall_by_length(words):
    """Whole search, items of one length, all edits of the budget at random places."""
    r = random.Random(words)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(2, 9))) for _ in range(600)]
    items = decontaminate.Items([(k, " ".join(r.choice(vocabulary) for _ in range(words))) for k in range(100)])
    texts = []
    for i in range(100):
        s = list(items.string[i])
        for _ in range(int(items.budget[i])):
            q = r.randrange(len(s))
            s[q:q + r.randint(0, 1)] = r.choice(["", "a", "x", " "])
        texts.append("Some words before that " + "".join(s) + " and some behind it too")
    found = items.search(*textnum.text_bytes(pa.array(texts)))
    assert sum((d, d) in {(f[0], f[1]) for f in found} for d in range(100)) >= 95


def test_decontamination_buckets_hold_every_item_of_a_size():
    """A window is a candidate of any item in its bucket, not only of the one that led to it."""
    items = decontaminate.Items([(0, "alpha beta gamma delta epsilon"), (1, "alpha beta gamma delta epsilot"), (2, "something else altogether here")])
    window = np.frombuffer(items.text[0], np.uint8)
    got = items.candidates([window], np.array([0]))
    assert (0, 0) in got and (0, 1) in got and (0, 2) not in got
    assert items.candidates([np.frombuffer(b"qqqqq wwwww eeeee rrrrr tttttt", np.uint8)], np.array([0])) == []
    assert decontaminate.Items([(0, ""), (1, " \n")]).search(*textnum.text_bytes(pa.array(["some text"]))) == []


def test_decontamination_equals_brute_force():
    """All documents of a table of up to 1,500 characters against every item."""
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/benchmark.parquet").to_pydict()
    items = decontaminate.Items(list(zip(t["item_id"], t["text"])))
    docs = [x for x in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()["text"] if len(x or "") <= 1500][:45]
    docs += [f"before {items.string[3][2:]} behind", "an " + items.string[7].replace("e", "E", 1) + " end"]
    got = {(d, i): e for d, i, e, _ in items.search(*textnum.text_bytes(pa.array(docs)))}
    want = {}
    for d, text in enumerate(docs):
        plain = decontaminate.normal(text).decode()
        for i, s in enumerate(items.string):
            e = decontaminate.edit_distance_within(s, plain)
            if e <= items.budget[i] and items.size[i] >= decontaminate.GRAM:
                want[d, i] = e
    assert want and got.keys() == want.keys()


def test_decontamination_short_and_unspaced_items():
    r, letters = random.Random(8), "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: "".join(r.choice(letters) for _ in range(n))
    rows = [(k, " ".join(word(r.randint(4, 9)) for _ in range(4 + k % 7))) for k in range(60)]
    rows += [(60 + k, "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(12 + 3 * k))) for k in range(20)]
    items = decontaminate.Items(rows)
    texts, want = [], []
    for i, s in rows:
        for _ in range(3):   # random edits up to the whole budget
            c = list(s)
            for _ in range(int(items.budget[i])):
                q = r.randrange(len(c))
                c[q:q + r.randint(0, 1)] = r.choice(["", "a", "x", "字"])
            around = ("前文" * 9, "後文" * 9) if i >= 60 else ("some words  before\n", "\t and some behind")
            want.append(i)
            texts.append(around[0] + "".join(c).upper().replace(" ", " \n") + around[1])
    raw, at = textnum.text_bytes(pa.array(texts))
    got = {(d, i) for d, i, _, _ in items.search(raw, at)}
    assert got >= set(enumerate(want))
    for d, i, e, _ in items.search(raw, at):
        assert e <= items.budget[i] and edit_by_hand(items.string[i], decontaminate.normal(texts[d]).decode()) == e
    import pickle

    assert len(pickle.dumps(decontaminate.Items([(0, "ab " * 10_000)]))) < 4_000_000


# -- mixing ------------------------------------------------------------------------------
def test_mix(spark):
    rows = [(i, "ab" * (i % 5), "en", f"s{i % 3}" if i % 10 else None, i) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOC)
    out = source_mix.mix(docs, {"s0": 2.0, "s1": 1.0, "*": 1.0})
    mass = {r.s: r.m for r in out.groupBy(F.coalesce("source", F.lit("null")).alias("s")).agg(F.sum(F.char_length("text")).alias("m")).collect()}
    total = sum(mass.values())
    assert mass["s0"] / total == pytest.approx(0.5, abs=0.04) and mass["s1"] / total == pytest.approx(0.25, abs=0.04)
    n = Counter(r.doc_id for r in out.collect())
    assert {r.doc_id: r.n_copies for r in out.collect()} == dict(n)
    assert source_mix.mix(docs.limit(0)).count() == 0
    twice = source_mix.mix(docs, {"*": 1.0}).count()
    assert twice == source_mix.mix(docs.repartition(7), {"*": 1.0}).count()
    cdf = source_mix.steps(2.5)
    assert cdf[0] == pytest.approx(np.exp(-2.5)) and cdf[-1] == 1.0 or abs(cdf[-1] - 1) < 1e-12


def test_mix_short_stratum_beside_a_large_corpus(spark):
    weights = source_mix.TARGET_WEIGHTS
    rows = [(i, "x" * 3000, "en", f"src{i % 20}", 3000) for i in range(2000)] + [(-1, "abc", "en", None, 3)]
    docs = spark.createDataFrame(rows, DOC)
    rate = 0.8 / sum(weights.values()) * 6_000_003 / 3   # 80,000 copies of the one row without a source
    assert source_mix.rates(docs, weights)["*"] == pytest.approx(rate) and rate > 50_000
    n, low, high, different = source_mix.mix(docs).filter("doc_id = -1").agg(
        F.count("copy_no"), F.min("copy_no"), F.max("copy_no"), F.countDistinct("copy_no")).first()
    assert abs(n - rate) < 6 * rate ** 0.5 and (low, high, different) == (0, n - 1, n)
    # the sum of parts has the mean and the variance of Poisson(2000), and the other stratum is drawn as before
    ids = spark.range(4000).select("id", F.lit("*").alias("s"))
    mean, variance = ids.select(source_mix.copies("m", F.col("id"), F.col("s"), {"*": 2000.0}).alias("n")).agg(
        F.avg("n"), F.variance("n")).first()
    assert mean == pytest.approx(2000, abs=6 * (2000 / 4000) ** 0.5) and variance == pytest.approx(2000, rel=0.15)
    got = Counter(r.doc_id for r in source_mix.mix(docs).filter("doc_id >= 0").select("doc_id").collect())
    cdf = {k: source_mix.steps(v) for k, v in source_mix.rates(docs, weights).items() if v <= source_mix.PART}
    for i in range(2000):
        drawn_by = f"{i}/{hashlib.md5(b'x' * 3000).hexdigest()}/"
        u = int(hashlib.md5(f"{source_mix.SEED}:{drawn_by}".encode()).hexdigest()[:13], 16) / 2**52
        assert got[i] == sum(c <= u for c in cdf[f"src{i % 20}"])


# -- pipeline ----------------------------------------------------------------------------
def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup",
                                                       "benchmark_decontamination", "mix_to_target_weights"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from lakegov.llm.staging import staged

    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF), name)
        if name != "mix_to_target_weights":
            assert after.columns == docs.columns
        kept[name] = (docs, after)
        docs = after
    before, after = kept["simhash_near_dedup"]
    fps = [fingerprint_by_hand(r.text) for r in after.collect()]
    assert len(fps) == len(set(least_reachable(sorted(set(fps)), 3)))
    assert after.count() == simhash_trie.near_duplicates(before).select("component_id").distinct().count()
    before, after = kept["suffix_array_dedup"]
    rows = before.orderBy("doc_id").collect()
    got = {r.doc_id: len(r.text.encode()) for r in after.collect()}
    for r, (n, gone, _, _) in zip(rows, removed_by_hand([r.text for r in rows], 200)):
        assert n - gone - 6 <= got[r.doc_id] <= n - gone  # a character cut in two goes whole
    before, after = kept["benchmark_decontamination"]
    leaks = decontaminate.matches(before, spark.read.parquet(f"{SF}/benchmark.parquet")).select("doc_id").distinct()
    assert after.count() == before.join(leaks, "doc_id", "left_anti").count()


def test_stages_on_empty_and_odd_rows(spark):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "src0", 0), (1, "", "en", "src0", 0),
                                 (2, "a few clean words", "en", None, 17)], DOC)
    for docs, most in ((odd, 4), (odd.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= most
        assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() >= 0
