"""Language identification: code distances, a plain Python form, held-out accuracy, odd rows."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lakegov.llm import language_id as L
from tests.conftest import SF0001

SCHEMA = "doc_id long, text string, lang string, score string, held_out string"


@pytest.mark.parametrize("n,bits,apart", [(2, 1, 1), (3, 3, 2), (4, 7, 4), (5, 15, 8)])
def test_exhaustive_code(n, bits, apart):
    words = L.code(n)
    assert words.shape == (n, bits)
    assert {int((words[i] != words[j]).sum()) for i in range(n) for j in range(i)} == {apart}
    columns = {tuple(c) for c in words.T} | {tuple(-c) for c in words.T}
    assert len(columns) == 2 * bits


def test_random_code_separates_many_languages():
    words = L.code(60)
    assert min(int((words[i] != words[j]).sum()) for i in range(60) for j in range(i)) >= 6


def plain_grams(text):
    raw = [b if b > 127 or chr(b).isalpha() else 32 for b in text.lower().encode()]
    return [tuple(raw[i:i + k]) for k in L.LENGTHS for i in range(len(raw) - k + 1)]


def plain_bucket(gram):
    number = 0
    for b in gram:
        number = number << 8 | b
    h = (number * 0x9E3779B1 + (len(gram) * 0x85EBCA6B & 0xFFFFFFFF)) & 0xFFFFFFFF
    h ^= h >> 15
    h = h * 0x2C1B3C6D & 0xFFFFFFFF
    return h >> 17


def test_margins_equal_plain_sums():
    rng = np.random.default_rng(1)
    words = L.code(3)
    table = np.vstack([rng.normal(size=(L.BUCKETS, 3)), np.zeros((1, 3))]).astype(np.float32)
    model = L.Languages(["a", "b", "c"], words, table, np.array([1.0, 2.0, 0.5]), np.array([0.1, 0.0, -0.2]), np.full((3, 3), 1 / 3))
    texts = ["", "A", "Élan vital, 12!", "x" * 3000, "日本語 text", None, "ab"]
    got = model.margins(pa.array(texts, pa.string()))
    for t, row in zip(texts, got):
        grams = plain_grams(t or "")
        total = sum((table[plain_bucket(g)].astype(float) for g in grams), np.zeros(3))
        assert np.allclose(row, total / math.sqrt(len(grams) + 1) * model.slope + model.offset, atol=1e-3)


def test_decoding_weighs_losses():
    words = L.code(3)
    trust = np.array([[0.8, 0.1, 0.1], [0.1, 0.8, 0.1], [1 / 3, 1 / 3, 1 / 3]])
    model = L.Languages(["a", "b", "c"], words, None, None, None, trust)
    m = np.array([[2.0, -1.0, 0.5]])
    want = [sum(trust[i, j] * math.log1p(math.exp(-m[0, j] * words[i, j])) for j in range(3)) for i in range(3)]
    assert np.allclose(model.losses(m)[0], want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = L.identify(docs, L.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = [(i, "alpha beta gamma delta " * 5 if i % 2 else "uno dos tres cuatro " * 5, "en" if i % 2 else "es", None, None) for i in range(80)]
    lied = [r if zlib.crc32(str(r[0]).encode()) % 5 else (*r[:2], "xx", *r[3:]) for r in rows]
    out = [sorted(map(tuple, L.identify(spark.createDataFrame(t, SCHEMA), L.fit(spark.createDataFrame(t, SCHEMA))).collect())) for t in (rows, lied)]
    assert out[0] == out[1] and {r[2] for r in out[0]} == {"en", "es"}


def test_odd_rows(spark):
    base = [(i, t * 4, g, "s", "h") for i in range(40) for t, g in (("the cat and the dog ", "en"), ("le chat et le chien ", "fr"))]
    odd = [(1000, None, "en", "s", "h"), (1001, "", "fr", "s", "h"), (1002, "12 !? 34", "en", "s", "h"), (None, "the cat and", None, "s", "h"),
           (1003, "the dog " * 200_000, None, None, None), (1003, "le chien et le chat", None, None, None), (1004, "日本", None, "s", "h")]
    train = spark.createDataFrame(base + odd, SCHEMA)
    model = L.fit(train)
    assert model.names == ["en", "fr"]
    got = [tuple(r)[:4] for r in L.identify(spark.createDataFrame(odd, SCHEMA), model).collect()]
    by = {(r[0], r[2]) for r in got}
    assert len(got) == len(odd)
    assert {(1000, "und"), (1001, "und"), (1002, "und"), (None, "en"), (1003, "en"), (1003, "fr")} <= by
    assert [r[3] for r in got if r[2] == "und"] == [0.0] * 3 and [r[1] for r in got if r[0] is None] == [True]
    empty = spark.createDataFrame([], SCHEMA)
    assert L.identify(empty, L.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in L.identify(train, L.fit(empty)).collect()} == {"und"}
    one = L.fit(spark.createDataFrame([r for r in base if r[2] == "en"], SCHEMA))
    assert {(r["lang_pred"], r["score"]) for r in L.identify(train, one).collect()} == {("en", 1.0), ("und", 0.0)}


def test_same_result_on_any_partitioning(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    outs = []
    for n in (1, 5):
        d = docs.repartition(n)
        outs.append({r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in L.identify(d, L.fit(d)).collect()})
    assert outs[0] == outs[1]
