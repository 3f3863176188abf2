"""Rows without an id or with a repeated one: mixing draws and toxicity fits."""

import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakegov.llm import source_mix, toxicity_chain

SF = "/root/testdata/sf0.01"


def test_mix_draws_rows_without_id_each_for_itself(spark):
    rows = [(None if i % 2 else i, "same text" if i % 4 == 1 else f"text number {i}", "s") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = source_mix.mix(docs, {"s": 1.0}, target_mass=1.5 * sum(len(r[1]) for r in rows))
    bare = out.filter("doc_id IS NULL")
    n = bare.count()
    assert abs(n - 3000) < 6 * math.sqrt(3000)
    assert len({r["n_copies"] for r in bare.collect()}) > 3
    assert bare.groupBy("mix_key").count().agg(F.max("count")).first()[0] <= 2


def test_mix_draws_texts_of_a_repeated_id_apart(spark):
    docs = spark.createDataFrame([(7, f"t{i}", "s") for i in range(1000)], "doc_id long, text string, source string")
    out = source_mix.mix(docs, {"s": 1.0}).collect()
    assert 800 < len(out) < 1200 and len({r["mix_key"] for r in out}) == len(out)


def test_toxicity_fit_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    twice = docs.unionByName(docs.filter("doc_id % 3 = 0").withColumn("text", F.concat(F.lit("another "), F.col("text"))))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    fits = [toxicity_chain.fit(twice.repartition(n), labels) for n in (1, 3, 7)]
    for other in fits[1:]:
        assert (fits[0].slot == other.slot).all()
        assert abs(fits[0].intercept - other.intercept).max() < 1e-6 and abs(fits[0].weights - other.weights).max() < 1e-6


def plain_features(text):
    """Words without closing marks and their first letters, as bytes."""
    out = set()
    for w in text.encode().lower().split():
        for _ in range(2):
            if len(w) > 1 and w[-1:] in (b".", b",", b";", b":", b"!", b"?"):
                w = w[:-1]
        out |= {(None, w)} | {(n, w[:n]) for n in toxicity_chain.PREFIXES if len(w) > n}
    return out


def plain_bucket(n, piece):
    """The feature's bucket from one text that holds nothing else."""
    doc, bucket = toxicity_chain.document_features(*toxicity_chain.X.text_bytes(pa.array([piece.decode()])))
    whole = int(bucket[0])
    if n is None:
        return whole
    longer = piece.decode() + "x"
    _, bucket = toxicity_chain.document_features(*toxicity_chain.X.text_bytes(pa.array([longer])))
    return int(bucket[1 + [k for k in toxicity_chain.PREFIXES if len(piece) + 1 > k].index(n)])


@pytest.mark.parametrize("at", [0, 400])
def test_toxicity_probabilities_equal_a_plain_chain(spark, at):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    chain = toxicity_chain.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    some = docs.filter(F.col("doc_id").between(at, at + 25)).filter("text NOT RLIKE '[^\\\\x01-\\\\x7f]'").collect()
    got = {r["doc_id"]: r for r in toxicity_chain.score(spark.createDataFrame(some, "doc_id long, text string"), chain).collect()}
    assert len(some) > 5
    for r in some:
        slots = {int(chain.slot[plain_bucket(n, p)]) for n, p in plain_features(r["text"])} - {-1}
        before = []
        for c, name in enumerate(chain.names):
            z = chain.intercept[c] + sum(chain.weights[c, s] for s in slots) + sum(w * p for w, p in zip(chain.earlier[c], before))
            before.append(1 / (1 + math.exp(-max(-30, min(30, z)))))
            assert abs(got[r["doc_id"]][f"p_{name}"] - before[-1]) < 1e-9
            assert got[r["doc_id"]][f"is_{name}"] == (before[-1] >= toxicity_chain.THRESHOLD)
