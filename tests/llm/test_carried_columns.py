"""Operators that carry a caller's columns give every one of them back, whatever its name."""

import pytest

from lakegov.llm import decontaminate, importance, line_dedup, quality_rules, simhash_trie, source_mix, suffix_dedup

NAMES = ["weighed", "log_weight", "null", "id_", "digest", "body", "check", "found", "spans", "tie", "row", "first", "rest", "head", "drawn_by",
         "stratum", "cut_repeats", *(f"q_{x}" for x in "twnhmscepl"), "text_hash", "fp", "runs", "t", "c", "d", "w", "n", "at", "k", "root"]
NAMES += [f"_{n}" for n in NAMES] + ["_hash", "_text", "_target", "_d2", "score", "kept_text"]

CARRY = {
    "keep_selected": lambda docs, labels: importance.keep_selected(docs, importance.fit(docs, labels)[0], float("-inf")),
    "with_weights": lambda docs, labels: importance.with_weights(docs, importance.fit(docs, labels)[0], keep_text=True, name="new_weight"),
    "keep_one": lambda docs, labels: simhash_trie.keep_one(docs),
    "suffix_cut": lambda docs, labels: suffix_dedup.cut(docs),
    "line_cut": lambda docs, labels: line_dedup.cut(docs, line_dedup.line_dedup(docs)),
    "features": lambda docs, labels: quality_rules.features(docs),
    "quality_rules": lambda docs, labels: quality_rules.quality_rules(docs, labels),
    "mix": lambda docs, labels: source_mix.mix(docs, {"s": 1.0}),
    "clean": lambda docs, labels: decontaminate.clean(docs, docs.sparkSession.createDataFrame([(1, "the only item of it")], "item_id long, text string")),
}


@pytest.mark.parametrize("name", CARRY)
def test_columns_come_back(spark, name):
    words = ["alpha beta gamma", "delta epsilon", "zeta eta theta iota", "kappa lambda mu"]
    rows = [(i, f"{words[i % 4]} {i} " * (3 + i) + f"end {i * i}", "en", "s", 10, *(f"{n} of {i}" for n in NAMES)) for i in range(8)]
    rows.append((None, None, None, None, None, *(None for _ in NAMES)))
    schema = ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *(f"`{n}` string" for n in NAMES)])
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    out = CARRY[name](docs, labels)
    want = {r[0]: r[5:] for r in rows}
    got = out.select("doc_id", *NAMES).collect()
    assert got and all(tuple(r)[1:] == want[r["doc_id"]] for r in got)
    if name not in ("mix", "keep_selected"):
        assert len(got) == len(rows)
