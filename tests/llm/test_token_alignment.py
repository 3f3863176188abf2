"""Token alignment against a plain Python form over both libraries; merges and frames."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakegov.llm import token_alignment as T
from lakegov.llm.token_prefix import byte_alphabet

SCHEMA = "doc_id long, text string, n_a string, run string"
OUT = ["doc_id", *T.OUT, "groups_sha256"]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain(docs, a_side, b_side):
    byte, name = byte_alphabet(), {i: s for s, i in a_side.get_vocab().items()}
    links_of, out, holders = [], [], defaultdict(int)
    for i, text in docs:
        links, row = [], [i, 0, 0, 0, 0, 0, 0, ""]
        if text:
            a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
            ab = [bytes(byte[c] for c in name[k]) for k in a]
            bb = [bytes([int(b_side.id_to_piece(k)[3:5], 16)]) if b_side.is_byte(k) else b_side.id_to_piece(k).replace("▁", " ").encode() for k in b]
            want = b" " + text.encode()
            if b"".join(ab) == b"".join(bb) == want:
                owner_a = [p for p, x in enumerate(ab) for _ in x]
                owner_b = [p for p, x in enumerate(bb) for _ in x]
                seen = list(dict.fromkeys(zip(owner_a, owner_b)))
                links = [(a[p], b[q]) for p, q in seen]
                ends = [n + 1 for n in range(len(want)) if (n + 1 == len(want)) or (owner_a[n] != owner_a[n + 1] and owner_b[n] != owner_b[n + 1])]
                groups, at = [], 0
                for e in ends:
                    pa, pb = (list(dict.fromkeys(o[at:e])) for o in (owner_a, owner_b))
                    groups.append(",".join(str(a[p]) for p in pa) + "|" + ",".join(str(b[p]) for p in pb))
                    at = e
                row = [i, len(a), len(b), len(groups), len(links), 0, 0, hashlib.sha256(";".join(groups).encode()).hexdigest()]
        for pair in set(links):
            holders[pair] += 1
        links_of.append(links)
        out.append(row)
    most = defaultdict(int)
    for (p, _), n in holders.items():
        most[p] = max(most[p], n)
    for row, links in zip(out, links_of):
        row[5], row[6] = sum(holders[x] == most[x[0]] for x in links), sum(holders[x] for x in links)
    return sorted(map(tuple, out), key=repr)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, "other", "column") for i, t in rows], SCHEMA)
    out = T.token_alignment(docs, *T.paths(), **how)
    assert out.columns == OUT
    return sorted(map(tuple, out.collect()), key=repr)


ODD = [(1, None), (2, ""), (3, " "), (4, "\n\t \r\n"), (5, "<|endoftext|> <s></s> <unk> <0x41>"), (6, "▁under▁line"), (None, "no id here"),
       (None, "no id here"), (7, "é漢😀́ ﬁ ｆｕｌｌ"), (8, "same text"), (8, "same text"), (9, "x" * 5000), (10, "  two  spaces "), (11, "\U0003D7AD's"),
       (12, "word " * 30_000)]


@pytest.mark.parametrize("how", [{}, {"run_bytes": 40, "fan": 3, "radix": 4}])
def test_odd_rows(spark, sides, how):
    assert found(spark, ODD, **how) == plain(ODD, *sides)


@pytest.mark.parametrize("how", [{}, {"run_bytes": 9_000, "fan": 4, "radix": 7}, {"run_bytes": 20_000, "fan": 2, "radix": 3}])
def test_whole_table(spark, sides, how):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(map(tuple, T.token_alignment(docs, *T.paths(), **how).collect()), key=repr)
    assert got == plain(rows, *sides)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_merge_of_runs():
    rnd = random.Random(1)
    want, streams = defaultdict(int), []
    for _ in range(9):
        keys = sorted(rnd.sample(range(5000), rnd.randint(0, 900)))
        counts = [rnd.randint(1, 1 << 40) for _ in keys]
        for k, c in zip(keys, counts):
            want[k] += c
        spans = [(lo, lo + 50) for lo in range(0, len(keys), 50)]
        streams.append(([T.pack_steps(np.array(keys[lo:hi], np.int64)) for lo, hi in spans],
                        [T.pack(np.array(counts[lo:hi], np.uint64)) for lo, hi in spans]))
    keys, counts = T.merge(streams)
    assert list(zip(keys.tolist(), counts.tolist())) == sorted(want.items())


def test_frames_give_numbers_back():
    for x in (np.array([0, 5, 5, 1 << 50], np.int64), np.zeros(0, np.int64), np.arange(3000, dtype=np.int64) * 7):
        assert (T.unpack(T.pack(x), np.int64) == x).all()
        assert (T.unpack_steps(T.pack_steps(x), np.int64) == x).all()
