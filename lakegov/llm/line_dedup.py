"""Substring deduplication by line or paragraph hashing.

Texts are cut into units (lines, paragraphs between blank lines, or sentences
inside lines), units are normalised (lower case, white space collapsed). What
is hashed is a block: a unit and as many of the next units that are not empty
as give ``block_chars`` normalised characters, a paragraph that slides from
unit to unit. Block digests (128 bits) are grouped globally and only the
earliest ranked occurrence of each stays; a unit goes if any block around it
does. With ``block_chars`` 1 every unit is a block of its own. The result keeps
the offsets (code points of the original text) of all that goes; ``cut`` applies them.

``block_chars`` is what spares a short unit that happens to stand elsewhere too
(``And the.``): it goes only as part of a block that stands elsewhere. Units
at the end of a text that together fall short of ``block_chars`` begin no block;
they go with a block that reaches into them. A removed unit always has an equal
one at an earlier place, and of those the earliest stays.

Rank: document id (null last), a hash of the text, a row number among rows
without an id, place in the text. A block
that a third of all documents share costs one partial-aggregate row per task,
and AQE can split the document side of the join back. Only a document's own
removed blocks are ever gathered, in one row.

Defined cases: a null text is empty; units without a normalised character
(empty lines) belong to no block and go only between units that go;
rows that repeat both id and text are one document and give one result row;
rows without an id are documents of their own, also where the text repeats:
one of them keeps its blocks, and each has a result row;
an empty table gives no rows; other columns are not read, ``cut`` carries them
under any name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegov.llm.staging import map_arrow, staged, unused

#: What ends a unit; it is removed with its unit.
SEPARATOR = {"line": r"\n", "paragraph": r"\n[ \t\r]*\n\s*", "sentence": r"[.!?][ \t]+|\n"}
UNIT = "sentence"
BLOCK_CHARS = 150   # normalised characters of the shortest block
BLOCKS = "tie long, id_null boolean, id long, row long, unit_no long, start long, end long, block_end long, d1 long, d2 long"


def blocks_of(text: str, separator: re.Pattern, block_chars: int) -> list[tuple[int, int, int | None, bytes | None]]:
    """(start, end, end of its block, digest) per unit; no block where the text ends before ``block_chars``."""
    out, start, norms, filled = [], 0, [], []
    for stop, end in [*(m.span() for m in separator.finditer(text)), (len(text), len(text))]:
        # a mark that ends a sentence belongs to it, a line break does not
        norm = " ".join(text[start:max(stop, end)].lower().split())
        if norm:
            filled.append(len(out))
        norms.append(norm)
        out.append((start, end, None, None))
        start = end
    last, size = 0, 0          # units filled[first:last] hold ``size`` characters
    for first, u in enumerate(filled):
        while size < block_chars and last < len(filled):
            size += len(norms[filled[last]])
            last += 1
        if size < block_chars:
            break
        block = "\n".join(norms[k] for k in filled[first:last])
        out[u] = (*out[u][:2], out[filled[last - 1]][1], xxhash.xxh3_128_digest(block.encode()))
        size -= len(norms[u])
    return out


def blocks(docs: DataFrame, unit: str = UNIT, block_chars: int = BLOCK_CHARS, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per unit; ends are behind the separator, ``block_end`` and the digest are null where no block begins."""
    separator = re.compile(f"(?:{SEPARATOR[unit]})")
    schema = pa.schema([(n, pa.bool_() if k == "boolean" else pa.int64()) for n, k in (c.split() for c in BLOCKS.split(", "))])

    def cut_up(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)

        for b in batches:
            out = []
            for i, tie, row, t in zip(b["id"].to_pylist(), b["tie"].to_pylist(), b["row"].to_pylist(), b["t"]):
                for no, (start, end, block_end, digest) in enumerate(blocks_of(t.as_py(), separator, block_chars)):
                    d1, d2 = np.frombuffer(digest, np.int64).tolist() if digest else (None, None)
                    out.append((tie, i is None, i or 0, row, no, start, end, block_end, d1, d2))
                if len(out) > 50_000:
                    yield batch(out)
                    out = []
            yield batch(out)

    t = F.coalesce(F.col(text), F.lit(""))
    i = F.col(id_col).cast("long")
    row = F.when(i.isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0).cast("long"))
    return map_arrow(docs.select(i.alias("id"), F.xxhash64(t).alias("tie"), row.alias("row"), t.alias("t")), cut_up, BLOCKS)


def line_dedup(docs: DataFrame, unit: str = UNIT, block_chars: int = BLOCK_CHARS, id_col: str = "doc_id",
               text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_chars, n_units, n_removed, n_spans, spans): per
    document the characters and maximal runs that go; ``spans`` holds
    (start, end) in order."""
    u = staged(blocks(docs, unit, block_chars, id_col, text), "blocks")
    doc = ["tie", "id_null", "id", "row"]
    place = F.struct("id_null", "id", "tie", "row", "unit_no")
    judged = u.filter("d1 IS NOT NULL")
    first = (judged.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
             .drop("n"))
    first = staged(first, "first-blocks")   # a join of two plain exchanges, which AQE can split
    gone = judged.join(first, ["d1", "d2"]).filter(place != F.col("first")).select(*doc, "start", F.col("block_end").alias("end"))
    # blocks of one document that begin later end later or at the same place
    spans = gone.groupBy(*doc).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("u"))
    whole = u.groupBy(*doc).agg(F.max("end").alias("n_chars"), F.max("unit_no").alias("last"))
    # blocks that overlap or touch are one run
    starts = F.filter("u", lambda x, i: (i == 0) | (F.element_at("u", F.when(i == 0, 1).otherwise(i))["end"] < x["start"]))
    ends = F.filter("u", lambda x, i: (i == F.size("u") - 1) | (F.get("u", i + 1)["start"] > x["end"]))
    runs = F.arrays_zip(F.transform(starts, lambda x: x["start"]).alias("start"),
                        F.transform(ends, lambda x: x["end"]).alias("end"))
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    out = whole.join(spans, doc, "left").select(
        F.when(~F.col("id_null"), F.col("id")).alias("doc_id"), F.col("tie").alias("text_hash"), "n_chars",
        (F.col("last") + 1).alias("n_units"), F.coalesce("u", none).alias("u"))
    return out.select("doc_id", "text_hash", "n_chars", "n_units",
                      F.aggregate(runs, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]).alias("n_removed"),
                      F.size(starts).cast("long").alias("n_spans"),
                      F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("spans"))


def cut(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the runs of ``line_dedup`` cut from ``text``. Of the rows
    without an id that share a text, one gets the runs of the first ranked, the
    others those of the rest, which are the same for all of them."""
    i, tie, row, spans, first, rest, head = unused(docs, "id_", "tie", "row", "spans", "first", "rest", "head")
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    r = removed.select(F.col("doc_id").alias(i), F.col("text_hash").alias(tie), "n_removed", F.col("spans").alias(spans))
    n = r.filter(F.col(i).isNotNull()).drop("n_removed")
    d = docs.filter(F.col(id_col).isNotNull()).withColumns({tie: digest, i: F.col(id_col).cast("long")})
    d = d.join(n, [tie, i], "left").select(*docs.columns, spans)
    bare = docs.filter(F.col(id_col).isNull()).withColumns({tie: digest, row: F.monotonically_increasing_id()})
    bare = staged(bare, "rows-without-id")   # the row numbers are read twice
    found = r.filter(F.col(i).isNull()).groupBy(tie).agg(F.min_by(spans, "n_removed").alias(first), F.max_by(spans, "n_removed").alias(rest))
    found = staged(found.join(bare.groupBy(tie).agg(F.min(row).alias(head)), tie), "runs-without-id")
    own = F.when(F.col(row) == F.col(head), F.col(first)).otherwise(F.col(rest))
    d = d.unionByName(bare.join(found, tie, "left").select(*docs.columns, own.alias(spans)))
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("s"))
    piece = lambda a, x: F.substring(F.col(text), (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int"))
    kept = F.aggregate(F.coalesce(F.col(spans), none), start,
                       lambda a, x: F.struct(x["end"].alias("at"), F.concat(a["s"], piece(a, x)).alias("s")),
                       lambda a: F.concat(a["s"], F.substring(F.col(text), (a["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return d.withColumn(text, F.when(F.col(text).isNotNull(), kept)).drop(spans)
