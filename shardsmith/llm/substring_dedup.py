"""Substring de-duplication over content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: h = 2h + G[byte], so that
in 32 bits it depends on the last 32 bytes alone.  A chunk ends where the top
bits of h are zero, so cuts move with the content when something is inserted
before it.  Equal chunks are found by a 128-bit digest over all documents.

A chunk by itself is too short to tell a copied passage from a common phrase;
what counts is a *repeated stretch*: neighbouring chunks of a document that
all occur elsewhere too, ``min_bytes`` bytes or more in all.  Of such a
stretch the chunks that are not the first of their digest (by document, then
position) are dropped.

Defined cases: a null or empty text has no chunks and stays as it is; equal
rows (same id and text) are copies of one another, so all of their text is
repeated, but they get one result between them: neither loses what the other
has first; null ids are allowed and come first in the order; an empty table
gives an empty result; texts of any length are chunked whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.llm.common import ROW_KEY, add_columns, join_rows, row_key
from shardsmith.llm.runs import mark_runs

GEAR = np.array([xxhash.xxh3_64_intdigest(bytes([b])) & 0xFFFFFFFF for b in range(256)], np.uint32)


def chunk_ends(data: bytes, bits: int = 5, least: int = 16, most: int = 128) -> list[int]:
    """Ends of the chunks of ``data``: at gear cuts, at least ``least`` and at most ``most`` bytes apart, never within a character."""
    b = np.frombuffer(data, np.uint8)
    h = GEAR[b]
    for width in (1, 2, 4, 8, 16):  # doubles the bytes that h depends on
        h[width:] += h[:-width] << np.uint32(width)
    cut = (h >> np.uint32(32 - bits)) == 0
    cut[:-1] &= (b[1:] & 0xC0) != 0x80
    ends, start = [], 0
    n = len(data)
    for c in [*(np.flatnonzero(cut) + 1).tolist(), n]:
        while c - start > most:
            e = start + most
            while data[e] & 0xC0 == 0x80:
                e -= 1
            ends.append(e)
            start = e
        if c - start >= least or c == n:
            if c > start:
                ends.append(c)
            start = c
    return ends


def chunks(docs: DataFrame, bits: int = 5, least: int = 16, most: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each chunk: digest (``k1``, ``k2``), document, byte span and whether it is the document's last."""
    src = docs.select(id_col, row_key(id_col, text_col).alias(ROW_KEY), F.col(text_col).cast("binary").alias("__bytes")).filter(F.length("__bytes") > 0)
    schema = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), src.schema[id_col], T.StructField(ROW_KEY, T.LongType()), T.StructField("pos", T.LongType()), T.StructField("end", T.LongType())])

    def run(batches):
        for b in batches:
            at, start, end, digests = [], [], [], []
            for i, data in enumerate(b.column(2).to_pylist()):
                s = 0
                for e in chunk_ends(data, bits, least, most):
                    digests.append(xxhash.xxh3_128_digest(data[s:e]))
                    at.append(i)
                    start.append(s)
                    end.append(e)
                    s = e
            d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = pa.array(np.array(at, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), b.column(0).take(at), b.column(1).take(at), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=schema.names)

    return src.mapInArrow(run, schema)


def repeated_stretches(docs: DataFrame, min_bytes: int = 100, bits: int = 5, least: int = 16, most: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row key, stretches, dropped): for documents with a repeated stretch, the byte spans of
    the stretches and of what is dropped of them."""
    marked = mark_runs(chunks(docs, bits, least, most, id_col, text_col), id_col, 2, False, "chunk_runs")
    spans = marked.groupBy(id_col, ROW_KEY).agg(F.collect_list(F.struct("pos", "end", "is_first")).alias("found"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

    def make():
        def join(found):
            stretches, dropped = [], []
            for rows in found:
                firsts = {(r["pos"], r["end"]) for r in rows if r["is_first"]}
                rows = [(s, e, (s, e) not in firsts) for s, e in sorted({(r["pos"], r["end"]) for r in rows})]
                whole, gone = [], []
                i = 0
                while i < len(rows):
                    j = i + 1
                    while j < len(rows) and rows[j][0] == rows[j - 1][1]:
                        j += 1
                    if rows[j - 1][1] - rows[i][0] >= min_bytes:
                        whole.append({"start": rows[i][0], "end": rows[j - 1][1]})
                        for s, e, later in rows[i:j]:
                            if later and gone and gone[-1]["end"] == s:
                                gone[-1]["end"] = e
                            elif later:
                                gone.append({"start": s, "end": e})
                    i = j
                stretches.append(whole)
                dropped.append(gone)
            return [stretches, dropped]

        return join

    spans = add_columns(spans, make, ["found"], {"stretches": span, "dropped": span}).drop("found")
    return spans.filter(F.size("stretches") > 0)


def drop_repeats(docs: DataFrame, min_bytes: int = 100, bits: int = 5, least: int = 16, most: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the dropped spans, with ``n_repeated`` (bytes in repeated stretches), ``n_dropped`` (bytes dropped) and the spans."""
    extra = ("n_bytes", "n_repeated", "n_dropped", "stretches", "dropped")
    names = [c for c in docs.columns if c not in extra]
    base = docs.select(*names).withColumn(ROW_KEY, row_key(id_col, text_col))
    found = repeated_stretches(docs, min_bytes, bits, least, most, id_col, text_col)
    joined = join_rows(base, found, id_col).select(*names, "stretches", "dropped")

    def make():
        def cut(texts, dropped):
            out = []
            for text, gone in zip(texts, dropped):
                if gone:
                    data, s, kept = text.encode(), 0, []
                    for g in gone:
                        kept.append(data[s : g["start"]])
                        s = g["end"]
                    text = (b"".join(kept) + data[s:]).decode()
                out.append(text)
            return [out]

        return cut

    total = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]), F.lit(0).cast("long"))
    joined = joined.select(*names, F.coalesce(F.octet_length(text_col).cast("long"), F.lit(0).cast("long")).alias("n_bytes"), total("stretches").alias("n_repeated"), total("dropped").alias("n_dropped"), "stretches", "dropped")
    return add_columns(joined, make, [text_col, "dropped"], {text_col: T.StringType()}).select(*names, *extra)
