"""Line de-duplication.

Hashes of the lines are range-partitioned and sorted by document and
position; the pass over them (``runs``) streams first occurrences and counts,
and the result is a compressed keep bitmap for each document that loses a
line, never text.  ``apply_keep`` joins bitmaps and texts.

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased; keys without a code point are never dropped.  Two rules:

* ``at_least=k``: a key found in k documents or more loses all its lines;
* ``keep_first=True``: every line after the key's first occurrence goes.

Defined cases: a null or empty text is one empty line, kept; equal rows (same
id and text) count as one document and get the same bitmap; ids may be null;
ties in the order fall to the row key, then the position; an empty table
gives no bitmaps; other columns are not touched.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.llm.common import ROW_KEY, SPACE, add_columns, join_rows, row_key
from shardsmith.llm.runs import mark_runs


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each line with a key: the key's 128-bit hash, document, position and the document's line count."""
    src = docs.select(F.col(id_col), row_key(id_col, text_col).alias(ROW_KEY), F.col(text_col).cast("binary").alias("__bytes")).filter(F.length("__bytes") > 0)
    schema = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), src.schema[id_col], T.StructField(ROW_KEY, T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("n_lines", T.IntegerType())])

    def run(batches):
        space = SPACE.encode()
        for b in batches:
            hashes, at, pos, size = [], [], [], []
            for i, data in enumerate(b.column(2).to_pylist()):
                lines = data.split(b"\n")
                for k, line in enumerate(lines):
                    key = line.strip(space).lower()
                    if key:
                        hashes.append(xxhash.xxh3_128_digest(key))
                        at.append(i)
                        pos.append(k)
                        size.append(len(lines))
            d = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), b.column(0).take(rows), b.column(1).take(rows), pa.array(pos, pa.int32()), pa.array(size, pa.int32())], names=schema.names)

    return src.mapInArrow(run, schema)


def keep_bitmaps(docs: DataFrame, at_least: int = 10, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row key, n_lines, n_dropped, keep) for the documents that lose a line.

    ``keep``: zlib-compressed bits, least significant first, bit i set when line i stays.
    """
    marked = mark_runs(line_hashes(docs, id_col, text_col), id_col, 2 if keep_first else at_least, not keep_first, "line_runs")
    if keep_first:
        marked = marked.filter(~F.col("is_first"))
    # equal rows give the same positions more than once
    lost = marked.groupBy(id_col, ROW_KEY, "n_lines").agg(F.collect_set("pos").alias("lost"))

    def make():
        def bits(sizes, lost):
            out = []
            for n, gone in zip(sizes, lost):
                keep = np.ones(n, np.uint8)
                keep[gone] = 0
                out.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            return [out]

        return bits

    lost = lost.withColumn("n_dropped", F.size("lost").cast("long"))
    return add_columns(lost, make, ["n_lines", "lost"], {"keep": T.BinaryType()}).drop("lost")


def apply_keep(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines dropped that the bitmaps name, and ``n_lines`` and ``n_dropped``.

    A null text stays null.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    docs = docs.select(*names).withColumn(ROW_KEY, row_key(id_col, text_col))
    right = bitmaps.select(F.col(id_col), F.col(ROW_KEY), "n_dropped", F.col("keep").alias("__keep"))
    joined = join_rows(docs, right, id_col).select(*names, "n_dropped", "__keep")

    def make():
        def cut(texts, keeps):
            out = []
            for text, keep in zip(texts, keeps):
                if keep is not None:
                    lines = text.split("\n")
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines), bitorder="little")
                    text = "\n".join([x for x, k in zip(lines, bits) if k])
                out.append(text)
            return [out]

        return cut

    n_lines = F.coalesce(F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1, F.lit(1)).cast("long")
    joined = joined.withColumn("n_lines", n_lines).withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0).cast("long")))
    return add_columns(joined, make, [text_col, "__keep"], {text_col: T.StringType()}).select(*names, "n_lines", "n_dropped")


def drop_lines(docs: DataFrame, at_least: int = 10, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that the rule drops, and ``n_lines`` and ``n_dropped``."""
    return apply_keep(docs, keep_bitmaps(docs, at_least, keep_first, id_col, text_col), id_col, text_col)
