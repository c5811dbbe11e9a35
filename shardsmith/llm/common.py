"""Helpers shared by the corpus operators.

Words everywhere are the maximal runs of characters other than ASCII white
space (``[^\\x20\\x09-\\x0D]+``), lower-cased in A-Z only: exactly what
``bytes.lower().split()`` gives on UTF-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.session import shared_dir

ROW_KEY = "__row_key"
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
SHUFFLE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACE = " \t\n\x0b\x0c\r"  # the characters that separate words


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage with files every executor can reach, so a lost executor
    costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _set_within(spark: SparkSession, conf: str, value: str) -> Iterator[None]:
    """``conf`` has ``value`` within the ``with`` block, or what the session says."""
    ours = spark.conf.get(conf, None) is None
    if ours:
        spark.conf.set(conf, value)
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(conf)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """What is written within the ``with`` block goes to Python in batches of ``BATCH_BYTES``, or as the session says.

    By default a batch has 10 000 rows, and a task has several batches of texts or sets in memory, on both sides.
    """
    return _set_within(spark, BATCH_CONF, str(BATCH_BYTES))


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """The shuffle files of what is written within the ``with`` block go as soon as it is written, or as the session says.

    By default they stay until the driver happens to collect its garbage.
    """
    return _set_within(spark, SHUFFLE_CONF, "true")


def squeezed(data: bytes) -> bytes:
    """``data`` compressed, with its length before it."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def row_key(id_col: str, text_col: str) -> Column:
    """A key for a row made from its own values: equal rows share it, and it is never null."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def join_rows(left: DataFrame, right: DataFrame, id_col: str, how: str = "left") -> DataFrame:
    """Join on the row key and the id, null ids included; the right side's keys are dropped."""
    right = right.withColumnsRenamed({id_col: "__right_id", ROW_KEY: "__right_key"})
    on = (F.col(ROW_KEY) == F.col("__right_key")) & F.col(id_col).eqNullSafe(F.col("__right_id"))
    return left.join(right, on, how).drop("__right_id", "__right_key")


def words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def add_columns(df: DataFrame, make: Callable[[], Callable], inputs: list[str], fields: dict[str, T.DataType]) -> DataFrame:
    """Append columns computed in Arrow batches.

    ``make()`` runs once in each task and returns a function from the input
    columns (as lists) to one list for each new field.  An existing column of
    the same name is replaced.
    """
    kept = [c for c in df.columns if c.lower() not in {f.lower() for f in fields}]
    side = [f"__in_{i}" for i in range(len(inputs))]
    df = df.select(*kept, *(df[c].alias(s) for c, s in zip(inputs, side)))
    out = T.StructType([*(df.schema[c] for c in kept), *(T.StructField(n, t) for n, t in fields.items())])
    n, arrow = len(kept), [_arrow_type(t) for t in fields.values()]
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for b in batches:
            f = f or make()
            made = f(*(b.column(n + i).to_pylist() for i in range(len(side))))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *(pa.array(v, t) for v, t in zip(made, arrow))], names=names)

    return df.mapInArrow(run, out)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in t])
    return {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}[t.simpleString()]


def sum_vectors(df: DataFrame) -> DataFrame:
    """Add int64 vectors (``key`` string, ``part`` int, ``vec`` binary) up to one for each key.

    Two levels, so that a group holds a 256th of the tasks' vectors, then at
    most 256 of them.
    """
    import pandas as pd

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, np.int64) for v in pdf["vec"])
        return pd.DataFrame({"key": [pdf["key"].iat[0]], "part": [int(pdf["part"].iat[0])], "vec": [total.tobytes()]})

    schema = "key string, part int, vec binary"
    df = df.withColumn("part", F.col("part") % 256).groupBy("key", "part").applyInPandas(add, schema)
    return df.groupBy("key").applyInPandas(add, schema).select("key", "vec")


def word_ids(ws: list[bytes]) -> np.ndarray:
    """Dense ids of the words of one text, in order of first use."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in ws), np.int64, len(ws))


_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd constant: 2^64 over the golden ratio


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(29))
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


class WordHasher:
    """64-bit hashes of the words of a text, all at once.

    A word's hash is the sum of its bytes' table values times powers of an odd
    number, taken from running sums over the text and scrambled; upper-case
    A-Z have the values of their lower-case letters, white space ends a word.
    """

    BASE, INVERSE = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)

    def __init__(self):
        self.space = np.zeros(256, bool)
        self.space[list(SPACE.encode())] = True
        self.value = scramble(np.arange(1, 257, dtype=np.uint64))
        self.value[65:91] = self.value[97:123]
        self.value[self.space] = 0
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def _powers(self, n: int) -> list[np.ndarray]:
        if len(self.powers[0]) < n:
            n = 1 << max(16, (n - 1).bit_length())
            for k, base in enumerate((self.BASE, self.INVERSE)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                self.powers[k] = np.multiply.accumulate(p)
        return self.powers

    def __call__(self, text: str | bytes | None) -> np.ndarray:
        data = text.encode() if isinstance(text, str) else text or b""
        b = np.frombuffer(data, np.uint8)
        if not len(b):
            return np.empty(0, np.uint64)
        edge = np.ones(len(b) + 2, bool)
        edge[1:-1] = self.space[b]
        cuts = np.flatnonzero(edge[1:] != edge[:-1])
        start, end = cuts[::2], cuts[1::2]
        power, inverse = self._powers(len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.value[b] * power[: len(b)], out=total[1:])
        return scramble((total[end] - total[start]) * inverse[start])


# Odd multipliers, one for each place in a shingle of up to eight words.
_PLACES = scramble(np.arange(11, 19, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(h: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of the ``size``-word windows in order; fewer words give one hash of the whole sequence; none, none."""
    if len(h) == 0:
        return h
    k = min(size, len(h))
    n = len(h) - k + 1
    acc = h[:n] * _PLACES[0] + np.uint64(k)
    for i in range(1, k):
        acc += h[i : n + i] * _PLACES[i % 8]
    return scramble(acc)
