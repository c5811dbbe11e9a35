"""Quality rules from tokeniser fertility.

A public vocabulary measures each text: characters per token, the share of
tokens that are byte fallback (their bytes are no whole characters) and the
entropy of the tokens.  Rejection bands hold for a language and an octave of
the token count (entropy depends on length): the quartiles of all documents
that pass the base rules, widened by ``spread`` times their distance and by
``floor`` of the median at least.  A group of fewer than ``min_group``
documents goes by the first wider one that is large enough: its octave with
both neighbours, its language in all octaves, its script, or the whole corpus
however small.  In a band over octaves a text's entropy is low only if it is
so in bits and as a share of the most that its token count allows: bits grow
with the length, the share falls.  A document without a language goes by its
script.  Quartiles are exact: values are integers (thousandths), counted over
all documents.

Base rules: fewer than 50 words, or more than half of the words in 3-word
windows that occur twice.

Defined cases: a null or empty text has no words and fails the base rules;
null ids and languages are allowed; equal rows are judged each and alike;
input columns named like an output are replaced; an empty table gives an
empty result; texts of any length are read whole.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.llm.common import SPACE, add_columns, materialize, word_ids

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# The pre-token pattern that the byte-level vocabularies were made with.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SYMBOLS = "#*$%&|<>"
PARTS = re.compile(r"\S+\s*|\s+")

METRICS = {
    "n_words": T.LongType(), "word_chars": T.LongType(), "n_symbols": T.LongType(), "n_dup_lines": T.LongType(),
    "n_repeat_words": T.LongType(), "n_tokens": T.LongType(), "chars_per_token": T.LongType(),
    "fallback_share": T.LongType(), "token_entropy": T.LongType(), "script": T.StringType(),
}
#: The measures with a band, and whether it has a lower and an upper end.
BANDS = {"chars_per_token": (True, True), "fallback_share": (False, True), "token_entropy": (True, False)}


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    ws = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(x for x in text.split("\n") if x.strip(SPACE))
    repeated = 0
    if len(ws) >= 4:
        i = word_ids(ws)
        n = int(i.max()) + 1
        window = (i[:-2] * n + i[1:-1]) * n + i[2:] if n < 2_000_000 else _window_ids(i, n)
        _, at, found = np.unique(window, return_inverse=True, return_counts=True)
        twice = found[at] > 1
        hit = np.zeros(len(i), bool)
        for k in range(3):
            hit[k : k + len(twice)] |= twice
        repeated = int(hit.sum())
    return len(ws), chars, symbols, sum(lines.values()) - len(lines), repeated


def _window_ids(i: np.ndarray, n: int) -> np.ndarray:
    pair = np.unique(i[:-1] * n + i[1:], return_inverse=True)[1].astype(np.int64)
    return pair[:-1] * n + i[2:]


def load_vocabulary(name: str, data: bytes):
    """(encode, fallback): token ids of a text as an array, and for each id whether its bytes are no whole characters.

    ``data`` is the file: ``.tiktoken`` ranks or a ``.model`` of pieces.
    """
    if name.endswith(".tiktoken"):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        enc = tiktoken.Encoding("public", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        fallback = np.zeros(max(ranks.values()) + 1, bool)
        for token, i in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                fallback[i] = True
        return lambda text: np.array(enc.encode_ordinary(text), np.int64), fallback
    if name.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        fallback = np.array([sp.is_byte(i) or sp.is_unknown(i) for i in range(sp.get_piece_size())])
        return lambda text: np.array(sp.encode(text), np.int64), fallback
    raise ValueError(f"no reader for the vocabulary {name}")


def token_counts(text: str, encode, size: int) -> np.ndarray:
    """How often each token id occurs.  Very long texts are encoded in parts that end with white space."""
    total = np.zeros(size, np.int64)
    for start, end in _cut(text, 100_000):
        total += np.bincount(encode(text[start:end]), minlength=size)
    return total


def _cut(text: str, most: int):
    start = 0
    while len(text) - start > most:
        end = max(text.rfind(" ", start, start + most), text.rfind("\n", start, start + most))
        end = end if end > start else start + most
        yield start, end
        start = end
    yield start, len(text)


def fertility(text: str | None, encode, fallback: np.ndarray) -> tuple[int, int, int, int]:
    """n_tokens, and in thousandths: characters per token, share of fallback tokens, entropy in bits."""
    if not text:
        return 0, 0, 0, 0
    counts = token_counts(text, encode, len(fallback))
    at = np.flatnonzero(counts)
    found = counts[at]
    n = int(found.sum())
    if n == 0:
        return 0, 0, 0, 0
    p = found / n
    return n, round(1000 * len(text) / n), round(1000 * int(found[fallback[at]].sum()) / n), round(-1000 * float((p * np.log2(p)).sum()))


def script_of(text: str | None) -> str:
    """The script that most letters belong to, by the first word of their Unicode names; none without letters."""
    best: Counter = Counter()
    for c, n in Counter(text or "").items():
        if c.isalpha():
            best["LATIN" if c.isascii() else unicodedata.name(c, "OTHER").split(" ")[0]] += n
    return min(best, key=lambda s: (-best[s], s)) if best else "none"


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file (about 2 MB at most), from the driver's disk or any store that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).head()["content"])
    with open(path, "rb") as f:
        return f.read()


def measure(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of METRICS and ``base_failed``."""
    data = read_bytes(docs.sparkSession, vocabulary)
    shipped = docs.sparkSession.sparkContext.broadcast(data)  # one vocabulary file

    def make():
        encode, fallback = load_vocabulary(vocabulary, shipped.value)

        def rows(texts):
            made = [(*base_counts(t), *fertility(t, encode, fallback), script_of(t)) for t in texts]
            return list(zip(*made)) if made else [[] for _ in METRICS]

        return rows

    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return add_columns(docs, make, [text_col], METRICS).withColumn("base_failed", failed)


def _group(lang_col: str | None) -> Column:
    return F.coalesce(F.col(lang_col), F.col("script")) if lang_col else F.col("script")


#: (column, octaves beside the own one, none for all) of each level, from the narrowest group to the widest.
LEVELS = [("__group", (0,)), ("__group", (-1, 0, 1)), ("__group", None), ("script", None), (None, None)]
SHARE = "entropy_share"


def fit_bands(measured: DataFrame, lang_col: str | None = "lang", spread: float = 6.0, floor: float = 0.1, min_group: int = 50) -> DataFrame:
    """(group, script, octave, <measure>_low, <measure>_high): the bands, from all documents that pass the base rules.

    Written as a table, so that its size is known when it is joined: documents of one group are many.
    """
    rows = measured.select("base_failed", _group(lang_col).alias("__group"), "script", _octave().alias("__octave"), *BANDS, _share().alias(SHARE))
    levels = []  # the groups that a document counts in
    for k, (by, octaves) in enumerate(LEVELS):
        name = F.col(by) if by else F.lit("")
        levels += [F.struct(F.lit(k).alias("level"), name.alias("name"), F.lit(-1).alias("at") if o is None else (F.col("__octave") + o).alias("at")) for o in octaves or (None,)]
    measures = {**BANDS, SHARE: (True, False)}
    ok = rows.filter(~F.col("base_failed")).select(F.explode(F.array(*levels)).alias("g"), *measures).select("g.*", *measures)
    quartiles = ok.groupBy("level", "name", "at").agg(F.count(F.lit(1)).alias("__n"), *(F.percentile(m, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(m) for m in measures))
    cols = []
    for m, (low, high) in measures.items():
        q1, q2, q3 = (F.col(m)[i] for i in range(3))
        # a share that is 0 for most has quartiles of 0: 100 thousandths are always allowed
        room = F.greatest(spread * (q3 - q1), floor * q2, F.lit(100.0 if m == "fallback_share" else 1.0))
        if m == SHARE:  # within one octave bits are enough
            cols.append(F.when(F.col("level") > 0, q1 - room).alias(f"{m}_low"))
            continue
        cols += [(q1 - room if low else F.lit(None).cast("double")).alias(f"{m}_low"), (q3 + room if high else F.lit(None).cast("double")).alias(f"{m}_high")]
    large = (F.col("__n") >= min_group) | (F.col("level") == len(LEVELS) - 1)
    bands = materialize(quartiles.filter(large).select("level", "name", "at", F.struct(*cols).alias("band")), "quality_levels")
    out = materialize(rows.select("__group", "script", "__octave").distinct(), "quality_groups")
    for k, (by, octaves) in enumerate(LEVELS):
        name = F.col(by) if by else F.lit("")
        here = bands.filter(F.col("level") == k).select(F.col("name").alias("__name"), F.col("at").alias("__at"), F.col("band").alias(f"__band_{k}"))
        out = out.withColumn("__name", name).withColumn("__at", F.col("__octave") if octaves else F.lit(-1)).join(here, ["__name", "__at"], "left").drop("__name", "__at")
    out = out.withColumn("band", F.coalesce(*(f"__band_{k}" for k in range(len(LEVELS)))))
    return materialize(out.select("__group", F.col("script").alias("__script"), "__octave", "band.*"), "quality_bands")


def _octave() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")


def _share() -> Column:
    """The entropy in thousandths of the most that the token count allows."""
    return F.round(1000 * F.col("token_entropy") / (1000 * F.log2(F.greatest(F.col("n_tokens"), F.lit(2))))).cast("long")


def judge(measured: DataFrame, bands: DataFrame, lang_col: str | None = "lang") -> DataFrame:
    """``measured`` with ``rejected_by`` (the measures out of their band) and ``kept``."""
    names = [c for c in measured.columns if c not in ("rejected_by", "kept")]
    left = measured.select(*names).withColumn("__group", _group(lang_col)).withColumn("__script", F.col("script")).withColumn("__octave", _octave())
    joined = left.join(bands, ["__group", "__script", "__octave"], "left")
    low = {m: F.col(m) < F.col(f"{m}_low") for m in BANDS}
    low["token_entropy"] &= F.col(f"{SHARE}_low").isNull() | (_share() < F.col(f"{SHARE}_low"))
    out = [F.when(low[m] | (F.col(m) > F.col(f"{m}_high")), F.lit(m)) for m in BANDS]
    joined = joined.withColumn("rejected_by", F.concat_ws(",", *out))
    return joined.select(*names, "rejected_by", (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"))


def quality_rules(docs: DataFrame, vocabulary: str = VOCABULARY, lang_col: str | None = "lang", text_col: str = "text", spread: float = 6.0, floor: float = 0.1, min_group: int = 50) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``rejected_by`` and ``kept``.

    Encoding is the dear part; its result is written once, then read for the
    bands and for the verdicts.
    """
    measured = materialize(measure(docs, vocabulary, text_col), "quality")
    return judge(measured, fit_bands(measured, lang_col, spread, floor, min_group), lang_col)
