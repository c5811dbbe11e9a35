"""Language identification by mixture inference.

Each language has a distribution over hashed letter trigrams, counted over
all training documents.  A document is a mixture: expectation-maximisation
finds the proportions under which its trigrams are likeliest, and backward
elimination keeps the set of languages with the best penalised likelihood
(half the log of the number of independent trigrams, a third of all, for each
language).  The prediction is the language with the largest proportion, the
score that proportion.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
so is everything when no training row has a language; ties go to the
language that sorts first; null ids are never held out; equal rows count
each in training and are predicted alike; input columns named like an output
are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.llm.common import _MIX, add_columns, sum_vectors

BITS = 16
UNKNOWN = "und"
MAX_LANGUAGES = 400  # 512 kB of model each; more raise an error


_TABLES: dict[str, np.ndarray] = {}  # made once in each worker


def _letters() -> np.ndarray:
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _TABLES["letters"]


def trigrams(text: str | None) -> np.ndarray:
    """Hashes (``BITS`` bits) of the trigrams around each letter; what is no letter counts as a space."""
    c = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[c]
    c = np.where(letter, c, 32).astype(np.uint64)
    h = (c[:-2] << np.uint64(42)) ^ (c[1:-1] << np.uint64(21)) ^ c[2:]
    h = (h[letter[1:-1]] * _MIX) ^ np.uint64(0x5BD1E995)
    return ((h ^ (h >> np.uint64(29))) * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and a matrix (language, trigram) of probabilities, from every row with a language and a text."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string"), text_col)

    def count(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        total: dict[str, np.ndarray] = {}

        def out():
            keys = list(total)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([part] * len(keys), pa.int32()), pa.array([total[k].tobytes() for k in keys], pa.binary())], names=["key", "part", "vec"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = np.bincount(trigrams(text), minlength=1 << BITS)
                if lang in total:
                    total[lang] += found
                else:
                    total[lang] = found
            if len(total) > 64:
                yield out()
                total.clear()
        yield out()

    sums = sum_vectors(rows.mapInArrow(count, "key string, part int, vec binary"))
    model = {r["key"]: np.frombuffer(r["vec"], np.int64) for r in sums.orderBy("key").limit(MAX_LANGUAGES + 1).toLocalIterator()}
    if len(model) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    langs = sorted(k for k, v in model.items() if v.sum())
    table = np.array([(model[k] + 0.5) / (model[k].sum() + 0.5 * (1 << BITS)) for k in langs]).reshape(len(langs), 1 << BITS)
    return langs, table


def mix(p: np.ndarray, n: np.ndarray, rounds: int = 40, tol: float = 1e-4) -> tuple[np.ndarray, float]:
    """Proportions of the languages and the log-likelihood: ``p`` (language, trigram), ``n`` the trigrams' counts."""
    total = n.sum()
    w = np.full(len(p), 1 / len(p))
    for _ in range(rounds):
        s = w @ p
        new = w * (p @ (n / s)) / total
        done = np.abs(new - w).max() < tol
        w = new
        if done:
            break
    return w, float(n @ np.log(w @ p))


def infer(text: str | None, table: np.ndarray) -> dict[int, float]:
    """The languages of a text (rows of ``table``) with their proportions; nothing without letters."""
    if not text or not len(table):
        return {}
    found = np.bincount(trigrams(text), minlength=1 << BITS)
    at = np.flatnonzero(found)
    if not len(at):
        return {}
    n = found[at].astype(np.float64)
    p = table[:, at]
    penalty = 3 * 0.5 * np.log(max(n.sum() / 3, 2))  # in units of the dependent trigrams
    live = np.arange(len(table))
    w, value = mix(p, n)
    few = live[w >= 0.01]
    if len(few) < len(live):  # those at almost nothing go at once
        live = few
        w, value = mix(p[live], n)
    best = (value - penalty * len(live), live, w)
    while len(live) > 1:
        live = np.delete(live, int(np.argmin(w)))
        w, value = mix(p[live], n) if len(live) > 1 else (np.ones(1), float(n @ np.log(p[live[0]])))
        if value - penalty * len(live) <= best[0]:
            break
        best = (value - penalty * len(live), live, w)
    return {int(i): float(x) for i, x in zip(best[1], best[2])}


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``mixture`` (``lang:share`` by falling share)."""
    shipped = docs.sparkSession.sparkContext.broadcast(table)  # MAX_LANGUAGES rows at most

    def make():
        def rows(texts):
            pred, score, mixture = [], [], []
            for t in texts:
                found = sorted(infer(t, shipped.value).items(), key=lambda x: (-x[1], x[0]))
                pred.append(langs[found[0][0]] if found else UNKNOWN)
                score.append(min(1.0, found[0][1]) if found else 0.0)
                mixture.append(",".join(f"{langs[i]}:{x:.3f}" for i, x in found))
            return [pred, score, mixture]

        return rows

    return add_columns(docs, make, [text_col], {"lang_pred": T.StringType(), "score": T.DoubleType(), "mixture": T.StringType()})
