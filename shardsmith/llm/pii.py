"""Personal data by bootstrapped contextual extraction.

Base kinds come from patterns with checks (e-mail, ip, card, phone); their
matches are the seeds.  The one and two words before an identifier are its
lexical patterns.  Candidates are words with a digit outside the base spans.
Spark scores the graph of patterns and instances in rounds: a pattern's
confidence is the score of the instances after it, over how often its words
occur in the whole corpus, whatever follows; an instance's score is one minus
the product of its patterns' doubts (noisy or).  Only patterns with
``support`` distinct instances and ``confidence`` or more vote.  Candidates
that reach ``accept`` are added as spans of kind ``id``, wherever they occur.

Defined cases: null and empty texts have no spans; null ids are allowed;
equal rows are one document here, so they get the same spans and count once;
a text of any length is read whole, in linear time; input columns other than
the id and the text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.llm.common import ROW_KEY, WordHasher, add_columns, join_rows, materialize, row_key, scramble, words

KINDS = ("email", "ip", "card", "phone")  # in the order in which spans of one start are listed
ADDED = "id"
PATTERN_BLOCK = 200_000  # patterns counted in one pass over the texts

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?()[]{}<>\"'"


def emails(text: str):
    """Leftmost matches; each is found from its ``@``, so that long words cost no more than their length."""
    done = 0
    p = text.find("@")
    while p >= 0:
        s = p
        while s > done and text[s - 1] in LOCAL:
            s -= 1
        m = DOMAIN.match(text, p + 1) if s < p else None
        if m:
            yield s, m.end()
            done = m.end()
        p = text.find("@", max(p + 1, done))


def ips(text: str):
    """Four parts at a time of each run of dotted numbers; a part over 255 spoils its match."""
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        s = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            e = s + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                yield s, e
            s = e + 1


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def cards(text: str):
    for m in DIGITS.finditer(text):
        d = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(d) <= 19 and luhn(d):
            yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m.group())) <= 15:
            yield m.span()


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind; code points, end exclusive."""
    found = []
    if text:
        if "@" in text:
            found += [(s, e, 0) for s, e in emails(text)]
        if DIGIT.search(text):
            found += [(s, e, 1) for s, e in ips(text)] + [(s, e, 2) for s, e in cards(text)]
            if "+" in text:
                found += [(s, e, 3) for s, e in phones(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


def _hashes(one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pattern hashes at each word: of that word, and of it with the word before (from the second on)."""
    return scramble(one), scramble(scramble(one[:-1] + np.uint64(2)) + one[1:])


def candidates(text: str, spans: list[tuple[int, int, str]], hasher: WordHasher, least: int = 5) -> list[tuple]:
    """(start, end, instance, is seed, pattern of one word, pattern of two) for seeds and for words with a digit.

    Patterns are null where the text has no such words before.
    """
    if not spans and not DIGIT.search(text):
        return []
    at = [m.span() for m in WORD.finditer(text)]
    starts = np.array([s for s, _ in at])
    ws = words(text)
    picked = []
    taken = np.zeros(len(at) + 1, bool)
    for s, e, _ in spans:
        i, j = int(np.searchsorted(starts, s, "right")) - 1, int(np.searchsorted(starts, e, "left"))
        taken[i:j] = True
        picked.append((s, e, i, True))
    for i, (s, e) in enumerate(at):
        if not taken[i] and DIGIT.search(ws[i].decode("utf-8", "replace")):
            word = text[s:e]
            s += len(word) - len(word.lstrip(EDGES))
            e -= len(word) - len(word.rstrip(EDGES))
            if e - s >= least:
                picked.append((s, e, i, False))
    out = []
    for s, e, i, seed in picked:
        one, two = _hashes(hasher(b" ".join(ws[max(0, i - 2) : i]))) if i else ((), ())
        out.append((s, e, text[s:e].lower(), seed, int(one[-1:].view(np.int64)[0]) if i else None, int(two[-1:].view(np.int64)[0]) if i > 1 else None))
    return out


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))
CANDIDATE = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("instance", T.StringType()), T.StructField("seed", T.BooleanType()), T.StructField("one", T.LongType()), T.StructField("two", T.LongType())])
)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row key, spans, candidates) for every row; no text."""

    def make():
        hasher = WordHasher()

        def rows(texts):
            spans = [base_spans(t) for t in texts]
            cands = [candidates(t, s, hasher) if t else [] for t, s in zip(texts, spans)]
            names = ("start", "end", "instance", "seed", "one", "two")
            return [[[dict(zip(("start", "end", "kind"), s)) for s in x] for x in spans], [[dict(zip(names, c)) for c in x] for x in cands]]

        return rows

    src = docs.select(id_col, row_key(id_col, text_col).alias(ROW_KEY), F.col(text_col).alias("__text"))
    return add_columns(src, make, ["__text"], {"spans": SPAN, "candidates": CANDIDATE}).drop("__text")


def count_patterns(docs: DataFrame, patterns: list[int], text_col: str = "text") -> DataFrame:
    """(pattern, occurrences): how often the words of each pattern occur in all texts with something after them."""
    wanted = np.sort(np.array(patterns, np.int64).view(np.uint64))
    shipped = docs.sparkSession.sparkContext.broadcast(wanted)  # PATTERN_BLOCK longs at most

    def run(batches):
        wanted, hasher = shipped.value, WordHasher()
        total = np.zeros(len(wanted), np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                one = hasher(text)[:-1]  # something follows
                if len(one):
                    for h in _hashes(one):
                        at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                        total += np.bincount(at[wanted[at] == h], minlength=len(wanted))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[hit].view(np.int64)), pa.array(total[hit])], names=["pattern", "n"])

    parts = docs.select(text_col).filter(F.col(text_col).isNotNull()).mapInArrow(run, "pattern long, n long")
    return parts.groupBy("pattern").agg(F.sum("n").alias("occurrences"))


def _blocks(patterns: DataFrame):
    """The patterns, a bounded block at a time."""
    block: list[int] = []
    for r in patterns.toLocalIterator():
        block.append(r["pattern"])
        if len(block) == PATTERN_BLOCK:
            yield block
            block = []
    if block:
        yield block


def bootstrap(docs: DataFrame, found: DataFrame, support: int = 5, confidence: float = 0.5, accept: float = 0.8, rounds: int = 3, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence) of the patterns that vote, and (instance, score) of the candidates accepted."""
    spark = docs.sparkSession
    cands = found.select(F.explode("candidates").alias("c")).select("c.*")
    edges = cands.select(F.explode(F.array("one", "two")).alias("pattern"), "instance", F.col("seed").cast("int").alias("seed")).filter(F.col("pattern").isNotNull())
    edges = edges.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    enough = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("distinct")).filter(F.col("distinct") >= support).select("pattern")
    edges = materialize(edges.join(enough, "pattern"), "pii_edges")
    counted = None
    for block in _blocks(edges.select("pattern").distinct()):
        one = count_patterns(docs, block, text_col)
        counted = one if counted is None else counted.unionByName(one)
    if counted is None:
        counted = spark.createDataFrame([], "pattern long, occurrences long")
    edges = materialize(edges.join(counted, "pattern"), "pii_graph")
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    for _ in range(rounds):
        known = edges.join(scores, "instance")
        patterns = (
            known.groupBy("pattern")
            .agg((F.sum(F.col("n") * F.col("score")) / F.max(F.greatest("occurrences", F.lit(1)))).alias("confidence"), F.sum(F.when(F.col("score") >= accept, 1).otherwise(0)).alias("good"))
            .select("pattern", F.least("confidence", F.lit(1.0)).alias("confidence"), "good")
            .filter((F.col("confidence") >= confidence) & (F.col("good") >= support))
        )
        patterns = materialize(patterns.select("pattern", "confidence"), "pii_patterns")
        # greatest() passes nulls over: an instance of no voting pattern must have no doubt taken away
        doubt = F.when(F.col("confidence").isNull(), 0.0).otherwise(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))
        scores = edges.join(patterns, "pattern", "left").groupBy("instance").agg(F.when(F.max("seed") == 1, F.lit(1.0)).otherwise(1 - F.exp(F.sum(doubt))).alias("score"))
        scores = materialize(scores, "pii_scores")
    return patterns, scores.filter(F.col("score") >= accept)


def personal_data(docs: DataFrame, support: int = 5, confidence: float = 0.5, accept: float = 0.8, rounds: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans, added): all spans with their kinds, and the number that the method added, for every row."""
    found = materialize(find(docs, id_col, text_col), "pii_spans")
    _, accepted = bootstrap(docs, found, support, confidence, accept, rounds, text_col)
    more = found.select(id_col, ROW_KEY, F.explode("candidates").alias("c")).filter(~F.col("c.seed")).join(accepted.select(F.col("instance").alias("__instance")), F.col("c.instance") == F.col("__instance"), "left_semi")
    more = more.groupBy(id_col, ROW_KEY).agg(F.collect_set(F.struct(F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.lit(ADDED).alias("kind"))).alias("__more"))
    out = join_rows(found, more, id_col).select(id_col, "spans", F.coalesce("__more", F.array().cast(SPAN)).alias("__more"))
    rank = F.create_map(*(x for i, k in enumerate((*KINDS, ADDED)) for x in (F.lit(k), F.lit(i))))
    keyed = F.array_sort(F.transform(F.concat("spans", "__more"), lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"])))
    return out.select(id_col, F.transform(keyed, lambda s: F.struct(s["start"], s["end"], s["kind"])).alias("all_spans"), "spans", F.size("__more").cast("long").alias("n_added"))
