"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set is its distinct 2-word shingles, as 64-bit hashes.  Two
documents link when ``den * intersection >= num * union`` (4/5).  Steps:

1.  Documents with equal sets are one *class*; only classes are compared.
2.  Each set gets a sketch of ``COORDS`` coordinates by fast similarity
    sketching: in round i every shingle is thrown into a bin by that round's
    hash, with value i plus a fraction, and a coordinate keeps its least
    value.  Rounds go on until every coordinate is filled, after the
    ``COORDS``-th round each fills one named coordinate, so all are filled
    after twice as many at the latest, whatever the set's size.  Two sketches
    agree in a coordinate with the probability of the sets' similarity, and
    the share of coordinates that agree is concentrated as for fully random
    samples, while large sets need one or two rounds only.
3.  ``ROWS`` coordinates are a band.  A link shares a band of all 42 but with
    probability (1 - 0.8^5)^42 = 6e-8 at the threshold, less above it.
4.  Classes that share a band with none go.  The others are verified on their
    whole sets: first each against one hub, the class of its bands that has
    the most company (of near copies, that is the text they were made from);
    then against all hubs of its bands that are in another component; then
    what is left, the classes that share a hub but no component, list by list.
    There bitmaps of 1024 bits (an exact bound) and sketches are compared in
    place, the whole sets of pairs that agree in at least as many coordinates
    as a link does but with probability 2e-8 are compared in place as well,
    and only links come out.

Links only have to yield components, so a pair within one is never looked at
again: n copies of a text cost 2n verifications, and no pairs are ever listed.
The company of a hub is cut into blocks, those of its main component against
the rest, and each pair of blocks is a list of its own, so no list is gathered
whole and none is capped.

Defined cases: a null or empty text, or one without words, has the empty set
(0 shingles) and links with nothing, so it is its own component; one word is
one shingle; ids may be null: a component's id is its smallest id that is not
null, and ``kept`` holds for each row whose id is that one (if all are null,
for all); equal rows are one class; texts are taken whole; a table without
rows gives none; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardsmith.llm.common import ROW_KEY, WordHasher, materialize, row_key, scramble
from shardsmith.llm.ngram_join import components, merge_components, set_id, shingle_set
from shardsmith.llm.pairs import company_lists, links, links_in_place
from shardsmith.llm.sketches import COORDS, bitmap, least_agreement, may_link, prints, sketched

SIZE = 2  # words of a shingle
ROWS = 5
BANDS = COORDS // ROWS
PLACES = scramble(np.arange(31, 31 + ROWS, dtype=np.uint64)) | np.uint64(1)


def bands(sketches: np.ndarray) -> np.ndarray:
    """A key for each band, different ones for different bands."""
    keys = (sketches.reshape(-1, BANDS, ROWS) * PLACES).sum(axis=2, dtype=np.uint64)
    return scramble(keys + np.arange(1, BANDS + 1, dtype=np.uint64))


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row key, n, sid, bands) of every document."""
    src = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias(ROW_KEY), F.col(text_col).alias("__text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            sets = [shingle_set(hasher, t, SIZE) for t in b.column(2).to_pylist()]
            keys = bands(sketched(sets)).reshape(-1).view(np.int64)
            ends = np.arange(len(sets) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))],
                names=["id", ROW_KEY, "n", "sid", "bands"],
            )

    return src.mapInArrow(run, f"id {kind}, {ROW_KEY} long, n long, sid binary, bands array<bigint>")


def _class_sets(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, shingles, prints: bitmap and sketch) of the classes in ``reps`` (cid, sid, row key), from the text of one document of each."""
    src = docs.select(row_key(id_col, text_col).alias(ROW_KEY), F.col(text_col).alias("__text")).filter(F.col("__text").isNotNull())
    found = src.join(reps, ROW_KEY).select("cid", "sid", ROW_KEY, "__text")
    # equal rows share a key: one is enough, and a text of another set is told by its set
    found = found.withColumn("__hash", F.xxhash64("__text")).dropDuplicates([ROW_KEY, "sid", "__hash"]).select("cid", "sid", "__text")

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            sets = [shingle_set(hasher, t, SIZE) for t in b.column(2).to_pylist()]
            same = [set_id(s) == sid for s, sid in zip(sets, b.column(1).to_pylist())]
            made = [bitmap(s) + p.tobytes() for s, p in zip(sets, prints(sketched(sets)))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(made, pa.binary())], names=["cid", "shingles", "prints"]
            ).filter(pa.array(same, pa.bool_()))

    return found.mapInArrow(run, "cid long, shingles binary, prints binary")


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b), a written table, whose whole sets link."""
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "similar_wanted")
    few = sets.select("cid", "shingles").join(wanted, "cid", "left_semi")  # most sets need not move twice
    left = few.select(F.col("cid").alias("a"), F.col("shingles").alias("__a"))
    right = few.select(F.col("cid").alias("b"), F.col("shingles").alias("__b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "__a", "__b")

    def run(batches):
        for batch in batches:
            sides = zip(batch.column(2), batch.column(3))
            good = [links(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), num, den) for x, y in sides]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _fits(x: str, y: str, num: int, den: int) -> Column:
    """Whether sets of sizes ``x`` and ``y`` can be alike enough."""
    return den * F.least(x, y) >= num * F.greatest(x, y)


def _with_components(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows (cid, hub) with the component of each."""
    label = lambda c, to: comp.select(F.col("node").alias(c), F.col("comp").alias(to))
    rows = rows.join(label("cid", "__comp"), "cid", "left").join(label("hub", "__of"), "hub", "left")
    return rows.withColumns({"comp": F.coalesce("__comp", "cid"), "of": F.coalesce("__of", "hub")}).drop("__comp", "__of")


def _last_links(lists: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    near = partial(may_link, least=least_agreement(num, den), num=num, den=den)
    return links_in_place(lists, sets, near, num, den)


def near_duplicates(docs: DataFrame, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row key, n_shingles, component_id, kept) for every row."""
    made = materialize(_signed(docs, id_col, text_col), "similar_signed")
    classes = made.filter("n > 0").groupBy("sid").agg(F.min(F.struct("id", ROW_KEY)).alias("rep"), F.min("id").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "similar_classes")

    postings = classes.select("cid", "n", F.explode("bands").alias("key"))
    company = postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = materialize(postings.join(company, "key"), "similar_shared")
    popular = shared.groupBy("cid").agg(F.sum("size").alias("pop"))
    hubs = shared.join(popular, "cid").groupBy("key").agg(F.max(F.struct("pop", "cid", "n")).alias("h"))
    shared = materialize(shared.join(hubs.select("key", F.col("h.cid").alias("hub"), F.col("h.n").alias("m")), "key"), "similar_hubs")
    reps = classes.join(popular.select("cid"), "cid").select("cid", "sid", F.col(f"rep.{ROW_KEY}").alias(ROW_KEY))
    sets = materialize(_class_sets(docs, reps, id_col, text_col), "similar_sets")

    tried = shared.filter((F.col("cid") != F.col("hub")) & _fits("n", "m", num, den)).select(F.col("cid").alias("a"), "hub")
    tried = tried.repartition("a").groupBy("a", "hub").agg(F.count(F.lit(1)).alias("common"))  # BANDS rows of a class at most
    tried = tried.groupBy("a").agg(F.max(F.struct("common", "hub"))["hub"].alias("b"), F.collect_list("hub").alias("hubs"))
    tried = materialize(tried, "similar_tried")
    comp = components(_verify(tried.select("a", "b"), sets, num, den), "similar_components")

    others = tried.select(F.col("a").alias("cid"), "b", F.explode("hubs").alias("hub")).filter("hub <> b").drop("b")
    apart = _with_components(others, comp).filter(F.col("comp") != F.col("of"))
    further = _verify(materialize(apart.select(F.col("cid").alias("a"), F.col("hub").alias("b")), "similar_pairs"), sets, num, den)
    comp = merge_components(comp, further, "similar_components")

    companies = shared.groupBy("hub", "cid").agg(F.first("n").alias("n"))
    lists = materialize(company_lists(companies, comp), "similar_lists")
    comp = merge_components(comp, materialize(_last_links(lists, sets, num, den), "similar_pairs"), "similar_components")

    named = classes.select("sid", "cid", "first").join(comp.select(F.col("node").alias("cid"), "comp"), "cid", "left")
    least = named.filter(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("first").alias("least"))
    named = named.join(least, "comp", "left").select("sid", F.when(F.col("comp").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    rows = made.select("id", ROW_KEY, "n", "sid")
    out = rows.filter("n > 0").join(named, "sid").select("id", ROW_KEY, "n", "component_id")
    out = out.unionByName(rows.filter("n = 0").select("id", ROW_KEY, "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), ROW_KEY, F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
