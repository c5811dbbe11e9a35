"""N-gram Jaccard join by grouped prefixes, exact.

A document's set is its distinct 5-word shingles, as 64-bit hashes.  Two
documents link when ``den * intersection >= num * union`` (3/4).  Steps:

1.  Documents with equal sets are one *class*; only classes are compared.
2.  Shingles are ordered by how often they repeat, rare ones first, by the
    counts of the 2^20 most frequent of all documents (any one order gives
    right results).  Two linked sets share l
    shingles among the first ``n - ceil(t * n) + l`` of each, the prefixes,
    or all that they must share, if that is fewer; l is ``SHARED``.
3.  Postings (shingle of a prefix, class) travel packed, by hash buckets: of a
    shingle as many bits as tell the shingles of every set apart and the
    bucket doesn't say, of a class its step from the one before, in a pack
    that is named once for a bucket.  So a posting takes the same bytes
    however many buckets there are.  Those of shingles with a single class
    go; so do classes that are left with fewer postings than any link needs.  Classes of equal size with the
    same remaining prefix are one *group*, and of the lists of groups that
    shingles have, equal ones are one list with a weight.
4.  Group pairs are filtered by size and by the postings that they share,
    then expanded to their classes, which are verified on the whole sets,
    if bitmaps of them (an exact bound) don't rule a pair out before.

Links only have to yield components, so a pair within a component is never
looked at again.  First each group is verified against one hub, the group it
shares most postings with among the first groups of its shingles, and each
class against the first of its group; then each class against a hub in
another component.  What is left on lists with several components is compared
company by company (:mod:`shardsmith.llm.pairs`): by size, by a bitmap of 1024
bits (an exact bound) and a similarity sketch (which loses a link with a
probability of 2e-8), then by the whole sets, in place.  So a group of n near
copies costs 2n verifications, and no candidate pairs of it are ever listed.

Defined cases: a null or empty text, or one without words, has the empty set
(0 shingles) and links with nothing, so it is its own component; fewer than
five words are one shingle; ids may be null: a component's id is its smallest
id that is not null; equal rows are one class; a table without rows gives
none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardsmith.llm.common import ROW_KEY, WordHasher, brief_shuffles, materialize, row_key, shingle_hashes, small_batches, squeezed, unsqueezed
from shardsmith.llm.pairs import company_lists, links, links_in_place
from shardsmith.llm.sketches import BITMAP, bitmap, bitmaps_fit, least_agreement, may_link, prints, sketched

CHUNK = 1 << 22  # shingles whose repeats are counted together
COUNT_BITS, COUNT_BUCKETS = 8, 256
MOST_COUNTED = 1 << 20  # shingles whose counts are shipped to all tasks
SHARED = 8  # shingles that the prefixes of linked sets share at least (or all that they must share, if fewer)
BUCKET_POSTINGS = 400_000  # postings of a bucket, on average
PACKED = 1 << 20  # postings that are packed together
TOKEN_BITS = (48, 56, 64)  # of a shingle's hash that postings have: the fewest of these that tell the shingles of every set apart
KEY_BITS = 1 << 25  # bits of the table by which documents that aren't wanted are told before their texts move


def shingle_set(hasher: WordHasher, text: str | None, size: int) -> np.ndarray:
    s = np.sort(shingle_hashes(hasher(text), size))
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    return s[new]


def set_id(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def set_reader(size: int) -> Callable[[bytes], np.ndarray]:
    """A function that makes the sets of squeezed texts."""
    hasher = WordHasher()
    return lambda text: shingle_set(hasher, unsqueezed(text), size)


def token_bits(s: np.ndarray) -> int:
    """The fewest of ``TOKEN_BITS``, counted from the highest, by which the sorted shingles of a set differ."""
    for bits in TOKEN_BITS:
        cut = s >> np.uint64(64 - bits)
        if (cut[1:] != cut[:-1]).all():
            return bits
    raise ValueError("a set has a shingle twice")


def repeated(chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that ``chunk`` has more than once, in order, and their counts; sorts ``chunk`` in place, so that no
    second one is in memory."""
    chunk.sort()
    at = np.flatnonzero(chunk[1:] == chunk[:-1])
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1] + 1
    starts = np.flatnonzero(new)
    return chunk[at[starts]], np.diff(starts, append=len(at)) + 1


def counts_of(often: tuple[np.ndarray, np.ndarray], s: np.ndarray) -> np.ndarray:
    """The count of each shingle of ``s``; 1 for those that are not among the ``often`` (shingles in order, counts)."""
    tokens, counts = often
    if not len(tokens):
        return np.ones(len(s), np.int64)
    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
    return np.where(tokens[at] == s, counts[at], 1)


def least_overlap(n: int, num: int, den: int) -> int:
    """What a set of ``n`` shares at least with any set it links to."""
    return -(-num * n // den)


def prefix(s: np.ndarray, often: tuple[np.ndarray, np.ndarray], num: int, den: int) -> np.ndarray:
    """The first ``n - least_overlap(n) + SHARED`` shingles, rare ones first, ties by hash."""
    keep = min(len(s), len(s) - least_overlap(len(s), num, den) + SHARED)
    key = (np.minimum(counts_of(often, s), (1 << 24) - 1).astype(np.uint64) << np.uint64(40)) | (s >> np.uint64(24))
    return s[key <= np.partition(key, keep - 1)[keep - 1]]


def _sets(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """One row for each document (``id``, row key, ``n``, ``sid``, ``bits``: its set's ``token_bits``), and packed rows (``bucket``, ``tokens``, ``counts``) of the
    shingles that repeat among the documents of a chunk of about ``CHUNK`` shingles."""
    src = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias(ROW_KEY), F.col(text_col).alias("__text"))
    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, {ROW_KEY} long, n long, sid binary, bits int, bucket int, tokens binary, counts binary"
    names = ["id", ROW_KEY, "n", "sid", "bits", "bucket", "tokens", "counts"]

    def repeats(chunk: np.ndarray, like: pa.DataType) -> pa.RecordBatch:
        t, c = repeated(chunk)
        cuts = np.searchsorted(t, np.arange(1, COUNT_BUCKETS, dtype=np.uint64) << np.uint64(64 - COUNT_BITS))
        k = COUNT_BUCKETS
        packed = [pa.array([x.tobytes() for x in np.split(y, cuts)], pa.binary()) for y in (t, c)]
        return pa.RecordBatch.from_arrays([pa.nulls(k, like), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()), pa.array(range(k), pa.int32()), *packed], names=names)

    def run(batches):
        hasher, chunk, held, like = WordHasher(), np.empty(CHUNK, np.uint64), 0, pa.null()
        for b in batches:
            like = b.column(0).type
            n, sid, bits = [], [], []
            for text in b.column(2).to_pylist():
                s = shingle_set(hasher, text, size)
                n.append(len(s))
                sid.append(set_id(s))
                bits.append(token_bits(s))
                if held + len(s) > len(chunk):
                    yield repeats(chunk[:held], like)
                    held = 0
                    if len(s) > len(chunk):
                        chunk = np.empty(len(s), np.uint64)
                chunk[held : held + len(s)] = s
                held += len(s)
            k = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sid, pa.binary()), pa.array(bits, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())], names=names)
        if held:
            yield repeats(chunk[:held], like)

    return src.mapInArrow(run, schema)


def _often(made: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles with the greatest counts, ``MOST_COUNTED`` at most, in order, and their counts.

    Counts are of what repeats within the chunks of all documents, so they are a bit low.  They only order the shingles.
    """

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["tokens"]])
        c = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["counts"]])
        order = np.argsort(t, kind="stable")
        t, c = t[order], c[order]
        at = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if len(t) else np.empty(0, np.int64)
        total = np.add.reduceat(c, at) if len(at) else c
        level = np.log2(total).astype(np.int64) if len(at) else total
        t = t[at]
        found = np.unique(level)
        picked = [level == k for k in found]
        return pd.DataFrame({"level": found, "n": [int(p.sum()) for p in picked], "tokens": [t[p].tobytes() for p in picked], "counts": [total[p].tobytes() for p in picked]})

    packed = made.filter(F.col("bucket").isNotNull()).select("bucket", "tokens", "counts")
    summed = materialize(packed.groupBy("bucket").applyInPandas(add, "level long, n long, tokens binary, counts binary"), "ngram_counts")
    least, held = 64, 0
    for r in summed.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():  # 64 rows at most
        held += r["n"]
        if held > MOST_COUNTED:
            break
        least = r["level"]
    rows = summed.filter(F.col("level") >= least).select("tokens", "counts").collect()  # MOST_COUNTED shingles at most
    t = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(r["tokens"], np.uint64) for r in rows)])
    c = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(r["counts"], np.int64) for r in rows)])
    order = np.argsort(t)
    return t[order], c[order]


def _key_place(classes: DataFrame) -> tuple[int, int]:
    """Start and width of the bytes of a class' digest that no other class has there: half of it, but for an accident."""
    for start in (0, 8):
        if classes.groupBy(_key(start, 8)).count().filter("count > 1").isEmpty():
            return start, 8
    return 0, 16


def _key(start: int, width: int) -> Column:
    return F.substring("sid", start + 1, width)


def _packed(values: np.ndarray) -> bytes:
    """Values byte by byte, squeezed: their high bytes are zeros or few."""
    return squeezed(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(unsqueezed(packed), np.uint8).reshape(8, -1).T.copy().view(np.uint64).reshape(-1)


def pack_rows(keys: list[bytes], tokens: list[np.ndarray], many: list[np.ndarray], bits: int, buckets: int) -> pa.RecordBatch:
    """A pack: the ``tokens`` of each document by bucket, and its class' key; ``many`` tells those that aren't gathered."""
    token, many = np.concatenate(tokens) >> np.uint64(64 - bits), np.concatenate(many)
    owner = np.repeat(np.arange(len(keys)), [len(t) for t in tokens])
    bucket = np.where(many, buckets + owner % buckets, (token % np.uint64(buckets)).astype(np.int64))
    token = np.where(many, token, token // np.uint64(buckets))
    order = np.argsort(bucket, kind="stable")  # owners stay in order
    groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
    listed = b"".join(keys)
    pack = xxhash.xxh3_64_intdigest(listed)
    k = len(groups)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*(int(bucket[g[0]]) for g in groups), 2 * buckets + pack % buckets], pa.int64()),
            pa.array(np.full(k + 1, pack, np.uint64).view(np.int64), pa.int64()),
            pa.array([*(_packed(token[g]) for g in groups), None], pa.binary()),
            pa.array([*(_packed(np.diff(owner[g], prepend=0)) for g in groups), None], pa.binary()),
            pa.array([*[None] * k, listed], pa.binary()),
        ],
        names=["bucket", "pack", "token", "steps", "classes"],
    )


def _postings(docs: DataFrame, classes: DataFrame, often: tuple[np.ndarray, np.ndarray], place: tuple[int, int], bits: int, buckets: int, common: int, size: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(pack, at, token, class): postings of the prefixes (token: the first ``bits`` of a shingle, of the document ``at`` in ``pack``;
    no class), only of shingles that two documents or more have, and a row for each document looked at (its class; no token).

    One document of each class is looked at, and few others, by a table of the row keys.  A pack has about ``PACKED``
    postings and goes by its classes; a packed row holds those that are in one bucket.  Shingles that may have more than
    ``common`` classes aren't gathered in their bucket: they are passed on as they are, spread by document.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(often)  # MOST_COUNTED shingles at most
    table = docs.sparkSession.sparkContext.broadcast(_key_table(classes, f"rep.{ROW_KEY}"))  # looked up where packs are made: no further worker
    start, width = place

    def pack(batches):
        hasher, often = WordHasher(), shipped.value
        keys, tokens, many, seen, held = [], [], [], set(), 0
        for b in batches:
            for text in b.column(1).filter(pa.array(_passes(table.value, b.column(0).to_numpy()))).to_pylist():
                s = shingle_set(hasher, text, size)
                if len(s):
                    sid = set_id(s)
                    if sid not in seen:
                        seen.add(sid)
                        keys.append(sid[start : start + width])
                        tokens.append(prefix(s, often, num, den))
                        many.append(counts_of(often, tokens[-1]) > common)
                        held += len(tokens[-1])
                if held >= PACKED:
                    yield pack_rows(keys, tokens, many, bits, buckets)
                    keys, tokens, many, seen, held = [], [], [], set(), 0
        if held:
            yield pack_rows(keys, tokens, many, bits, buckets)

    def unpack(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        packs = table.column("pack").to_numpy()
        if bucket >= 2 * buckets:
            found = [np.frombuffer(x, f"V{width}") for x in table.column("classes").to_pylist()]
            each = [len(x) for x in found]
            k = sum(each)
            return pa.table({"pack": np.repeat(packs, each), "at": np.concatenate([np.arange(n) for n in each]), "token": pa.nulls(k, pa.int64()), "class": pa.array([x.tobytes() for y in found for x in y], pa.binary())})
        found = [_unpacked(x) for x in table.column("token").to_pylist()]
        token, which = np.concatenate(found), np.repeat(np.arange(len(found)), [len(x) for x in found])
        at = np.concatenate([np.cumsum(_unpacked(x)) for x in table.column("steps").to_pylist()]).astype(np.int64)
        if bucket < buckets:
            token = token * np.uint64(buckets) + np.uint64(bucket)
            token, which, at = _shared(token, which, at)
        of = packs[which]
        order = np.lexsort((at, of, token))  # a pack may come twice
        token, of, at = token[order], of[order], at[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (of[1:] != of[:-1]) | (at[1:] != at[:-1])
        token, of, at = token[new], of[new], at[new]
        if bucket < buckets:
            token, of, at = _shared(token, of, at)
        return pa.table({"pack": of, "at": at, "token": token.view(np.int64), "class": pa.nulls(len(token), pa.binary())})

    src = docs.filter(F.col(text_col).isNotNull()).select(row_key(id_col, text_col).alias(ROW_KEY), text_col)
    packed = src.mapInArrow(pack, "bucket long, pack long, token binary, steps binary, classes binary")
    return packed.groupBy("bucket").applyInArrow(unpack, "pack long, at long, token long, class binary")


def _shared(token: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """The postings, in order of their tokens, whose token is there more than once."""
    order = np.argsort(token, kind="stable")
    t = token[order]
    same = t[1:] == t[:-1]
    order = order[np.append(same, False) | np.append(False, same)] if len(t) else order
    return [x[order] for x in (token, *others)]


def _by_bitmaps(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) that the classes' bitmaps and sizes don't rule out, so that few whole sets are moved."""
    maps = sets.select("cid", "n", F.substring("prints", 1, BITMAP // 8).alias("map"))
    for end in ("a", "b"):
        pairs = pairs.join(maps.withColumnsRenamed({"cid": end, "n": f"n_{end}", "map": f"map_{end}"}), end)

    def run(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("map_a", "map_b"))
            good = bitmaps_fit(x, y, b.column("n_a").to_numpy(), b.column("n_b").to_numpy(), num, den)
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", "n_a", "n_b", "map_a", "map_b").mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets link; ``pairs`` is a written table."""
    pairs = materialize(_by_bitmaps(pairs.select("a", "b"), sets, num, den), "ngram_near")
    left = sets.select(F.col("cid").alias("a"), F.col("text").alias("__a")).join(pairs, "a")
    wanted = materialize(pairs.select("b").distinct(), "ngram_wanted")  # few beside all classes: most texts need not move
    right = sets.select(F.col("cid").alias("b"), F.col("text").alias("__b")).join(wanted, "b", "left_semi")
    both = left.join(right, "b").select("a", "b", "__a", "__b")

    def run(batches):
        read, last = set_reader(size), {}  # at either end the last class and its set: a hub is in many pairs in a row
        for batch in batches:
            good = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                for end, cid, text in (("a", a, x), ("b", b, y)):
                    if end not in last or last[end][0] != cid:
                        last[end] = cid, read(text)
                good.append(links(last["a"][1], last["b"][1], num, den))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _fits(x: str, y: str, num: int, den: int):
    """Whether sets of sizes ``x`` and ``y`` can be alike enough."""
    return den * F.least(x, y) >= num * F.greatest(x, y)


def _needed(x: str, y: str, num: int, den: int):
    """The postings that linked sets of sizes ``x`` and ``y`` share at least."""
    overlap = F.ceil((F.col(x) + F.col(y)) * num / (num + den))
    return F.least(overlap, F.lit(SHARED))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp), a written table: the smallest node reachable from each node of the edges (a, b).

    Each round sends the smallest neighbour of a node to all its neighbours (large star, then small
    star), written to the shared folder, until all edges lead to the smallest node of their
    component; nothing comes to the driver but whether they do.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") < F.col("u")).alias("lower"), F.count(F.lit(1)).alias("all"))
        near = materialize(near, name)
        if near.filter("lower > 0 and all > 1").isEmpty():  # a further round would change nothing
            return near.select(F.col("u").alias("node"), F.col("m").alias("comp"))
        large = both.filter("v > u").join(near.select("u", "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large, name)  # with repeats, as many rows as edges
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), name)


def merge_components(comp: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``comp`` (node, comp) after further links (a, b): only the components that they join are worked on."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(comp.select(F.col("node").alias(end), F.col("comp").alias(f"__{end}")), end, "left")
    joined = components(ends.select(F.coalesce("__a", "a").alias("a"), F.coalesce("__b", "b").alias("b")), name)
    moved = comp.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("__to")), "comp", "left")
    fresh = joined.join(comp.select("node"), "node", "left_anti").select("node", "comp")
    return materialize(moved.select("node", F.coalesce("__to", "comp").alias("comp")).unionByName(fresh), name)


def jaccard_components(docs: DataFrame, num: int = 3, den: int = 4, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row key, n_shingles, component_id, component_key) for every row.

    ``component_key`` is never null and tells components apart whose ids are all null: the smallest
    digest of the component's sets; that of the empty set goes with the row key.
    """
    with small_batches(docs.sparkSession), brief_shuffles(docs.sparkSession):
        return _jaccard_components(docs, num, den, size, id_col, text_col)


def _jaccard_components(docs: DataFrame, num: int, den: int, size: int, id_col: str, text_col: str) -> DataFrame:
    made = materialize(_sets(docs, size, id_col, text_col), "ngram_sets")
    rows = made.filter(F.col("bucket").isNull()).select("id", ROW_KEY, "n", "sid", "bits")
    often = _often(made)
    classes = rows.filter("n > 0").groupBy("sid").agg(F.min(F.struct("id", ROW_KEY)).alias("rep"), F.min("id").alias("first"), F.first("n").alias("n"))
    classes = materialize(classes, "ngram_classes")
    place = _key_place(classes)
    classes = classes.withColumn("class", _key(*place))
    whole = rows.agg(F.sum(F.col("n") - F.ceil(F.col("n") * num / den) + SHARED).alias("postings"), F.max("bits").alias("bits")).head()
    buckets = max(1, int(whole["postings"] or 0) // BUCKET_POSTINGS)
    common = 1 << 16
    postings = materialize(_postings(docs, classes, often, place, whole["bits"] or 64, buckets, common, size, num, den, id_col, text_col), "ngram_postings")

    # groups: equal size, equal remaining prefix; the smallest class stands for it
    owners = postings.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min(F.struct("pack", "at")).alias("o"))  # documents of a class have the same
    owners = owners.join(classes.select("class", "n"), "class").select("o.pack", "o.at", "class", "n")
    members = postings.filter(F.col("class").isNull()).groupBy("pack", "at").agg(F.sort_array(F.collect_list("token")).alias("tokens")).join(owners, ["pack", "at"])
    members = members.filter(F.size("tokens") >= F.least(F.ceil(F.col("n") * num / den), F.lit(SHARED)))
    members = members.select("class", "n", "tokens", F.xxhash64("n", "tokens").alias("g1"), F.xxhash64(F.lit(1), "tokens", "n").alias("g2"))
    # from here on classes go by numbers, fixed by being written: a third of the bytes of their digests
    members = materialize(members.withColumn("cid", F.monotonically_increasing_id()), "ngram_members")
    groups = members.groupBy("g1", "g2").agg(F.min("cid").alias("gid"))
    groups = materialize(groups, "ngram_groups")
    firsts = members.select(F.col("cid").alias("gid"), "n", "tokens").join(groups.select("gid"), "gid", "left_semi")
    lists = materialize(firsts.select(F.explode("tokens").alias("token"), "gid", "n"), "ngram_lists")
    lists = materialize(_without_repeats(lists), "ngram_lists")
    members = materialize(members.join(groups, ["g1", "g2"]).select("class", "cid", "n", "gid"), "ngram_groups")

    sets = materialize(_candidate_sets(docs, members.select("class", "cid").join(classes, "class").select("sid", "cid", "rep"), size, id_col, text_col), "ngram_candidates")
    # the first group of a list, with its size
    hubs = lists.groupBy("token").agg(F.min(F.struct("gid", "n")).alias("h")).select("token", F.col("h.gid").alias("hub"), F.col("h.n").alias("m"))
    hubs = lists.join(hubs, "token")
    hubs = hubs.filter((F.col("gid") != F.col("hub")) & _fits("n", "m", num, den)).groupBy("gid", "n", "hub", "m").agg(F.sum("weight").alias("shared"))
    hubs = hubs.filter(F.col("shared") >= _needed("n", "m", num, den))
    hubs = hubs.groupBy("gid").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
    tried = members.filter("cid <> gid").select(F.col("cid").alias("a"), F.col("gid").alias("b")).unionByName(hubs.select(F.col("gid").alias("a"), F.col("hub").alias("b")))
    comp = components(_verify(materialize(tried, "ngram_hubs"), sets, size, num, den), "ngram_components")

    apart = materialize(_open_rows(lists, members, comp), "ngram_open")
    found = _verify(materialize(_hub_pairs(apart, num, den), "ngram_pairs"), sets, size, num, den)
    before, comp = comp, merge_components(comp, found, "ngram_components")
    apart = materialize(_still_open(apart, before, comp), "ngram_open")
    left = materialize(company_lists(_companies(apart), comp), "ngram_left")
    near = partial(may_link, least=least_agreement(num, den), num=num, den=den)
    found = links_in_place(left, sets.select("cid", F.col("text").alias("shingles"), "prints"), near, num, den, "ngram_partners", partial(set_reader, size))
    comp = merge_components(comp, materialize(found, "ngram_pairs"), "ngram_components")

    numbered = members.select("class", "cid").join(comp.select(F.col("node").alias("cid"), "comp"), "cid").select("class", "comp")
    named = classes.select("sid", "class", "first").join(numbered, "class", "left")
    least = named.filter(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("first").alias("least"), F.min("sid").alias("key"))
    named = named.join(least, "comp", "left").select("sid", F.when(F.col("comp").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"), F.coalesce("key", "sid").alias("component_key"))
    out = rows.filter("n > 0").join(named, "sid").select("id", ROW_KEY, "n", "component_id", "component_key")
    none = rows.filter("n = 0").select("id", ROW_KEY, "n", F.col("id").alias("component_id"), F.concat("sid", F.encode(F.col(ROW_KEY).cast("string"), "utf-8")).alias("component_key"))
    return out.unionByName(none).select(F.col("id").alias(id_col), ROW_KEY, F.col("n").alias("n_shingles"), "component_id", "component_key")


def _candidate_sets(docs: DataFrame, reps: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(cid, n, text: squeezed, prints: bitmap and sketch) of the classes in ``reps``, from one document of each.

    Texts are kept and moved on, squeezed, not sets: they have about a third of the bytes, and sets are soon made of them.
    """
    want = materialize(reps.select("sid", "cid", F.col(f"rep.{ROW_KEY}").alias("__key")), "ngram_reps")
    src = docs.select(row_key(id_col, text_col).alias(ROW_KEY), F.col(text_col).alias("__text"))
    src = src.filter(_may_be_among(want, "__key")(ROW_KEY))  # few beside all documents: most texts need not move
    # joined and reduced by the row key alone, so that the texts move once; a text of another set is told by its set
    found = src.join(want, F.col(ROW_KEY) == F.col("__key")).select("sid", "cid", "__key", "__text")
    found = found.withColumn("__hash", F.xxhash64("__text")).dropDuplicates(["__key", "sid", "__hash"]).select("sid", "cid", "__text")

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            texts = b.column(2).to_pylist()
            made = [shingle_set(hasher, t, size) for t in texts]
            same = [set_id(s) == sid for s, sid in zip(made, b.column(0).to_pylist())]
            maps = [bitmap(s) + p.tobytes() for s, p in zip(made, prints(sketched(made)))]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([len(s) for s in made], pa.int64()), pa.array([squeezed((t or "").encode()) for t in texts], pa.binary()), pa.array(maps, pa.binary())], names=["cid", "n", "text", "prints"]).filter(pa.array(same, pa.bool_()))

    return found.mapInArrow(run, "cid long, n long, text binary, prints binary")


def _key_table(keys: DataFrame, col: str) -> np.ndarray:
    """A table of ``KEY_BITS`` bits, however many keys there are: those that the keys (64-bit hashes) have are set."""
    bit = F.pmod(col, F.lit(KEY_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    found = keys.groupBy(F.floor(bit / 64).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()  # KEY_BITS / 64 rows at most
    table = np.zeros(KEY_BITS // 64, np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return table


def _passes(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key % (64 * len(table))
    return (table[at // 64] >> (at % 64)) & 1 == 1


def _may_be_among(keys: DataFrame, col: str) -> Callable:
    """A filter for a column of 64-bit hashes that passes all that are among ``keys`` and few others."""
    shipped = keys.sparkSession.sparkContext.broadcast(_key_table(keys, col))

    @F.pandas_udf("boolean")
    def among(key: pd.Series) -> pd.Series:
        return pd.Series(_passes(shipped.value, key.to_numpy()))

    return among


def _without_repeats(lists: DataFrame) -> DataFrame:
    """(token, gid, n, weight): one of the lists (token, gid, n) that have the same groups, and how many they are.

    Near copies share runs of shingles, so most lists are repeats.  Lists are told apart by their length and 128 bits of
    the hashes of their groups, which are distinct on a list.
    """
    lists = lists.filter(F.col("token").isNotNull()).repartition("token")  # by which they are marked and taken: they move once
    mark = [F.bit_xor(F.xxhash64(F.lit(i), "gid", "n")).alias(f"x{i}") for i in (1, 2)]
    marked = lists.groupBy("token").agg(F.count(F.lit(1)).alias("k"), *mark)
    kept = marked.groupBy("k", "x1", "x2").agg(F.min("token").alias("token"), F.count(F.lit(1)).alias("weight"))
    return lists.join(kept.select("token", "weight"), "token")


def _open_rows(lists: DataFrame, members: DataFrame, comp: DataFrame) -> DataFrame:
    """(token, cid, n, comp, weight, low): the lists, by class, of shingles that join components; ``low``: the first component.

    Lists are looked at by group first, with the first and the last component of its classes, so
    that only those that join components are written out by class.
    """
    label = members.join(comp.select(F.col("node").alias("cid"), "comp"), "cid", "left").select("gid", "cid", "n", F.coalesce("comp", "cid").alias("comp"))
    label = materialize(label, "ngram_labels")
    span = label.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    mixed = lists.select("token", "gid").join(span, "gid").groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    mixed = materialize(mixed.filter("low <> high").select("token", "low"), "ngram_mixed")
    return lists.select("token", "gid", "weight").join(mixed, "token").join(label, "gid").select("token", "cid", "n", "comp", "weight", "low")


def _still_open(rows: DataFrame, before: DataFrame, comp: DataFrame) -> DataFrame:
    """Those of the open rows whose lists still join components: only the lists that a merger is on are looked at."""
    was = before.select("node", F.col("comp").alias("__was"))
    merged = comp.join(was, "node", "left").select(F.coalesce("__was", "node").alias("comp"), F.col("comp").alias("__to"))
    merged = materialize(merged.filter("comp <> __to").distinct(), "ngram_merged")
    touched = materialize(rows.join(merged, "comp", "left_semi").select("token").distinct(), "ngram_touched")
    now = rows.join(touched, "token", "left_semi").join(merged, "comp", "left").select("token", F.coalesce("__to", "comp").alias("comp"))
    one = now.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low = high").select("token")
    return rows.join(materialize(one, "ngram_settled"), "token", "left_anti")


def _hub_pairs(rows: DataFrame, num: int, den: int) -> DataFrame:
    """For each class the first class of another component that it shares most postings with."""
    first = rows.filter("comp = low").groupBy("token").agg(F.min(F.struct("cid", "n")).alias("h")).select("token", F.col("h.cid").alias("hub"), F.col("h.n").alias("m"))
    pairs = rows.filter("comp <> low").join(first, "token").filter(_fits("n", "m", num, den))
    pairs = pairs.groupBy("cid", "n", "hub", "m").agg(F.sum("weight").alias("shared")).filter(F.col("shared") >= _needed("n", "m", num, den))
    return pairs.groupBy("cid").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub")).select(F.col("cid").alias("a"), F.col("hub").alias("b"))


def _companies(rows: DataFrame) -> DataFrame:
    """(hub, cid, n): the classes of all lists that have the same hub, the class with the most postings on a list.

    Classes that share a shingle share its hub, and the lists of near copies mostly have one, so that a class is in few
    companies where it is on many lists.
    """
    popular = rows.groupBy("cid").agg(F.sum("weight").alias("pop"))
    hubs = rows.select("token", "cid").join(popular, "cid").groupBy("token").agg(F.max(F.struct("pop", "cid"))["cid"].alias("hub"))
    return rows.select("token", "cid", "n").join(hubs, "token").select("hub", "cid", "n").distinct()
