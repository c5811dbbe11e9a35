"""The corpus queries, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsmith.llm import decontaminate, language, line_dedup, merkle, mixing, ngram_join, periodic, pii, quality, revisits, secrets, similarity, substring_dedup
from shardsmith.llm.common import materialize

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text", *cols)


@query
def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf)).select("doc_id", "n_shingles", "component_id")


ORACLES["op1_ngram_join"] = """
WITH RECURSIVE ws AS (
  SELECT doc_id, list_filter_words AS w FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS list_filter_words FROM documents)),
spots AS (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) AS i FROM ws),
shingles AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i + 1 : i + 5], ' ')) AS s FROM spots),
size AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
          FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN edges e ON e.a = reach.r)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, min(r) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN size USING (doc_id) GROUP BY d.doc_id
"""


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Archive records from ``pages``: each page is captured (at ten seconds times its id), then revisited twice.

    Every seventh first revisit shows another ETag, every eleventh second one asks for a URL never captured.
    """
    pages = table(spark, sf, "pages")
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    i, no = F.col("page_id"), F.lit(None).cast("string")
    row = lambda k, kind, url, time, status, headers, payload: F.struct((i * 3 + k).alias("record_id"), F.lit(kind).alias("record_type"), url.alias("url"), time.alias("time"), F.lit(status).alias("status"), headers.alias("headers"), payload.alias("payload"))
    sent = lambda etag, age, length, kind: F.create_map(F.lit("ETag"), etag, F.lit("Cache-Control"), F.lit(age), F.lit("Content-Length"), length, F.lit("Content-Type"), F.lit(kind))
    first = row(0, "response", F.col("url"), i * 10, 200, sent(tag, "max-age=60", F.length("html").cast("string"), "text/html"), F.col("html"))
    second = row(1, "revisit", F.concat("url", F.lit("#seen")), i * 10 + 4, 304, sent(F.when(i % 7 == 3, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag)), "max-age=120", F.lit("0"), "text/plain"), no)
    third = row(2, "revisit", F.when(i % 11 == 0, F.concat("url", F.lit("x"))).otherwise(F.col("url")), i * 10 + 90_000, 304, sent(tag, "no-cache", F.lit("0"), "text/plain"), no)
    return pages.select(F.explode(F.array(first, second, third)).alias("r")).select("r.*")


@query
def op2_revisits(spark: SparkSession, sf: str) -> DataFrame:
    """For each record what it resolves to, its headers and the digest of its payload."""
    out = revisits.resolve_revisits(_records(spark, sf))
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")
    return out.select("record_id", "record_type", "outcome", "refers_to", headers.alias("headers"), F.sha2(F.col("payload"), 256).alias("payload_sha256"))


ORACLES["op2_revisits"] = """
WITH pages2 AS (SELECT page_id AS i, url, html, '"' || md5(html) || '"' AS tag FROM pages),
records AS (
  SELECT i * 3 AS record_id, 'response' AS record_type, url, i * 10 AS time, tag AS etag, 'max-age=60' AS age,
         length(html)::VARCHAR AS len, 'text/html' AS kind, html AS payload FROM pages2
  UNION ALL
  SELECT i * 3 + 1, 'revisit', url || '#seen', i * 10 + 4, CASE WHEN i % 7 = 3 THEN '"other"' ELSE 'W/' || tag END,
         'max-age=120', '0', 'text/plain', NULL FROM pages2
  UNION ALL
  SELECT i * 3 + 2, 'revisit', CASE WHEN i % 11 = 0 THEN url || 'x' ELSE url END, i * 10 + 90000, tag,
         'no-cache', '0', 'text/plain', NULL FROM pages2),
parts AS (
  SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM records),
canon AS (
  SELECT *, regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www[.]|:(80|443)$', '')
    || regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN q = '' THEN '' ELSE '?' || q END AS c
  FROM (SELECT *, coalesce(array_to_string(list_sort([p FOR p IN string_split(regexp_extract(u, '[?](.*)$', 1), '&')
          IF p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|gclid|fbclid)(=|$)')]), '&'), '') AS q FROM parts)),
found AS (
  SELECT v.record_id, max({'t': r.time, 'id': r.record_id}) AS hit
  FROM canon v JOIN canon r ON r.c = v.c AND r.record_type = 'response' AND r.time < v.time
  WHERE v.record_type = 'revisit' GROUP BY v.record_id),
joined AS (
  SELECT v.*, r.record_id AS source, r.etag AS old_tag, r.len AS old_len, r.kind AS old_kind, r.payload AS old_payload
  FROM records v LEFT JOIN found f USING (record_id) LEFT JOIN records r ON r.record_id = f.hit.id),
judged AS (
  SELECT *, CASE WHEN record_type = 'response' THEN 'response' WHEN source IS NULL THEN 'no_response'
    WHEN regexp_replace(old_tag, '^W/', '') = regexp_replace(etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM joined)
SELECT record_id, record_type, outcome, CASE WHEN outcome = 'resolved' THEN source END AS refers_to,
  'cache-control: ' || age || '; content-length: ' || CASE WHEN outcome = 'resolved' THEN old_len ELSE len END
    || '; content-type: ' || CASE WHEN outcome = 'resolved' THEN old_kind ELSE kind END || '; etag: ' || etag AS headers,
  sha256(CASE WHEN outcome = 'resolved' THEN old_payload ELSE payload END) AS payload_sha256
FROM judged
"""


@query
def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each document and benchmark item found in it."""
    out = decontaminate.contamination(documents(spark, sf), table(spark, sf, "benchmark"))
    return out.select("doc_id", F.explode("contamination").alias("c")).select("doc_id", F.col("c.item").alias("item_id"), "c.similarity", "c.start_word", "c.n_words")


@query
def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, bytes, repeated and dropped bytes, digest of what is kept, and the spans."""
    out = substring_dedup.drop_repeats(documents(spark, sf))
    spans = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return out.select("doc_id", "n_bytes", "n_repeated", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), F.coalesce(spans("stretches"), F.lit("")).alias("repeated"), F.coalesce(spans("dropped"), F.lit("")).alias("dropped"))


@query
def op5_tokenizer_fertility(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "lang").select("doc_id", "lang", "text")
    measured = materialize(quality.measure(docs).drop("text"), "quality")
    out = quality.judge(measured, quality.fit_bands(measured))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by", "n_tokens", "chars_per_token", "fallback_share", "token_entropy")


@query
def op6_secret_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Every candidate with the forest's score; labels come from published formats."""
    docs = documents(spark, sf, "source")
    found = materialize(secrets.with_features(secrets.findings(docs), secrets.dictionary(docs)), "secret_features")
    model = secrets.train(secrets.label_by_format(found))
    out = secrets.score(found, model)
    return out.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), "path", "n", "transitions", "coverage", "announced", F.round("score", 6).alias("score"), "is_secret")


@query
def op7_language_mixture(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "lang").withColumn("held_out", language.held_out("doc_id"))
    langs, model = language.train(docs.filter(~F.col("held_out")))
    return language.predict(docs.drop("lang"), langs, model).select("doc_id", "held_out", "lang_pred", "score", "mixture")


@query
def op8_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    out = pii.personal_data(documents(spark, sf))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *map(count, pii.KINDS), F.sha2(listed("spans"), 256).alias("base_sha256"), listed("all_spans").alias("spans"), "n_added")


@query
def op9_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Each use of a document: how long it is, the pass, the block and the place in the mixed order."""
    return mixing.mix_sources(documents(spark, sf, "source")).select("doc_id", "source", "n_tokens", "pass", "block", "mix_pos")


@query
def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = line_dedup.drop_lines(documents(spark, sf))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op10_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
hot AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN hot USING (key) GROUP BY doc_id
"""


def _with_periods(docs: DataFrame) -> DataFrame:
    """``documents`` with a periodic end planted in every document whose crc32 ends in the digit 0."""
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.withColumns({"__h": h, "__w": F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))})
    n, g = F.size("__w"), F.floor(F.col("__h") / 10)
    docs = docs.withColumns({"__n": n, "__a": F.when(n > 0, g % n).cast("int")})
    docs = docs.withColumn("__p", (1 + F.floor((F.col("__n") - F.col("__a")) / (3 + g % 8))).cast("int"))
    rest = F.col("__n") - F.col("__a")
    unit = F.slice("__w", F.col("__a") + 1, F.least("__p", rest))
    ends = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("__p")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("__w", F.lit(1), F.col("__a")), ends), " ")
    return docs.select("doc_id", F.when(F.col("__n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The runs of every document, some of which get a periodic end first; the longest one, and digests of all
    and of the text that is left."""
    out = periodic.collapse_runs(_with_periods(documents(spark, sf)))
    longest = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] > a["length"], r).otherwise(a))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = out.withColumns({"__first": longest, "__listed": listed})
    r = F.col("__first")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"), F.floor(1000 * r["length"] / r["period"]).alias("exponent_milli"), F.sha2("__listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


# crc32 of the decimal doc_id: each digit goes into the low bits, then eight shifts
CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
    FOR x IN string_split(doc_id::VARCHAR, '')])), lambda acc, e:
    CASE WHEN e >= 0 THEN xor(acc, e) WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END))"""

ORACLES["op11_periodic_runs"] = f"""
WITH cut AS (
  SELECT *, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM (
    SELECT doc_id, {CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)),
spots AS (
  SELECT doc_id, i, n, w[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END + 1] AS word
  FROM (SELECT *, len(w) AS n, unnest(range(len(w))) AS i FROM cut)),
sixes AS (
  SELECT doc_id, i, n, hash(array_to_string(v[i + 1 : i + 6], ' ')) AS six FROM (
    SELECT doc_id, max(n) AS n, list(word ORDER BY i) AS v, unnest(range(max(n) - 5)) AS i FROM spots GROUP BY doc_id)),
hits AS (
  SELECT b.doc_id, b.i - a.i AS lag, b.i FROM sixes a JOIN sixes b ON a.doc_id = b.doc_id AND a.six = b.six AND a.i < b.i
  WHERE 2 * (b.i - a.i) <= b.n),
islands AS (
  SELECT doc_id, lag, min(i) - lag AS start, count(*) + 5 + lag AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM hits)
  GROUP BY doc_id, lag, island),
runs AS (
  SELECT doc_id, start, length, min(lag) AS period FROM islands WHERE length >= greatest(12, 2 * lag) GROUP BY doc_id, start, length),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM spots s
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = s.doc_id AND s.i >= r.start + r.period AND s.i < r.start + r.length)
  GROUP BY doc_id)
SELECT c.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256, len(w) AS n_words
FROM cut c LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's leaf, roots and proof; some are then checked with the line breaks of their text deleted."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    seen = merkle.leaf_digest(*(F.col(f) for f in fields[:-1]), tampered)
    docs = documents(spark, sf, "source", "lang", "n_chars")
    out = merkle.manifest(docs, fields, "source", "doc_id", {"seen": seen})
    folded = merkle.fold(F.col("seen"), F.col("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _merkle_sql(levels: int = 9) -> str:
    told = lambda text: "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    ctes = [f"""leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {told("text")} AS leaf,
    {told(f"(CASE WHEN ({CRC}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS seen FROM documents),
d0 AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS total,
    seen AS acc, '' AS proof FROM leaves),
a0 AS (SELECT g, i, total, leaf AS node FROM d0)"""]

    def climb(node: str, walk: str):
        for k in range(levels):
            ctes.append(f"""{node}{k + 1} AS (
  SELECT g, i // 3 AS i, (max(total) + 2) // 3 AS total,
    CASE WHEN max(total) > 1 THEN sha256(string_agg(node, '' ORDER BY i)) ELSE max(node) END AS node
  FROM {node}{k} GROUP BY g, i // 3),
{node}s{k} AS (
  SELECT a.g, a.i, max(a.total) AS n, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
    coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM {node}{k} a JOIN {node}{k} b ON a.g = b.g AND a.i // 3 = b.i // 3 GROUP BY a.g, a.i),
{walk}{k + 1} AS (
  SELECT d.* REPLACE (d.i // 3 AS i, CASE WHEN n > 1 THEN sha256(l || acc || r) ELSE acc END AS acc,
    proof || CASE WHEN n > 1 THEN l || r ELSE '' END AS proof)
  FROM {walk}{k} d JOIN {node}s{k} s ON s.g = d.g AND s.i = d.i)""")

    climb("a", "d")
    ctes.append(f"""b0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS total, node, g AS source FROM a{levels}),
e0 AS (SELECT d.* REPLACE ('' AS g, b.i AS i), b.node AS subroot FROM d{levels} d JOIN b0 b ON b.source = d.g)""")
    climb("b", "e")
    return f"""WITH {", ".join(ctes)}
SELECT doc_id, leaf, subroot, b.node AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = b.node AS verified
FROM e{levels} CROSS JOIN b{levels} b"""


ORACLES["op13_merkle_manifest"] = _merkle_sql()


@query
def op12_similarity_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.near_duplicates(documents(spark, sf)).select("doc_id", "n_shingles", "component_id", "kept")


# exact: two sets that link share one of the first n - ceil(0.8 n) + 1 shingles of each, rare ones first
ORACLES["op12_similarity_sketch"] = """
WITH RECURSIVE ws AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(greatest(len(w) - 1, least(len(w), 1)))) AS i FROM ws),
shingles AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i + 1 : i + 2], ' ')) AS s FROM spots),
size AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
often AS (SELECT s, count(*) AS f FROM shingles GROUP BY s),
ranked AS (SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r FROM shingles JOIN often USING (s) JOIN size USING (doc_id)),
firsts AS (SELECT doc_id, s, n FROM ranked WHERE r <= n - (80 * n + 99) // 100 + 1),
maybe AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM firsts a JOIN firsts b ON a.s = b.s AND a.doc_id < b.doc_id
          WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
pairs AS (SELECT a, b, count(*) AS common FROM maybe JOIN shingles x ON x.doc_id = a JOIN shingles y ON y.doc_id = b AND y.s = x.s GROUP BY a, b),
links AS (SELECT a, b FROM pairs JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN edges e ON e.a = reach.r)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN size USING (doc_id) GROUP BY d.doc_id
"""
