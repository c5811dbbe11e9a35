"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are runs of 12 or more characters of ``[A-Za-z0-9+/_-]`` with a
digit.  Features: length, shares of character classes and of distinct
characters, transitions between classes, entropy, coverage by the corpus'
dictionary (words in ``min_docs`` documents or more), the path, and the
neighbouring words.  The forest is trained on a sample of labelled findings:
``max_labelled`` of them at most, picked by hash, half of each label.  Everything is DataFrame
functions and Spark's own forest.

Defined cases: null and empty texts have no candidates; null paths are empty;
null ids are allowed; equal rows are scanned each; without labelled findings
of both kinds nothing is removed (``score`` null, ``is_secret`` true); columns
of the input other than those named are ignored; empty tables give empty
results; texts are scanned whole, in linear time.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardsmith.session import shared_dir

CHARS = "A-Za-z0-9+/_-"
CANDIDATE = rf"(?<![{CHARS}])(?=[A-Za-z+/_-]*+[0-9])[{CHARS}]{{12,}}+"
NEAR = 80  # characters kept on each side of a candidate
# Words that announce a credential, and places where findings are examples.
ANNOUNCE = r"(?i)(password|passwd|pwd|secret|token|api_?key|access_?key|private_?key|credential|authorization|bearer)"
EXAMPLE_PATH = r"(?i)(test|spec|mock|fixture|sample|example|doc)"
# Formats that are published for credentials.
KEY_FORMAT = r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abp]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}|[sr]k_live_[0-9A-Za-z]{24,})$"
ASSIGNED = r"(?i)(password|passwd|pwd|secret|token|api_?key)[\"']?\s*[=:]\s*[\"']?$"

NUMBERS = ["n", "digits", "upper", "distinct", "transitions", "entropy", "coverage", "example_path", "path_depth", "announced", "assigned", "quoted"]
BUCKETS = 8  # of the words beside a candidate, each side


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id, path, start, end, value, left, right) of every candidate; code points, end exclusive."""
    docs = docs.select(F.col(id_col), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), F.col(text_col).alias("__text"))
    found = docs.filter(F.col("__text").rlike(CANDIDATE)).withColumn("__row", F.monotonically_increasing_id())
    found = found.withColumns({"__values": F.regexp_extract_all("__text", F.lit(CANDIDATE), F.lit(0)), "__gaps": F.split("__text", CANDIDATE, -1)}).drop("__text")
    rows = found.select(
        id_col, "path", "__row",
        F.posexplode(F.transform("__values", lambda v, i: F.struct(v.alias("value"), F.length(F.col("__gaps")[i]).alias("gap"), F.right(F.col("__gaps")[i], F.lit(NEAR)).alias("left"), F.left(F.col("__gaps")[i + 1], F.lit(NEAR)).alias("right")))).alias("__i", "c"),
    ).select(id_col, "path", "__row", "__i", "c.*")
    end = F.sum(F.col("gap") + F.length("value")).over(W.partitionBy("__row").orderBy("__i").rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("end", end).select(id_col, "path", (F.col("end") - F.length("value")).alias("start"), "end", "value", "left", "right")


def dictionary(docs: DataFrame, min_docs: int = 5, text_col: str = "text") -> DataFrame:
    """(word): the words of three letters or more, A to Z, that ``min_docs`` documents or more have."""
    ws = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("[a-z]{3,}"), F.lit(0)))).alias("word"))
    return ws.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("word")


def _share(x: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(x, f"[^{chars}]", "")) / F.length(x)


def _bucket(word: Column, side: str) -> list[Column]:
    at = F.when(word == "", F.lit(-1)).otherwise(F.crc32(F.lower(word)) % BUCKETS)
    return [F.when(at == i, 1.0).otherwise(0.0).alias(f"{side}_{i}") for i in range(BUCKETS)]


def with_features(found: DataFrame, words: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``found`` with the columns of NUMBERS and the buckets of neighbouring words."""
    found = found.withColumn("__row", F.monotonically_increasing_id())
    v = F.col("value")
    # coverage is a property of the value: looked up once for each distinct one
    pieces = found.select("value").distinct().select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = pieces.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("__covered"))
    found = found.join(covered, "value", "left")
    chars = F.split(v, "")
    count = F.transform(F.array_distinct(chars), lambda c: (F.length(v) - F.length(F.replace(v, c, F.lit("")))) / F.length(v))
    before, after = F.regexp_extract("left", r"(\S+)\s*$", 1), F.regexp_extract("right", r"^\S?\s*(\S+)", 1)
    return found.select(
        id_col, "path", "start", "end", "value", "left", "right",
        F.length(v).cast("double").alias("n"), _share(v, "0-9").alias("digits"), _share(v, "A-Z").alias("upper"),
        (F.size(F.array_distinct(chars)) / F.length(v)).alias("distinct"),
        ((F.length(F.regexp_replace(v, "[a-z]+|[A-Z]+|[0-9]+|[+/_-]+", ".")) - 1) / F.length(v)).alias("transitions"),
        F.aggregate(count, F.lit(0.0), lambda a, p: a - p * F.log2(p)).alias("entropy"),
        (F.coalesce("__covered", F.lit(0)) / F.length(v)).alias("coverage"),
        F.col("path").rlike(EXAMPLE_PATH).cast("double").alias("example_path"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("path_depth"),
        F.col("left").rlike(ANNOUNCE).cast("double").alias("announced"),
        F.col("left").rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        F.col("left").rlike(r"[\"']$").cast("double").alias("quoted"),
        *_bucket(before, "left"), *_bucket(after, "right"),
    )


def label_by_format(features: DataFrame) -> DataFrame:
    """Labelled findings from what is published: a credential's format, or a value assigned to a credential's name,
    is a secret; nothing else is."""
    secret = F.col("value").rlike(KEY_FORMAT) | F.col("left").rlike(ASSIGNED)
    return features.withColumn("label", secret.cast("double"))


def train(labelled: DataFrame, max_labelled: int = 20_000, trees: int = 40, depth: int = 8, seed: int = 1) -> PipelineModel | None:
    """A forest from findings with features and ``label``; none without both labels.

    Half of ``max_labelled`` is kept for each label, so a rare label is never crowded out of the sample.
    The model comes back from the shared folder it is saved to: as fitted, it holds its training summary and with
    that the session, which can't be shipped to tasks once a query has used ``observe``.
    """
    spark = labelled.sparkSession
    pick = [F.xxhash64(F.lit(seed), "value", "left", "right"), "value", "start"]
    half = lambda secret: labelled.filter(F.col("label") == secret).orderBy(*pick).limit(max_labelled // 2)
    rows = half(1.0).unionByName(half(0.0))
    inputs = [*NUMBERS, *(f"{s}_{i}" for s in ("left", "right") for i in range(BUCKETS))]
    assemble = VectorAssembler(inputCols=inputs, outputCol="__features")
    rows = assemble.transform(rows).select("__features", "label").cache()
    try:
        if rows.select("label").distinct().count() < 2:
            return None
        forest = RandomForestClassifier(featuresCol="__features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, probabilityCol="__p", rawPredictionCol="__raw", predictionCol="__label")
        path = shared_dir(spark, "llm", "secret_forest", unique=True)
        PipelineModel([assemble, forest.fit(rows)]).save(path)
        return PipelineModel.load(path)
    finally:
        rows.unpersist()


def score(features: DataFrame, model: PipelineModel | None, threshold: float = 0.5) -> DataFrame:
    """``features`` with ``score`` (the forest's probability) and ``is_secret``."""
    if model is None:
        return features.withColumns({"score": F.lit(None).cast("double"), "is_secret": F.lit(True)})
    scored = model.transform(features).withColumn("score", vector_to_array("__p")[1])
    return scored.withColumn("is_secret", F.col("score") >= threshold).drop("__features", "__p", "__raw", "__label")
