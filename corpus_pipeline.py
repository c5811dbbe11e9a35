"""A training-corpus pipeline: five stages from raw documents to a mixed training order.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; ``run`` writes
each one's result to the cluster's shared folder and reads it again for the
next.  All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsmith.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from shardsmith.llm.common import ROW_KEY, join_rows, materialize, row_key

USED = ("doc_id", "text", "lang", "source")
REST = "__rest"


def _packed(docs: DataFrame) -> DataFrame:
    """The columns that operators use, the others in one struct, so that no name clashes with an operator's."""
    rest = [c for c in docs.columns if c not in USED]
    return docs.select(*(c for c in USED if c in docs.columns), F.struct(*rest, F.lit(0).alias("__")).alias(REST))


def _like(df: DataFrame, docs: DataFrame) -> list:
    """The columns of ``docs`` out of a packed frame."""
    return [df[c] if c in USED else df[REST][c].alias(c) for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the fertility bands accept."""
    judged = quality.quality_rules(_packed(docs), lang_col="lang" if "lang" in docs.columns else None)
    return judged.filter("kept").select(*_like(judged, docs))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more have; ``n_chars`` follows the text."""
    out = line_dedup.drop_lines(_packed(docs))
    cols = dict(zip(docs.columns, _like(out, docs)))
    if "n_chars" in cols:
        cols["n_chars"] = F.when(out["n_dropped"] > 0, F.length(out["text"])).otherwise(out[REST]["n_chars"]).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*cols.values())


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; documents without words stay."""
    found = materialize(ngram_join.jaccard_components(docs), "pipeline_groups")
    first = found.filter("n_shingles > 0").groupBy("component_key").agg(F.min(F.struct("doc_id", ROW_KEY)).alias("r")).select("r.*")
    keep = first.unionByName(found.filter("n_shingles = 0").select("doc_id", ROW_KEY).distinct())
    out = join_rows(docs.withColumn(ROW_KEY, row_key("doc_id", "text")), keep, "doc_id", "inner")
    equal_rows = found.filter("n_shingles > 0").groupBy("doc_id", ROW_KEY).count().filter("count > 1")
    if not equal_rows.isEmpty():  # the same row several times: one of them; rows without words all stay
        empty = F.trim(F.coalesce("text", F.lit(""))) == ""
        out = out.filter(~empty).dropDuplicates(["doc_id", ROW_KEY]).unionByName(out.filter(empty))
    return out.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    out = decontaminate.contamination(_packed(docs), benchmark)
    return out.filter(F.size("contamination") == 0).select(*_like(out, docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each use of a document, with the pass, the block and its place in the mixed order."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_common_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix),
]

#: Token bands and exponents fitted to the corpus are beyond what SQL can express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
