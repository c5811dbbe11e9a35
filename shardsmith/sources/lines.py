"""S1 line scans and S3 source labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsmith.sources.tables import spread_narrow

# Fixed value: the file-name suffix pattern stripped to get a source label
# (a digit, any character, "txt", any character, "gz"; Java regex syntax).
SOURCE_SUFFIX = r"\d.txt.gz"


def read_lines(spark: SparkSession, *paths: str, spread: bool = True, label: str | None = None) -> DataFrame:
    """One row per line, ``value STRING``.  Any Hadoop file system; the
    codec follows the file suffix (``.gz``, ``.bz2``, ...).  A few big
    unsplittable files (gzip) are spread over the cluster before parsing.
    ``label`` adds a column with each line's source label (S3), taken from
    the file name while the rows are still a bare file scan."""
    df = spark.read.text(list(paths))
    if label:
        df = with_source_label(df, label)
    return spread_narrow(spark, df) if spread else df


def source_label(name: Column | str) -> Column:
    """S3: a file name with its ``<digit>.txt.gz`` tail removed (every match)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(c, SOURCE_SUFFIX, "")


def file_name(df: DataFrame) -> Column:
    """The plain name of the file a row was read from.  Spark reports it
    URI-encoded (a space is ``%20``); a literal ``+`` is kept as ``+``."""
    raw = F.col("_metadata.file_name")
    return F.url_decode(F.regexp_replace(raw, r"\+", "%2B"))


def with_source_label(df: DataFrame, out: str = "source") -> DataFrame:
    """Attach the label of the file each row was read from (apply to a bare
    file scan, before any repartition)."""
    return df.withColumn(out, source_label(file_name(df)))
