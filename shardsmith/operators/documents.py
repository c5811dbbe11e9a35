"""Documents: lines or table rows -> the document envelope.

A document frame always carries the envelope columns

    _id STRING, _routing STRING, _seq BIGINT, _source STRING

plus, once validated, the typed mapping fields and ``_reason``/``_field``
(NULL for accepted documents).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.functions.jsonfn import member_text, parse_objects

ENVELOPE = ["_id", "_routing", "_seq", "_source"]


def _col(c: Column | str | None) -> Column | None:
    if c is None:
        return None
    return F.col(c) if isinstance(c, str) else c


def documents_from_lines(
    lines: DataFrame,
    *,
    fmt: str = "json",
    id_field: str | None = None,
    routing_field: str | None = None,
    seq_field: str | None = None,
) -> DataFrame:
    """Turn a ``value STRING`` frame (one document per line) into documents.

    ``fmt='json'``: the line is parsed and re-printed compactly (P1); lines that
    are not JSON objects keep their raw text and are later rejected (P2).  The
    parsed object goes along as a VARIANT (``_doc``, with ``_object``) for the
    checks and the build, which drop it.
    ``fmt='text'``: the raw line becomes ``{"value": <line>}`` (P8).

    Without ``id_field`` the id is the SHA-256 of the source text, so the same
    text always lands on the same shard (deterministic spread, R5).
    ``routing_field`` routes by a member of the document (R6); the default
    routing is the id.
    """
    if fmt == "text":
        docs = lines.select(text_document("value").alias("_source"))
        parsed = []
    elif fmt == "json":
        # parsed here, and never again: ``_doc`` and ``_object`` go along until the checks are done
        docs = parse_objects(lines.select("value")).select(F.col("_compact").alias("_source"), "_object", "_doc")
        parsed = ["_object", "_doc"]
    else:
        raise ValueError(f"fmt must be 'json' or 'text', got {fmt!r}")
    src = F.col("_source")

    doc = F.col("_doc") if parsed else F.lit(None).cast("variant")
    member = lambda name: member_text(doc, src, name)

    _id = member(id_field) if id_field else F.sha2(src, 256)
    docs = docs.withColumn("_id", _id)
    routing = member(routing_field) if routing_field else F.col("_id")
    seq = member(seq_field).try_cast("bigint") if seq_field else F.lit(0).cast("bigint")
    return docs.withColumns({"_routing": routing, "_seq": seq}).select(*ENVELOPE, *parsed)


def text_document(text: Column | str) -> Column:
    """Raw text kept as is, wrapped as ``{"value": <text>}``."""
    return F.to_json(F.struct(_col(text).alias("value")))


def json_safe_columns(df: DataFrame) -> list[Column]:
    """Columns for ``to_json``: timestamps printed with all six fraction digits
    (``to_json`` alone keeps milliseconds only)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(f.name))
        else:
            out.append(F.col(f.name))
    return out


def documents_from_table(
    df: DataFrame,
    id_col: Column | str,
    *,
    routing_col: Column | str | None = None,
    seq_col: Column | str | None = None,
    source_cols: list[str] | None = None,
) -> DataFrame:
    """Rows of a table as documents: ``_source`` is the row as JSON, the typed
    columns are the row's own columns (already typed, so no re-validation)."""
    cols = source_cols or df.columns
    body = df.select(*cols)
    _id = _col(id_col).cast("string")
    routing = _col(routing_col).cast("string") if routing_col is not None else _id
    seq = _col(seq_col).cast("bigint") if seq_col is not None else F.lit(0).cast("bigint")
    return df.select(
        _id.alias("_id"),
        routing.alias("_routing"),
        seq.alias("_seq"),
        F.to_json(F.struct(*json_safe_columns(body))).alias("_source"),
        *[F.col(c) for c in cols],
    )


def envelope(docs: DataFrame, index: str, type_name: str) -> DataFrame:
    """The index request envelope ``_index, _type, _id, _routing, _source``."""
    return docs.select(
        F.lit(index).alias("_index"),
        F.lit(type_name).alias("_type"),
        "_id",
        "_routing",
        "_source",
    )


def documents_from_columns(
    df: DataFrame,
    *,
    id_col: Column | str,
    source: Column | str,
    routing_col: Column | str | None = None,
    seq_col: Column | str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Documents whose id, routing and seq come from columns and whose body is
    an already-built JSON text column (validated later against a mapping)."""
    _id = _col(id_col).cast("string")
    routing = _col(routing_col).cast("string") if routing_col is not None else _id
    seq = _col(seq_col).cast("bigint") if seq_col is not None else F.lit(0).cast("bigint")
    return df.select(
        _id.alias("_id"),
        routing.alias("_routing"),
        seq.alias("_seq"),
        _col(source).cast("string").alias("_source"),
        *[F.col(c) for c in (keep or [])],
    )
