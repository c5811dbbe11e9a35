"""JSON helpers (P1, P2) built on Spark's JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compact_json(text: Column | str) -> Column:
    """Re-print JSON compactly, key order and nulls kept.

    ``get_json_object(x, '$')`` re-serialises the parsed value, so spacing
    disappears while member order and duplicate members are left as written.
    """
    return F.get_json_object(_as_col(text), "$")


def object_keys(text: Column | str) -> Column:
    """Top-level member names; NULL unless the text is a JSON object."""
    return F.json_object_keys(_as_col(text))


def is_json_object(text: Column | str) -> Column:
    """True only for one JSON object (arrays, scalars, blank, junk -> false).

    The parser stops after a first value, so text behind it would go unseen.
    The text is therefore parsed wrapped as well: alone in an array, and as
    the one member of an object; what follows an object breaks one of them.
    """
    x = _as_col(text)
    alone = F.json_array_length(F.concat(F.lit("["), x, F.lit("]"))) == 1
    member = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), x, F.lit("}")))) == 1
    return F.coalesce(object_keys(x).isNotNull() & alone & member, F.lit(False))


# Fixed value: follows a line's text while it is parsed, so that whatever stands behind its first value is seen.
END = "~end of line~"
_TAIL = f',"{END}"]'


def parse_objects(df: DataFrame, text: str = "value") -> DataFrame:
    """``df`` with ``_object`` (P2), ``_compact`` (P1, else the text) and ``_doc``: the object as a VARIANT, parsed once.

    The text goes through the parser as the first of two values, the second
    one fixed: the pair is printed compactly, and that is parsed into a
    VARIANT.  If its second value is the fixed one, the text is one value and
    nothing else.  Texts that give no VARIANT (not JSON, or repeated members)
    or hold the fixed value themselves go through :func:`is_json_object`;
    their ``_doc`` is NULL.
    """
    x, cols = F.col(text), df.columns
    pair = F.get_json_object(F.concat(F.lit("["), x, F.lit(_TAIL)), "$")
    df = df.select(*cols, pair.alias("_pair")).select("*", F.try_parse_json("_pair").alias("_both"))
    one = (F.try_variant_get("_both", "$[1]", "string") == END) & ~x.contains(END)
    df = df.select("*", F.coalesce(one, F.lit(False)).alias("_one"))
    is_object = F.when(F.col("_one"), F.col("_pair").startswith("[{")).otherwise(is_json_object(x))
    df = df.select("*", is_object.alias("_object"))
    parsed = F.col("_one") & F.col("_object")
    printed = F.substr(F.col("_pair"), F.lit(2), F.length("_pair") - (1 + len(_TAIL)))
    return df.select(
        *cols,
        "_object",
        F.when(parsed, printed).when(F.col("_object"), compact_json(x)).otherwise(x).alias("_compact"),
        F.when(parsed, F.variant_get("_both", "$[0]", "variant")).alias("_doc"),
    )


def member_text(doc: Column, source: Column, name: str) -> Column:
    """The text of a member: from the VARIANT for texts and whole numbers, else as the document writes it (of repeated
    members the last)."""
    path = json_path(name)
    kind = F.schema_of_variant(F.variant_get(doc, path, "variant"))
    written = F.from_json(source, T.StructType([T.StructField(name, T.StringType())]))[name]
    absent = doc.isNotNull() & kind.isNull()
    return F.when(kind.isin("STRING", "BIGINT"), F.try_variant_get(doc, path, "string")).when(~absent, written)


def json_path(*names: str) -> str:
    """A JSON path for nested member names, bracket-quoted where needed."""
    parts = ["$"]
    for n in names:
        if n.replace("_", "").isalnum() and not n[:1].isdigit():
            parts.append(f".{n}")
        else:
            parts.append("['" + n.replace("'", "\\'") + "']")
    return "".join(parts)


def variant_kind(v: Column, path: str) -> Column:
    """Kind of the value at ``path`` of a variant: 'BIGINT', 'DECIMAL(2,1)',
    'DOUBLE', 'STRING', 'BOOLEAN', 'OBJECT<..>', 'ARRAY<..>', 'VOID' (JSON null),
    or NULL when the member is absent."""
    return F.schema_of_variant(F.variant_get(v, path, "variant"))
