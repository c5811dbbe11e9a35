"""Mapping checks: typed projection (P5), strict fields (P6), object check.

``validate(docs, mapping)`` keeps every row and adds ``_reason``/``_field``
(both NULL when the document fits) plus one typed column per top-level
mapping field.  Reasons, first match wins:

    not_an_object      the text is not a JSON object
    duplicate_field    a member name repeats (at any level)
    undeclared_field   strict mapping and a member is not declared
    wrong_type         a declared member holds a value of another kind
    missing_id         no id or no routing value could be derived

All checks are built-in expressions over one parsed VARIANT per document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardsmith.functions.jsonfn import json_path, object_keys, parse_objects, variant_kind
from shardsmith.sources.template import FRACTIONAL, INTEGRAL, FieldSpec, Mapping

# Reason codes written to the rejects table.
NOT_AN_OBJECT = "not_an_object"
DUPLICATE_FIELD = "duplicate_field"
UNDECLARED_FIELD = "undeclared_field"
WRONG_TYPE = "wrong_type"
MISSING_ID = "missing_id"

PARSED = ("_object", "_doc")  # what documents that were parsed bring along

_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_NUM_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_INT_KINDS = ["BIGINT", "INT", "SMALLINT", "TINYINT"]


def _first_duplicate(keys: Column) -> Column:
    return F.element_at(F.filter(keys, lambda k: F.size(F.filter(keys, lambda x: x == k)) > 1), 1)


def _variant_keys(v: Column, path: str) -> Column:
    """Member names of the object at ``path`` (NULL if it is not an object)."""
    return F.map_keys(F.try_variant_get(v, path, "map<string,variant>"))


class _Plan:
    """Collects, per member, the columns to materialise once (kinds) and the
    checks/values computed from them, so that no JSON or VARIANT expression is
    evaluated more than once per row."""

    def __init__(self, numeric_text: bool) -> None:
        self.numeric_text = numeric_text
        self.kinds: list[tuple[str, Column]] = []  # (column name, expression)
        self.checks: list[tuple[Column, str, Column]] = []

    def kind(self, v: Column, path: str) -> Column:
        return self.column(variant_kind(v, path))

    def column(self, expr: Column) -> Column:
        """Materialise ``expr`` once in the lower projection; returns a reference."""
        name = f"_k{len(self.kinds)}"
        self.kinds.append((name, expr))
        return F.col(name)

    def add(self, cond: Column, reason: str, field: Column) -> None:
        self.checks.append((cond, reason, field))

    def reason(self) -> Column:
        return F.coalesce(*[F.when(c, F.lit(r)) for c, r, _ in self.checks], F.lit(None).cast("string"))

    def field(self) -> Column:
        return F.coalesce(*[F.when(c, f) for c, _, f in self.checks], F.lit(None).cast("string"))


def _scalar(spec: FieldSpec, v: Column, path: str, kind: Column, numeric_text: bool,
            plan: "_Plan | None" = None) -> tuple[Column, Column]:
    """(bad, typed value) for one scalar member, given its kind.  With a plan,
    the raw typed value and (for STRING kinds only) the text are materialised
    next to the kind, so the checks above only compare columns."""
    present = kind.isNotNull() & (kind != "VOID")
    text = F.try_variant_get(v, path, "string")
    value = F.try_variant_get(v, path, spec.spark_type.simpleString())
    if spec.kind == "date":  # text is parsed; an integral number counts as epoch milliseconds
        value = F.when(
            F.schema_of_variant(F.variant_get(v, path, "variant")).isin(_INT_KINDS),
            F.timestamp_millis(F.try_variant_get(v, path, "bigint")),
        ).otherwise(value)
    if plan is not None:
        value = plan.column(value)
        if spec.kind in INTEGRAL | FRACTIONAL | {"boolean"}:
            text = plan.column(F.when(F.schema_of_variant(F.variant_get(v, path, "variant")) == "STRING", text))
    if spec.kind in INTEGRAL:
        ok = kind.isin(_INT_KINDS) | kind.rlike(r"^DECIMAL\(\d+,0\)$")
        if numeric_text:
            ok = ok | ((kind == "STRING") & text.rlike(_INT_TEXT))
    elif spec.kind in FRACTIONAL:
        ok = kind.isin(_INT_KINDS + ["DOUBLE", "FLOAT"]) | kind.startswith("DECIMAL")
        if numeric_text:
            ok = ok | ((kind == "STRING") & text.rlike(_NUM_TEXT))
    elif spec.kind == "boolean":
        ok = (kind == "BOOLEAN") | ((kind == "STRING") & F.lower(text).isin("true", "false"))
    elif spec.kind == "date":
        ok = (kind == "STRING") | kind.isin(_INT_KINDS)
    else:  # string-like: any scalar prints as text, objects and arrays do not
        ok = ~(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
    good = present & ok
    value = F.when(good, value)
    bad = present & (~ok | value.isNull())
    return bad, value


def _below(spec: FieldSpec, e: Column, rule) -> Column:
    """Whether ``rule(child, value)`` holds for an object or nested member below ``e``, at its place or in its array."""
    out = F.lit(False)
    for c in spec.children:
        path = json_path(c.name)
        if c.kind == "object":
            out = out | rule(c, F.try_variant_get(e, path, "variant"))
        elif c.kind == "nested":
            out = out | F.coalesce(F.exists(F.try_variant_get(e, path, "array<variant>"), lambda x: rule(c, x)), F.lit(False))
    return out


def _undeclared_inside(spec: FieldSpec, e: Column) -> Column:
    """Whether the variant ``e``, an element of an array, has an undeclared member at any level."""
    out = _below(spec, e, _undeclared_inside)
    if spec.dynamic == "strict":
        extra = F.array_except(_variant_keys(e, "$"), F.array(*[F.lit(c.name) for c in spec.children]))
        out = out | F.coalesce(F.size(extra) > 0, F.lit(False))
    return out


def _wrong_inside(spec: FieldSpec, e: Column, numeric_text: bool) -> Column:
    """Whether ``e`` is no object, or has a member of a wrong kind at any level; a JSON null is no value."""
    kind = F.schema_of_variant(e)
    out = F.coalesce((kind != "VOID") & ~kind.startswith("OBJECT"), F.lit(False))
    for c in spec.children:
        path = json_path(c.name)
        member = variant_kind(e, path)
        if c.kind == "nested":
            bad = (member != "VOID") & ~member.startswith("ARRAY")
        elif c.kind != "object":
            bad, _ = _scalar(c, e, path, member, numeric_text)
        else:
            continue
        out = out | F.coalesce(bad, F.lit(False))
    return out | _below(spec, e, lambda c, x: _wrong_inside(c, x, numeric_text))


def _members(spec_fields, v, names, plan: _Plan) -> list[Column]:
    values = []
    for spec in spec_fields:
        path = json_path(*names, spec.name)
        fname = F.lit(".".join([*names, spec.name]))
        kind = plan.kind(v, path)
        present = kind.isNotNull() & (kind != "VOID")
        if spec.kind == "object":
            plan.add(present & ~kind.startswith("OBJECT"), WRONG_TYPE, fname)
            if spec.dynamic == "strict":
                extra = F.array_except(_variant_keys(v, path), F.array(*[F.lit(c.name) for c in spec.children]))
                plan.add(present & (F.size(extra) > 0), UNDECLARED_FIELD, F.concat_ws(".", fname, F.element_at(extra, 1)))
            kids = _members(spec.children, v, [*names, spec.name], plan)
            values.append(F.when(present, F.struct(*[k.alias(c.name) for k, c in zip(kids, spec.children)])))
        elif spec.kind == "nested":
            plan.add(present & ~kind.startswith("ARRAY"), WRONG_TYPE, fname)
            elems = F.try_variant_get(v, path, "array<variant>")
            undeclared = F.exists(elems, lambda e: _undeclared_inside(spec, e))
            wrong = F.exists(elems, lambda e: _wrong_inside(spec, e, plan.numeric_text))
            plan.add(present & kind.startswith("ARRAY") & undeclared, UNDECLARED_FIELD, fname)
            plan.add(present & kind.startswith("ARRAY") & wrong, WRONG_TYPE, fname)
            values.append(F.try_variant_get(v, path, spec.spark_type.simpleString()))
        else:
            bad, value = _scalar(spec, v, path, kind, plan.numeric_text, plan)
            plan.add(bad, WRONG_TYPE, fname)
            values.append(value)
    return values


def validate(docs: DataFrame, mapping: Mapping, *, numeric_text: bool = True, observation=None) -> DataFrame:
    """Add ``_reason``, ``_field`` and typed mapping columns to ``docs``.

    Three projections: take the VARIANT of :func:`documents_from_lines` (or
    parse once) and the member names, materialise each declared member's kind, then derive the reason and typed values from those
    columns.  Filters on ``_reason`` that Spark pushes down therefore repeat
    only cheap comparisons, never a JSON parse."""
    src = F.col("_source")
    v = F.col("_v")
    keys = F.col("_keys")
    plan = _Plan(numeric_text)
    plan.add(keys.isNull(), NOT_AN_OBJECT, F.lit(None).cast("string"))
    plan.add(F.size(keys) != F.size(F.array_distinct(keys)), DUPLICATE_FIELD, _first_duplicate(keys))
    plan.add(v.isNull(), DUPLICATE_FIELD, F.lit(None).cast("string"))
    if mapping.strict:
        names = F.array(*[F.lit(n) for n in mapping.field_names])
        extra = F.array_except(keys, names)
        # a VARIANT has its members by name; of several undeclared ones the first written is named
        first = F.when(F.size(extra) > 1, F.element_at(F.array_except(object_keys(src), names), 1)).otherwise(F.element_at(extra, 1))
        plan.add(F.size(extra) > 0, UNDECLARED_FIELD, first)
    values = _members(mapping.fields, v, [], plan)
    plan.add(F.col("_id").isNull() | F.col("_routing").isNull(), MISSING_ID, F.lit(None).cast("string"))
    carried = PARSED if set(PARSED) <= set(docs.columns) else ()
    docs = docs if carried else parse_objects(docs, "_source").drop("_compact")
    written = F.when(F.col("_object"), object_keys(src))  # only of objects that give no VARIANT
    parsed = docs.withColumnRenamed("_doc", "_v")
    parsed = parsed.withColumn("_keys", F.when(v.isNotNull(), _variant_keys(v, "$")).otherwise(written))
    kinded = parsed.select("*", *[e.alias(n) for n, e in plan.kinds])
    declared = set(mapping.field_names)
    checked = kinded.select(
        *[c for c in docs.columns if c not in declared and c not in PARSED],  # validated values replace same-named columns
        plan.reason().alias("_reason"),
        plan.field().alias("_field"),
        *[val.alias(spec.name) for val, spec in zip(values, mapping.fields)],
    )
    # Validation counts, observed as the rows pass.  Predicates are not pushed
    # through an observation, so a later filter on ``_reason`` reads the
    # computed column instead of re-running the checks below it.
    name = observation or f"validation_{uuid.uuid4().hex[:12]}"
    return checked.observe(
        name,
        F.count(F.lit(1)).alias("docs"),
        F.count(F.col("_reason")).alias("rejects"),
    )


def typed_projection(docs: DataFrame, mapping: Mapping, *, numeric_text: bool = True) -> DataFrame:
    """P5: accepted documents with their typed mapping columns."""
    checked = validate(docs, mapping, numeric_text=numeric_text)
    return checked.where(F.col("_reason").isNull()).drop("_reason", "_field")


def rejects(checked: DataFrame) -> DataFrame:
    """Rows of a validated frame that did not fit: ``_id, _source, reason, field``."""
    return checked.where(F.col("_reason").isNotNull()).select(
        "_id", "_source", F.col("_reason").alias("reason"), F.col("_field").alias("field")
    )
