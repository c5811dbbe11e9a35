"""The index template (mapping) as a driver-side object.

A template is one small JSON document::

    {"template": "*", "settings": {"number_of_shards": 8, ...},
     "mappings": {"<type>": {"dynamic": "strict", "properties": {...}}}}

It is read with ``spark.read.text(path, wholetext=True)`` (so any Hadoop file
system works) and turned into a :class:`Mapping`, whose ``struct_type`` is the
Spark schema of the typed document columns.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Mapping type names and the Spark type each one becomes.
SCALAR_TYPES = {
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "keyword": T.StringType(),
    "text": T.StringType(),
    "date": T.TimestampType(),
}
INTEGRAL = {"integer", "long", "short", "byte"}
FRACTIONAL = {"float", "double"}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    kind: str  # a SCALAR_TYPES key, "object" or "nested"
    children: tuple["FieldSpec", ...] = ()
    dynamic: str = "strict"

    @property
    def spark_type(self) -> T.DataType:
        if self.kind == "object":
            return T.StructType([T.StructField(c.name, c.spark_type) for c in self.children])
        if self.kind == "nested":
            return T.ArrayType(
                T.StructType([T.StructField(c.name, c.spark_type) for c in self.children])
            )
        return SCALAR_TYPES[self.kind]


@dataclass(frozen=True)
class Mapping:
    type_name: str
    fields: tuple[FieldSpec, ...]
    dynamic: str = "strict"
    index_pattern: str = "*"
    settings: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def strict(self) -> bool:
        return self.dynamic == "strict"

    @property
    def default_shards(self) -> int | None:
        n = self.settings.get("number_of_shards", self.settings.get("index.number_of_shards"))
        return int(n) if n is not None else None


def _parse_properties(props: dict, dynamic: str) -> tuple[FieldSpec, ...]:
    out = []
    for name, spec in props.items():
        if name.startswith("_"):
            raise ValueError(f"field names starting with '_' are reserved: {name!r}")
        kind = spec.get("type", "object" if "properties" in spec else None)
        child_dynamic = str(spec.get("dynamic", dynamic)).lower()
        if kind in ("object", "nested"):
            children = _parse_properties(spec.get("properties", {}), child_dynamic)
            out.append(FieldSpec(name, kind, children, child_dynamic))
        elif kind in SCALAR_TYPES:
            out.append(FieldSpec(name, kind))
        else:
            raise ValueError(f"unsupported mapping type {kind!r} for field {name!r}")
    return tuple(out)


def parse_template(text: str, type_name: str | None = None) -> Mapping:
    doc = json.loads(text)
    mappings = doc.get("mappings", {})
    if not mappings:
        raise ValueError("template has no mappings")
    if "properties" in mappings and isinstance(mappings["properties"], dict):
        # typeless form: {"mappings": {"dynamic": ..., "properties": {...}}}
        mappings = {type_name or "_doc": mappings}
    if type_name is None:
        if len(mappings) != 1:
            raise ValueError(f"template has several types {sorted(mappings)}; name one")
        type_name = next(iter(mappings))
    if type_name not in mappings:
        raise ValueError(f"type {type_name!r} not in template types {sorted(mappings)}")
    tmap = mappings[type_name]
    dynamic = str(tmap.get("dynamic", "true")).lower()
    return Mapping(
        type_name=type_name,
        fields=_parse_properties(tmap.get("properties", {}), dynamic),
        dynamic=dynamic,
        index_pattern=doc.get("template", "*"),
        settings=dict(doc.get("settings", {})),
    )


def load_template(spark: SparkSession, path: str, type_name: str | None = None) -> Mapping:
    """Read one template file from any Hadoop file system (S3, HDFS, local)."""
    rows = spark.read.text(path, wholetext=True).take(1)
    if not rows:
        raise ValueError(f"template file {path!r} is empty")
    return parse_template(rows[0][0], type_name)


def mapping_from_schema(schema: T.StructType, type_name: str = "doc") -> Mapping:
    """A strict mapping that mirrors a table schema (for table-built indices)."""
    back = {}
    for k, v in SCALAR_TYPES.items():
        back.setdefault(type(v), k)

    def conv(f: T.StructField) -> FieldSpec:
        dt = f.dataType
        if isinstance(dt, T.StructType):
            return FieldSpec(f.name, "object", tuple(conv(c) for c in dt.fields))
        if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
            return FieldSpec(f.name, "nested", tuple(conv(c) for c in dt.elementType.fields))
        if type(dt) in back:
            return FieldSpec(f.name, back[type(dt)])
        if isinstance(dt, T.TimestampNTZType):
            return FieldSpec(f.name, "date")
        raise ValueError(f"no mapping type for column {f.name!r} of type {dt.simpleString()}")

    return Mapping(type_name, tuple(conv(f) for f in schema.fields), "strict")
