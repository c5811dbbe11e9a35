import json
import os

import pytest

from conftest import FIXTURES
from shardsmith.operators.documents import documents_from_lines
from shardsmith.operators.validate import validate
from shardsmith.sources.template import load_template, parse_template

# FIXTURES.md section 3: line -> (accepted?, reason, field)
EDGE = [
    ('{"a": 1, "b": "x"}', None, None),
    ('{"b":"x"}', None, None),
    ('{"a":null,"b":"x"}', None, None),
    ('{"a":1,"zzz":2}', "undeclared_field", "zzz"),
    ('{"a":"7"}', None, None),
    ('{"a":1.5}', "wrong_type", "a"),
    ('{"a":3000000000}', "wrong_type", "a"),
    ("[1,2]", "not_an_object", None),
    ("", "not_an_object", None),
    ("nope", "not_an_object", None),
    ('{"a":1,"a":2}', "duplicate_field", "a"),
    ('{"a":{"x":1}}', "wrong_type", "a"),
]


@pytest.fixture(scope="module")
def mapping(spark):
    return load_template(spark, os.path.join(FIXTURES, "template.json"))


def _check(spark, mapping, lines, **kw):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    docs = documents_from_lines(df)
    return validate(docs, mapping, **kw).select("_source", "_reason", "_field", "a", "b").collect()


def test_template_loads(mapping):
    assert mapping.type_name == "reading"
    assert mapping.strict and mapping.default_shards == 6
    assert mapping.struct_type.simpleString() == "struct<a:int,b:string,notes:array<struct<by:string,stars:bigint>>>"


def test_edge_lines(spark, mapping):
    rows = _check(spark, mapping, [x for x, _, _ in EDGE])
    assert len(rows) == len(EDGE)
    for (line, reason, field), r in zip(EDGE, rows):
        assert (r._reason, r._field) == (reason, field), line
    by_line = dict(zip([x for x, _, _ in EDGE], rows))
    assert by_line['{"a":"7"}'].a == 7
    assert by_line['{"a":null,"b":"x"}'].a is None and by_line['{"b":"x"}'].b == "x"


def test_numeric_text_can_be_refused(spark, mapping):
    (r,) = _check(spark, mapping, ['{"a":"7"}'], numeric_text=False)
    assert (r._reason, r._field) == ("wrong_type", "a")


def test_nested_mapping(spark):
    m = parse_template(json.dumps({"mappings": {"t": {"dynamic": "strict", "properties": {
        "o": {"properties": {"x": {"type": "long"}, "y": {"type": "string"}}},
        "tags": {"type": "nested", "properties": {"k": {"type": "string"}}},
    }}}}))
    lines = ['{"o":{"x":1,"y":"a"},"tags":[{"k":"p"}]}', '{"o":{"x":1,"z":2}}', '{"tags":[{"k":"p","q":1}]}', '{"o":5}',
             '{"o":{"x":1.5}}', '{"tags":[{"k":"p"},{"k":{"deep":1}}]}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = validate(documents_from_lines(df), m).select("_reason", "_field", "o", "tags").collect()
    assert (rows[4]._reason, rows[4]._field) == ("wrong_type", "o.x")
    assert (rows[5]._reason, rows[5]._field) == ("wrong_type", "tags")
    assert (rows[0]._reason, rows[0].o.x, rows[0].tags[0].k) == (None, 1, "p")
    assert (rows[1]._reason, rows[1]._field) == ("undeclared_field", "o.z")
    assert (rows[2]._reason, rows[2]._field) == ("undeclared_field", "tags")
    assert (rows[3]._reason, rows[3]._field) == ("wrong_type", "o")


def test_unsupported_type_is_an_error():
    with pytest.raises(ValueError, match="unsupported mapping type"):
        parse_template('{"mappings": {"t": {"properties": {"g": {"type": "geo_point"}}}}}')


def test_text_mode_wraps_raw_line(spark):
    df = spark.createDataFrame([('not "json"',)], "value string")
    (r,) = documents_from_lines(df, fmt="text").collect()
    assert r._source == '{"value":"not \\"json\\""}'


def test_typeless_template():
    m = parse_template('{"mappings": {"dynamic": "strict", "properties": {"a": {"type": "integer"}, "t": {"type": "keyword"}}}}')
    assert m.type_name == "_doc" and m.strict and m.struct_type.simpleString() == "struct<a:int,t:string>"
    assert parse_template('{"mappings": {"properties": {"a": {"type": "long"}}}}', "x").type_name == "x"


def test_date_field_text_and_epoch_millis(spark):
    m = parse_template('{"mappings": {"t": {"dynamic": "strict", "properties": {"d": {"type": "date"}}}}}')
    lines = ['{"d": "2024-01-02T03:04:05"}', '{"d": 1704164645000}', '{"d": "not a date"}', '{"d": true}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = validate(documents_from_lines(df), m).select("_reason", "d").collect()
    assert rows[0]._reason is None and rows[1]._reason is None
    assert rows[0].d == rows[1].d  # both 2024-01-02 03:04:05 UTC
    assert [r._reason for r in rows[2:]] == ["wrong_type", "wrong_type"]
