"""Grok patterns, and the offset audit."""

import pytest
from pyspark.sql import functions as F

from topicwright import RecordShape, ShapeError, decode_topic, open_topic
from topicwright.functions.grok import GrokError, compile_grok
from topicwright.operators import ranges
from topicwright.operators.audit import audit_offsets
from topicwright.sources.topic_log import LOG_SCHEMA


@pytest.mark.parametrize(
    "pattern, fields",
    [
        ("%{INT:a} (x|y) %{WORD:b}", [("a", None), ("b", None)]),
        (r"\(%{INT:a:int}\) [(]%{WORD}(?<c>\d+)(?:z)(?=q)(?<!r)", [("a", "int"), ("c", None)]),
        ("%{OUTER:o}", [("o", None), ("inner", "double")]),
        (r"[\](]%{INT:a.b-c@d}[]()]", [("a.b-c@d", None)]),
    ],
)
def test_compiled_patterns_have_a_group_for_each_field(pattern, fields):
    grok = compile_grok(pattern, {"OUTER": "<(%{NUMBER:inner:double})>"})
    assert grok.fields == fields
    import re

    assert re.compile(grok.pattern.replace("(?<c>", "(")).groups == len(fields)


@pytest.mark.parametrize(
    "pattern, message",
    [
        ("%{NOWHERE:a}", "NOWHERE is not defined"),
        ("%{A:a}", "defined by itself: A > B > C > A"),
        ("%{INT:a:number}", "Unknown type 'number'"),
        ("%{INT:a} %{INT:a}", "several fields named a"),
    ],
)
def test_wrong_patterns(pattern, message):
    with pytest.raises(GrokError, match=message):
        compile_grok(pattern, {"A": "x%{B}", "B": "%{C}+", "C": "(%{A})"})


def messages(spark, lines):
    return spark.createDataFrame([(None, x.encode() if x is not None else None, "t", 0, i) for i, x in enumerate(lines)], "key binary, value binary, topic string, partition int, offset bigint")


def test_grok_decode(spark):
    shape = RecordShape(
        "bytes bigint, clientip string, verb string, request string, response int, httpversion string",
        format="grok", pattern="%{COMMONAPACHELOG}",
    )
    lines = [
        '10.1.2.3 - ann [10/Oct/2000:13:55:36 -0700] "GET /a.gif?x=1 HTTP/1.0" 200 2326',
        'fe80::1 - - [01/Jan/2024:00:00:00 +0000] "POST /b" 404 -',
        "no such line", "", None,
    ]
    rows = [tuple(r) for r in decode_topic(messages(spark, lines), shape).collect()]
    assert rows[0] == (2326, "10.1.2.3", "GET", "/a.gif?x=1", 200, "1.0")
    assert rows[1] == (None, "fe80::1", "POST", "/b", 404, None)
    assert rows[2:] == [(None,) * 6] * 3


def test_grok_shapes_are_checked(spark):
    with pytest.raises(ShapeError) as error:
        RecordShape("a int, b string, c double", format="grok", pattern="%{INT:a:long} %{WORD:d} %{NUMBER:c:double}")
    assert error.value.problems == ["The pattern has no field 'b'.", "Field 'a' is int, but bigint in the pattern."]
    with pytest.raises(ShapeError, match="is not defined"):
        RecordShape("a int", format="grok", pattern="%{NONE:a}")
    shape = RecordShape("b string, a int", format="grok", pattern="%{TWO}", definitions={"TWO": "%{INT:a:int}-%{WORD:b}"})
    assert [tuple(r) for r in decode_topic(messages(spark, ["7-x", "-3-y"]), shape).collect()] == [("x", 7), ("y", -3)]


def damaged(spark, path, offsets):
    rows = spark.createDataFrame([(None, b"x", "t", p, o, None, 0, o >> ranges.SEGMENT_BITS) for p, o in offsets], LOG_SCHEMA)
    rows.write.mode("append").partitionBy("topic", "partition", "segment").parquet(path)
    return open_topic(spark, path)


def test_audit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "SEGMENT_BITS", 3)
    whole = [(0, o) for o in range(5, 40)]
    holed = [(1, o) for o in range(60) if o not in (3, 4, 9, *range(14, 35), 50)] + [(1, o) for o in (0, 1, 6, 7, 8, 9, 58)]
    hidden = [(2, o) for o in range(16) if o != 5] + [(2, 2)]
    log = damaged(spark, f"{tmp_path}/log", whole + holed + hidden)
    expected = {
        ("t", 1, "missing", 3, 5), ("t", 1, "missing", 14, 35), ("t", 1, "missing", 50, 51),
        ("t", 1, "repeated", 0, 2), ("t", 1, "repeated", 6, 9), ("t", 1, "repeated", 58, 59),
    }
    assert {tuple(r) for r in audit_offsets(log, "t").collect()} == expected
    more = {("t", 2, "missing", 5, 6), ("t", 2, "repeated", 2, 3)}
    assert {tuple(r) for r in audit_offsets(log, "t", thorough=True).collect()} == expected | more
    assert audit_offsets(open_topic(spark, f"{tmp_path}/none"), "t").collect() == []
    sound = damaged(spark, f"{tmp_path}/sound", whole)
    assert audit_offsets(sound, "t").collect() == []
