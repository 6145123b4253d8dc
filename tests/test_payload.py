import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from topicwright import RecordShape, ShapeError, decode_topic, to_messages


def messages(spark, *values, key=None):
    rows = [(key, v.encode() if isinstance(v, str) else v, "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint")


def decoded(spark, shape, *values, **more):
    return [tuple(r) for r in decode_topic(messages(spark, *values, **more), shape).collect()]


def test_csv(spark):
    shape = RecordShape("id bigint, first string, last string", format="CSV")
    rows = decoded(spark, shape, "1,ada,stone", 'x,"a,b",c', "2", "3,a,b,c", "", None)
    assert rows == [
        (1, "ada", "stone"), (None, "a,b", "c"), (2, None, None), (3, "a", "b"),
        (None, None, None), (None, None, None),
    ]


def test_csv_types(spark):
    shape = RecordShape("b binary, d date, t timestamp, n decimal(8,3), f boolean", format="csv")
    (row,) = decoded(spark, shape, "xyz,2020-01-02,2020-01-02T03:04:05Z,1.5,true")
    assert bytes(row[0]) == b"xyz" and str(row[1]) == "2020-01-02" and str(row[3]) == "1.500" and row[4] is True


def test_tsv(spark):
    assert decoded(spark, RecordShape("a int, b string", format="tsv"), "1\tx, y", "2\t") == [(1, "x, y"), (2, None)]


def test_text_keeps_whole_payload(spark):
    long = "line one\nline two " + "é" * 100_000
    rows = decoded(spark, RecordShape("message string", format="text"), long, b"a\xffb", "")
    assert rows == [(long,), ("a�b",), ("",)]


def test_raw(spark):
    rows = decoded(spark, RecordShape("body binary"), b"\x00\xff", None)
    assert [bytes(r[0]) for r in rows] == [b"\x00\xff", b""]
    assert decode_topic(messages(spark, b"a"), RecordShape("body binary", format="binary")).count() == 1


CLF = "host string, ident string, user string, time string, request string, status int, bytes bigint"


def test_clf(spark):
    time = "10/Oct/2000:13:55:36 -0700"
    rows = decoded(
        spark, RecordShape(CLF, format="clf"),
        f'127.0.0.1 - frank [{time}] "GET /a.gif HTTP/1.0" 200 2326',
        f'h - - [{time}] "GET /\\"q\\" HTTP/1.0" 404 - "http://ref" "agent x"',
        f'h i u [{time}] "GET /\x01 HTTP/1.0" 200 5\n',
        "not a log line",
        f'h - - [{time}] "{"GET /" + "a" * 50_000}" 200 1',
    )
    assert rows[:4] == [
        ("127.0.0.1", "-", "frank", time, "GET /a.gif HTTP/1.0", 200, 2326),
        ("h", "-", "-", time, 'GET /\\"q\\" HTTP/1.0', 404, None),
        ("h", "i", "u", time, "GET /\x01 HTTP/1.0", 200, 5),
        (None,) * 7,
    ]
    assert len(rows[4][4]) == 50_005


def test_clf_takes_any_of_its_fields(spark):
    line = '127.0.0.1 - frank [x] "GET / HTTP/1.0" 200 2326'
    assert decoded(spark, RecordShape("status int, host string", format="clf"), line) == [(200, "127.0.0.1")]


def test_syslog(spark):
    shape = RecordShape(
        "priority int, time string, host string, app string, pid int, message string", format="syslog"
    )
    rows = decoded(
        spark, shape,
        "<34>Oct 11 22:14:15 mymachine su: 'su root' failed\nfor lonvick",
        "<13>Feb  5 17:32:18 10.0.0.99 app[42]: hello",
        "Oct 11 22:14:15 no priority",
    )
    assert rows == [
        (34, "Oct 11 22:14:15", "mymachine", "su", None, "'su root' failed\nfor lonvick"),
        (13, "Feb  5 17:32:18", "10.0.0.99", "app", 42, "hello"),
        (None,) * 6,
    ]


def test_pattern_takes_the_first_match(spark):
    shape = RecordShape("k string, v int", format="grok", pattern=r"(?<name>[a-z]+)=(\d+)")
    rows = decoded(spark, shape, "x: a=1 b=2 tail", "a=99999999999", "\x01 c=3 d=4", "none", None)
    assert rows == [("a", 1), ("a", None), ("c", 3), (None, None), (None, None)]


def test_metadata_columns_in_declared_order(spark):
    shape = RecordShape(
        "o bigint, a int, k binary, p int, b string",
        format="csv", key_field="k", partition_field="p", offset_field="o",
    )
    (row,) = decoded(spark, shape, "7,x", key=b"key")
    assert row == (0, 7, bytearray(b"key"), 0, "x")
    (row,) = decoded(spark, shape, "7,x")
    assert row[2] == bytearray(b"")


def test_batch_has_no_batch_time(spark):
    shape = RecordShape("t bigint, b binary", time_field="t")
    with pytest.raises(ValueError):
        decode_topic(messages(spark, "x"), shape)
    assert decode_topic(messages(spark, "x"), shape, F.lit(5)).first().t == 5


@pytest.mark.parametrize(
    "schema, options, problem",
    [
        ("k string, b binary", {"key_field": "k"}, "Field 'k' for the key must be binary, but is string."),
        ("p bigint, b binary", {"partition_field": "p"}, "Field 'p' for the partition must be int, but is bigint."),
        ("o int, b binary", {"offset_field": "o"}, "Field 'o' for the offset must be bigint, but is int."),
        ("t timestamp, b binary", {"time_field": "t"}, "Field 't' for the time must be bigint, but is timestamp."),
        ("b binary", {"key_field": "k"}, "The schema has no field 'k' for the key."),
        ("k binary", {"key_field": "k"}, "no message field"),
        ("k bigint, b binary", {"key_field": "k", "time_field": "k"}, "Time and key cannot both be in field 'k'."),
        ("a binary, b binary", {}, "fill one message field, not 2 (a, b)"),
        ("a string", {}, "need a binary field, but a is string"),
        ("a string", {"format": "avro"}, "Unable to read messages of format 'avro'"),
        ("a string, b string", {"format": "text"}, "exactly one message field"),
        ("a string", {"format": "clf"}, "has no field a"),
        ("a string", {"format": "grok"}, "needs a pattern"),
        ("a string", {"format": "grok", "pattern": r"(\w)[(](?:x)(\()"}, "has 2 groups for 1 message fields"),
    ],
)
def test_shape_problems(spark, schema, options, problem):
    with pytest.raises(ShapeError, match="(?s).*") as error:
        RecordShape(schema, **options)
    assert problem in str(error.value)


def test_all_shape_problems_are_reported(spark):
    with pytest.raises(ShapeError) as error:
        RecordShape("k string, p string, a string", key_field="k", partition_field="p", offset_field="o")
    assert len(error.value.problems) == 4


def test_record_schema_json(spark):
    shape = RecordShape(
        """{"type":"record","name":"purchase","fields":[
            {"name":"key","type":"bytes"}, {"name":"user","type":["string","null"]},
            {"name":"count","type":"int"}, {"name":"price","type":"double"},
            {"name":"day","type":{"type":"int","logicalType":"date"}},
            {"name":"total","type":{"type":"bytes","logicalType":"decimal","precision":9,"scale":2}}]}""",
        format="csv", key_field="key",
    )
    assert [f.dataType.simpleString() for f in shape.schema] == [
        "binary", "string", "int", "double", "date", "decimal(9,2)",
    ]
    assert shape.schema["user"].nullable and not shape.schema["count"].nullable


def test_bodies(spark):
    rows = spark.createDataFrame(
        [(1, None, 2.5, 'q"x,y', None), (2, "b", 1e10, "", True)],
        "a int, b string, c double, `d.e` string, f boolean",
    )
    csv = [bytes(r.value).decode() for r in to_messages(rows, "t").collect()]
    assert csv == ['1,,2.5,q"x,y,', "2,b,1.0E10,,true"]
    assert [bytes(r.value) for r in to_messages(rows, "t", body="xml").collect()] == [c.encode() for c in csv]
    json = [bytes(r.value).decode() for r in to_messages(rows, "t", body="JSON").collect()]
    assert json[0] == '{"a":1,"b":null,"c":2.5,"d.e":"q\\"x,y","f":null}'


def test_keys(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    keyed = to_messages(rows.filter("k is not null"), "t", key="k").first()
    assert bytes(keyed.key) == b"a" and bytes(keyed.value) == b"a,1"
    assert to_messages(rows, "t").filter("key is null").count() == 2
    with pytest.raises(PySparkException, match="Null in the key field k"):
        to_messages(rows, "t", key="k").collect()
    with pytest.raises(ValueError, match="must be of type string"):
        to_messages(rows, "t", key="n")
