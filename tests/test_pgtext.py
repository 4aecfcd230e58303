import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.functions import pgtext
from tideway.functions.schema import DATABASE_TYPES, field, portable
from tideway.sources import copytext


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def fails(spark, column):
    with pytest.raises(Exception):
        one(spark, column)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("{}", []),
        ("{1,2,3}", ["1", "2", "3"]),
        ('{"hello","world"}', ["hello", "world"]),
        ('{"hello world","foo bar"}', ["hello world", "foo bar"]),
        ("{1,NULL,3}", ["1", None, "3"]),
        ('{"NULL",null, a }', ["NULL", None, "a"]),
        (" {1,2} \n", ["1", "2"]),
        ("{a,}", ["a"]),
        ("{a,,}", ["a", ""]),
        ("{,a}", ["", "a"]),
        ("{,}", [""]),
        ("{ }", []),
        ('{"a" , "b" }', ["a", "b"]),
        (r'{"\\",",\""}', ["\\", ',"']),
        (r'{"say \"hi\""}', ['say "hi"']),
        ('{"a,b","c{d}"}', ["a,b", "c{d}"]),
        ("{" + "x" * 60_000 + "}", ["x" * 60_000]),
        (None, None),
    ],
)
def test_array(spark, text, expected):
    assert one(spark, pgtext.decode_array(F.lit(text).cast("string"), T.StringType())) == expected


def test_array_elements_and_errors(spark):
    assert one(spark, pgtext.decode(F.lit("{1,NULL}"), T.ArrayType(T.IntegerType()))) == [1, None]
    assert one(spark, pgtext.decode(F.lit("{2024-01-15}"), T.ArrayType(T.DateType()))) == [dt.date(2024, 1, 15)]
    for bad in ("1,2", "{{1,2},{3}}", '{"abc}', '{"a"b}', '{a,"b}', r'{"a\"}', "{1,2", ""):
        fails(spark, pgtext.decode_array(F.lit(bad), T.StringType()))


@pytest.mark.parametrize(
    "text, expected",
    [
        ('"k"=>"v"', {"k": "v"}),
        ('"a"=>"1", "b"=>"2"', {"a": "1", "b": "2"}),
        ('"k"=>NULL', {"k": None}),
        ('"k"=>null, "b"=>bare', {"k": None, "b": "bare"}),
        ('"k"=>"  "', {"k": "  "}),
        (r'"a,\"b"=>"x=>y, \\z"', {'a,"b': "x=>y, \\z"}),
        ('"k"=>"1", "k"=>"2"', {"k": "2"}),
        ('"z"=>1, "k"=>"1","a"=>"3" ,"k"=>NULL, "k"=>x y , "b"=>,', {"a": "3", "b": "", "k": "x y", "z": "1"}),
        ("", {}),
    ],
)
def test_hstore(spark, text, expected):
    assert json.loads(one(spark, pgtext.decode_hstore(F.lit(text)))) == expected


def test_hstore_errors(spark):
    for bad in ('"k"', '"k"=>"v', "k=>v", '"a"=>"1" "b"=>"2"'):
        fails(spark, pgtext.decode_hstore(F.lit(bad)))


def test_scalars(spark):
    assert one(spark, pgtext.decode(F.lit("2024-01-15 12:30:45.123456"), T.TimestampNTZType())) == dt.datetime(2024, 1, 15, 12, 30, 45, 123456)
    assert one(spark, pgtext.decode_timestamp(F.lit("2024-01-15 12:30:45.123456"), milliseconds=True)).microsecond == 123000
    assert one(spark, pgtext.decode_timestamp(F.lit("2024-01-15 12:30:45+02"), zone=True).cast("string")) == "2024-01-15 10:30:45"
    assert bytes(one(spark, pgtext.decode_bytea(F.lit("\\xdeadbeef")))) == b"\xde\xad\xbe\xef"
    assert [one(spark, pgtext.decode_bool(F.lit(x))) for x in ("t", "true", "f", "false")] == [True, True, False, False]
    assert one(spark, pgtext.decode(F.lit("-12"), T.LongType())) == -12
    fails(spark, pgtext.decode_bool(F.lit("yes")))
    fails(spark, pgtext.decode_bytea(F.lit("\\xabc")))
    fails(spark, pgtext.decode(F.lit("1x"), T.IntegerType()))
    for kind in (T.LongType(), T.BooleanType(), T.BinaryType(), T.ArrayType(T.LongType()), T.MapType(T.StringType(), T.StringType())):
        assert one(spark, pgtext.decode(F.lit(None).cast("string"), kind)) is None


def test_scalars_are_strict(spark):
    """What the database does not write raises, with ANSI casts and without."""
    bad = {
        T.IntegerType(): (" 12 ", "1.0", "", "2147483648", "0x1", "1e3", "１"), T.LongType(): ("9223372036854775808", "12L"), T.DoubleType(): ("1.5d", "1.5f", " 1", "", ".", "1e", "infinit"),
        T.DateType(): ("2024", "2024-02-30", "2024-1-5", " 2024-01-05"), T.TimestampNTZType(): ("2024", "2024-01-15", "2024-01-15 12:30:45+02", "2024-01-15T12:30:45", "2024-01-15 25:00:00"), T.TimestampType(): ("2024-01-15 12:30", "epoch"),
    }
    good = [("+7", T.IntegerType(), 7), ("-9223372036854775808", T.LongType(), -(2**63)), ("1e3", T.DoubleType(), 1000.0), (".5", T.FloatType(), 0.5), ("5.", T.DoubleType(), 5.0), ("-Infinity", T.DoubleType(), float("-inf")), ("inf", T.FloatType(), float("inf"))]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for kind, texts in bad.items():
                for text in texts:
                    fails(spark, pgtext.decode(F.lit(text), kind))
            for text, kind, value in good:
                assert one(spark, pgtext.decode(F.lit(text), kind)) == value
            nan = one(spark, pgtext.decode(F.lit("NaN"), T.DoubleType()))
            assert nan != nan
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_many_pairs_and_copy_escapes(spark):
    text = ", ".join(f'"k{i % 15_000}"=>"{i}"' for i in range(20_000))
    got = json.loads(one(spark, pgtext.decode_hstore(F.lit(text))))
    assert len(got) == 15_000 and got["k3"] == "15003" and got["k14999"] == "14999"
    cells = [(r"a\\tb", r"a\tb"), (r"\b\f\v\t\n\r", "\b\f\v\t\n\r"), (r"\x41\101\q\.", "AAq."), ("\0x", "\0x"), ("\\", "")]
    for cell, value in cells:
        assert one(spark, pgtext.unescape(F.lit(cell))) == value
    fails(spark, pgtext.unescape(F.lit(r"\xe9")))


def test_types():
    assert field("a", "int4[]").dataType == T.ArrayType(T.IntegerType())
    assert field("h", "hstore").metadata == {"source_type": "hstore"}
    assert field("t", "text").dataType == T.StringType() and field("n", "numeric").dataType == T.StringType()
    assert DATABASE_TYPES["float8"] == T.DoubleType()
    assert portable(T.ShortType()) == T.IntegerType() and portable(T.DecimalType(9, 2)) == T.StringType()


def test_copy_lines(spark):
    df = spark.createDataFrame([(1, "a\tb"), (2, None)], "id bigint, name string")
    assert [r["line"] for r in copytext.render(df).collect()] == ["1\ta\\tb", "2\t\\N"]
    ok = spark.createDataFrame([(True,), (False,)], "ok boolean")
    assert [r["line"] for r in copytext.render(ok).collect()] == ["t", "f"]


def test_copy_round_trip(spark, tmp_path):
    rows = [(i, s, [s, None], dt.date(2024, 1, 1 + i), bytearray((s or "").encode())) for i, s in enumerate(["", "\\", "\\N", "\t", "a\nb\r\n", 'q"{}', "\\t", None])]
    df = spark.createDataFrame(rows, "i int, s string, a array<string>, d date, b binary")
    copytext.write(df, str(tmp_path / "x"))
    assert sorted(copytext.read(spark, str(tmp_path / "x"), df.schema).collect()) == sorted(df.collect())
    with pytest.raises(Exception):
        copytext.parse(spark.createDataFrame([("1\t2",)], "line string"), df.schema).collect()


def test_instants_keep_their_offset(spark):
    """Encoded under one session's zone and decoded under another's, across both changes of summer time."""
    micros = [int(dt.datetime(2024, m, d, h, 30, tzinfo=dt.UTC).timestamp()) * 1_000_000 + 7 for m, d in ((3, 10), (11, 3), (3, 31), (10, 27)) for h in range(24)] + [-1, -62_135_596_800_000_000 + 1]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(m,) for m in micros], "m long")
        text = [tuple(r) for r in df.select("m", pgtext.encode(F.timestamp_micros("m"), T.TimestampType())).collect()]
        assert dict(text)[micros[0]] == "2024-03-10 00:30:00.000007+00"
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        back = spark.createDataFrame(text, "m long, t string").select("m", F.unix_micros(pgtext.decode(F.col("t"), T.TimestampType())).alias("n")).collect()
        assert all(r["m"] == r["n"] for r in back)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
