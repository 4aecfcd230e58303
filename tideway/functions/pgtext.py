r"""Column builders for the text forms of a relational database: decode (text to typed), encode (typed to text).

All are compositions of built-in expressions; NULL in gives NULL out, and a value that does
not parse raises. Array text has one dimension. In hstore text the last of equal keys wins.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACES = " \t\n\x0b\x0c\r"
_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_ITEM = rf"(?s), *({_QUOTED}|[^,]*+)"
_PAIR = rf"\s*+({_QUOTED})\s*+=>\s*+({_QUOTED}|[^\",][^,]*+|)\s*+"
_ESCAPES = (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
#: The one-letter escapes of COPY text.
_LETTERS = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
_INTEGER = r"^[+-]?[0-9]++$"
_FLOAT = r"^[+-]?(?:(?i:inf|infinity|nan)|(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?)$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?"
_ZONE = r"(?:[+-][0-9]{2}(?::?[0-9]{2}){0,2})?"


def _raise(ok: Column, value: Column, text: Column, what: str) -> Column:
    """value, NULL where text is NULL, an error where ok is false."""
    return F.when(text.isNull(), F.lit(None)).when(ok, value).otherwise(F.raise_error(F.concat(F.lit(f"invalid {what}: "), text)))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once for all its uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _trim(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACES))


def _strict(text: Column, pattern: str, kind: str) -> Column:
    """text as kind; what the pattern does not take, or the type has no room for, raises with any setting of the session."""
    value = text.try_cast(kind)
    return _raise(F.regexp_like(text, F.lit(pattern)) & value.isNotNull(), value, text, kind)


def _unquote(item: Column) -> Column:
    inner = F.substr(item, F.lit(2), F.length(item) - 2)
    return F.regexp_replace(inner, r"(?s)\\(.)", "$1")


def decode_bool(text: Column) -> Column:
    return F.when(text.isin("t", "true"), True).when(text.isin("f", "false"), False).when(text.isNotNull(), F.raise_error(F.concat(F.lit("invalid boolean: "), text)).cast("boolean"))


def decode_bytea(text: Column) -> Column:
    """Hex with an optional \\x before it."""
    digits = F.regexp_replace(text, r"^\\x", "")
    return _raise(F.regexp_like(digits, F.lit("^(?:[0-9A-Fa-f]{2})*+$")), F.unhex(digits), text, "bytea")


def decode_timestamp(text: Column, zone: bool = False, milliseconds: bool = False) -> Column:
    """Without a zone by default; microseconds are kept unless milliseconds are asked for."""
    kind = "timestamp" if zone else "timestamp_ntz"
    value = _strict(text, _TIMESTAMP + (_ZONE if zone else "") + "$", kind)
    return F.date_trunc("MILLISECOND", value).cast(kind) if milliseconds else value


def decode_array(text: Column, element: T.DataType) -> Column:
    """{a,"b c",NULL} to an array; an unquoted NULL in any case is null; spaces around the text, and a comma after the last item, are dropped.

    Text that is not in braces, more dimensions, a quote that is not closed, and text behind a closed quote raise.
    """
    trimmed = _trim(text)
    inner = F.substr(trimmed, F.lit(2), F.length(trimmed) - 2)
    bare = F.regexp_replace(inner, f"(?s)(^|,) *{_QUOTED} *(?=,|$)", "$1")
    fine = F.regexp_like(trimmed, F.lit(r"(?s)^\{.*\}$")) & ~F.regexp_like(bare, F.lit(r'[{}]|(?:^|,) *"'))

    def item(x: Column) -> Column:
        t = _trim(x)
        return F.when(F.startswith(t, F.lit('"')), _unquote(t)).when(F.upper(t) == "NULL", F.lit(None)).otherwise(t)

    # each item has a comma before it, and so no match is empty
    items = F.regexp_extract_all(F.concat(F.lit(","), F.regexp_replace(inner, ", *$", "")), F.lit(_ITEM), F.lit(1))
    items = F.when(_trim(inner) == "", F.array().cast("array<string>")).otherwise(F.transform(items, item))
    return F.transform(_raise(fine, items, text, "array"), lambda x: decode(x, element))


def decode_hstore_map(text: Column) -> Column:
    """"k"=>"v", ... to map<string, string>, by key; an unquoted NULL in any case is null; bare values run to the comma; a comma may end the text."""
    fine = F.regexp_like(text, F.lit(rf"(?s)^(?:\s*+|{_PAIR}(?:,{_PAIR})*+(?:,\s*+)?)$"))
    keys = F.transform(F.regexp_extract_all(text, F.lit(f"(?s){_PAIR}"), F.lit(1)), _unquote)

    def value(v: Column) -> Column:
        t = _trim(v)
        return F.when(F.startswith(t, F.lit('"')), _unquote(t)).when(F.upper(t) == "NULL", F.lit(None)).otherwise(t)

    values = F.transform(F.regexp_extract_all(text, F.lit(f"(?s){_PAIR}"), F.lit(2)), value)
    # sorted with the last of equal keys first, so that one pass finds it
    pairs = F.array_sort(F.transform(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda p, i: F.struct(p["k"].alias("k"), (-i).alias("i"), p["v"].alias("v"))))
    last = _let(pairs, lambda s: F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1)["k"] != e["k"])))
    return _raise(fine, F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"]))), text, "hstore")


def decode_hstore(text: Column) -> Column:
    """hstore text to JSON text, nulls kept."""
    return F.to_json(decode_hstore_map(text), {"ignoreNullFields": "false"})


def decode(text: Column, kind: T.DataType) -> Column:
    """text as kind, by the database's rules for text forms."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.ShortType, T.IntegerType, T.LongType)):
        return _strict(text, _INTEGER, kind.simpleString())
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return _strict(text, _FLOAT, kind.simpleString())
    if isinstance(kind, T.BooleanType):
        return decode_bool(text)
    if isinstance(kind, T.DateType):
        return _strict(text, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "date")
    if isinstance(kind, T.TimestampNTZType):
        return decode_timestamp(text)
    if isinstance(kind, T.TimestampType):
        return decode_timestamp(text, zone=True)
    if isinstance(kind, T.BinaryType):
        return decode_bytea(text)
    if isinstance(kind, T.ArrayType):
        return decode_array(text, kind.elementType)
    if isinstance(kind, T.MapType):
        return decode_hstore_map(text)
    raise TypeError(f"no text form for {kind.simpleString()}")


def decode_row(columns: dict[str, Column], schema: T.StructType) -> list[Column]:
    """One decoded column per field of schema, from its text in columns."""
    return [decode(columns[f.name], f.dataType).alias(f.name, metadata=f.metadata) for f in schema]


def _quote_item(x: Column) -> Column:
    escaped = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.coalesce(F.concat(F.lit('"'), escaped, F.lit('"')), F.lit("NULL"))


def encode(value: Column, kind: T.DataType) -> Column:
    """value of kind as the database's text form."""
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return value.cast("string")
    if isinstance(kind, T.BooleanType):
        return F.when(value, "t").when(~value, "f")
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, T.TimestampNTZType):
        return value.cast("string")
    if isinstance(kind, T.TimestampType):  # in UTC, with its offset: the session's zone plays no part
        seconds = (F.unix_micros(value).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.concat((start + F.make_dt_interval(secs=seconds)).cast("string"), F.lit("+00"))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(value)))
    if isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda x: _quote_item(encode(x, kind.elementType)))
        return F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}"))
    raise TypeError(f"no text form for {kind.simpleString()}")


def escape(text: Column) -> Column:
    """A cell of COPY text: backslash first, then tab, line feed and carriage return."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, code in _ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescape(cell: Column) -> Column:
    r"""The inverse of escape, and the other escapes of the format: \b \f \v, \x and one or two hex digits, one to three octal digits (ASCII ones); any other escaped character stands for itself."""

    def plain(part: Column) -> Column:
        letter = F.substr(part, F.lit(2))
        number = F.when(F.regexp_like(letter, F.lit("^x[0-9A-Fa-f]")), F.conv(F.substr(letter, F.lit(2)), 16, 10)).when(F.regexp_like(letter, F.lit("^[0-7]")), F.conv(letter, 8, 10)).cast("int")
        out = F.when(number < 128, F.char(number)).when(number.isNotNull(), F.raise_error(F.concat(F.lit("an escaped byte beyond ASCII: "), part)))
        for code, char in _LETTERS.items():
            out = out.when(letter == code, F.lit(char))
        return F.when(F.startswith(part, F.lit("\\")), out.otherwise(letter)).otherwise(part)

    parts = F.regexp_extract_all(cell, F.lit(r"(?s)[^\\]++|\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}|\\.|\\$"), F.lit(0))
    return F.when(F.contains(cell, F.lit("\\")), F.array_join(F.transform(parts, plain), "")).otherwise(cell)
