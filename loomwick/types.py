"""Types from short texts, without a session (Spark's own DDL parser needs one)."""

from __future__ import annotations

from pyspark.sql import types as T

_PLAIN = {
    "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(), "binary": T.BinaryType(), "array<string>": T.ArrayType(T.StringType()), "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def struct(text: str) -> T.StructType:
    """``name type, name type``; the types are those of this module's table."""
    fields = [field.split(" ") for field in text.split(", ")]
    return T.StructType([T.StructField(name, _PLAIN[kind]) for name, kind in fields])


def plain(kind: str) -> T.DataType:
    return _PLAIN[kind]
