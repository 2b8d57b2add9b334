"""Schemas for reading JSON payloads field by field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.text import typed

# output column -> (dotted path in the JSON object, Spark type)
Fields = dict[str, tuple[str, str]]


def text_schema(paths: list[str]) -> T.StructType:
    """Struct holding each dotted path as text.

    Scalars are read as text and cast afterwards, so a number that arrives
    quoted still casts, and a bad one fails the cast instead of turning NULL.
    """
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(name, build(child) if child else T.StringType()) for name, child in node.items()]
        )

    return build(tree)


def pick(record: str, fields: Fields, strict: bool) -> list[Column]:
    return [
        typed(F.col(f"{record}.{path}"), data_type, strict).alias(name)
        for name, (path, data_type) in fields.items()
    ]


# One value between two brackets, and after a key, each with a mark that is only reached if nothing else stands there.
_IN_ARRAY = T.StructType([T.StructField("v", T.ArrayType(T.StringType())), T.StructField("end", T.IntegerType())])
_AFTER_KEY = T.StructType([T.StructField("end", T.IntegerType())])
_STRICT = {"maxStringLen": str(2**31 - 1), "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value of any size; repeated keys are allowed.

    A text that closes the array around it to write more than one value is
    malformed after a key, and the other way round, so it takes both parses.
    """
    array = F.from_json(F.concat(F.lit('{"v":['), text, F.lit('],"end":1}')), _IN_ARRAY, _STRICT)
    value = F.from_json(F.concat(F.lit('{"v":'), text, F.lit(',"end":1}')), _AFTER_KEY, _STRICT)
    return F.coalesce((F.size(array["v"]) == 1) & (array["end"] == 1) & (value["end"] == 1), F.lit(False))


def starts_like_object(text: Column) -> Column:
    """Whether a text that is known to be JSON is an object."""
    return F.regexp(text, F.lit(r"\A[ \t\r\n]*\{"))


def is_json_object(text: Column) -> Column:
    return starts_like_object(text) & is_json(text)
