"""C11: scalar extraction from JSON text.

A text is parsed once, into a variant, and its fields are typed paths into that
value.  A scalar extractor must return NULL where the path points at an object
or array (JSON_VALUE semantics), although a variant would give their text.
Malformed JSON yields NULL; so does an object that names a field twice.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.casts import text_to_double, text_to_int
from strata.functions.util import as_col


NO_OFFSET = r"^\d+(-\d+(-\d+)?)?([T ]\d+(:\d+(:\d+(\.\d*)?)?)?)?$"


def with_variant(df: DataFrame, col: str, name: str) -> DataFrame:
    """``df`` with the variant of its JSON text; a filter on fields that is pushed down does not parse again.

    The value comes from a one-row generator, which filters cannot pass.
    """
    return df.select("*", F.inline(F.array(F.struct(F.try_parse_json(as_col(col)).alias(name)))))


def variant_scalar(variant, path: str) -> Column:
    """The scalar at ``path`` as text; NULL for an object, an array, a JSON null or no value."""
    value = as_col(variant)
    text = F.try_variant_get(value, path, "string")
    nested = F.schema_of_variant(F.try_variant_get(value, path, "variant")).rlike("^(OBJECT|ARRAY)")
    return F.when(~((text.startswith("{") | text.startswith("[")) & nested), text)  # a text may begin with a bracket, too


def json_scalar(col, path: str) -> Column:
    return variant_scalar(F.try_parse_json(as_col(col)), path)


def json_int(col, path: str) -> Column:
    return text_to_int(json_scalar(col, path))


def json_double(col, path: str) -> Column:
    return text_to_double(json_scalar(col, path))


def text_to_timestamp(text: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP, read as UTC without an offset (in any session time zone); bad text -> NULL."""
    text = F.trim(text)
    utc = F.concat(text.try_cast("timestamp_ntz").cast("string"), F.lit("Z"))
    return F.try_to_timestamp(F.when(text.rlike(NO_OFFSET), utc).otherwise(text))


def json_timestamp(col, path: str) -> Column:
    return text_to_timestamp(json_scalar(col, path))
