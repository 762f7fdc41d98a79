"""Column helpers over JSON text and VARIANT values; all JVM-side, none raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_part(doc: Column, path: str) -> Column:
    """Sub-value as VARIANT; SQL NULL when absent, a JSON null stays a (non-NULL) variant."""
    return F.try_variant_get(doc, path, "variant")


def json_type(value: Column) -> Column:
    """Exact JSON type name, e.g. BIGINT, DECIMAL(3,1), STRING, OBJECT<...>; NULL when absent."""
    return F.schema_of_variant(value)


def is_json_container(value: Column) -> Column:
    kind = F.coalesce(json_type(value), F.lit(""))
    return F.startswith(kind, F.lit("OBJECT<")) | F.startswith(kind, F.lit("ARRAY<"))


def _looks_nested(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def blank_container(text: Column, value: Column) -> Column:
    """`text` of a JSON value, made empty when the value is an object or array.

    The JSON type is looked up only for text that looks like a rendered container.
    """
    return F.when(_looks_nested(text) & is_json_container(value), F.lit("")).otherwise(text)


def json_text(doc: Column, path: str) -> Column:
    """Scalar as text; NULL when absent or JSON null, empty text for objects and arrays."""
    return blank_container(F.try_variant_get(doc, path, "string"), json_part(doc, path))


def json_double(doc: Column, path: str) -> Column:
    """Number, numeric text or boolean as DOUBLE; NULL (never NaN) when it is none of these."""
    return F.nanvl(F.try_variant_get(doc, path, "double"), F.lit(None).cast("double"))


def truncated_int(number: Column, default: int = -1) -> Column:
    return F.coalesce(number.try_cast("int"), F.lit(default))


def json_int(doc: Column, path: str, default: int = -1) -> Column:
    """Number truncated towards zero, `default` when there is none."""
    return truncated_int(json_double(doc, path), default)


def is_number_type(kind: Column) -> Column:
    """Native JSON number or boolean (numeric text does not count)."""
    kind = F.coalesce(kind, F.lit(""))
    return kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL(")


def is_integer_type(kind: Column) -> Column:
    return F.coalesce(kind, F.lit("")).isin("BIGINT", "BOOLEAN")


def is_json_number(doc: Column, path: str) -> Column:
    return is_number_type(json_type(json_part(doc, path)))


def payload_kind(value: Column) -> Column:
    """`object`, `array`, `string`, `other` or `null` by the parsed payload, NULL without one."""
    kind = json_type(value)
    return (
        F.when(kind.startswith("OBJECT<"), F.lit("object"))
        .when(kind.startswith("ARRAY<"), F.lit("array"))
        .when(kind == "STRING", F.lit("string"))
        .when(kind == "VOID", F.lit("null"))
        .when(kind.isNotNull(), F.lit("other"))
    )


def quoted(text: Column) -> Column:
    """Text as a JSON string."""
    wrapped = F.to_json(F.array(text))
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


def payload_json(kind: Column, text: Column) -> Column:
    """Payload as JSON text in its original key order, `{}` when there is no such key."""
    return (
        F.when(kind.isNull(), F.lit("{}"))
        .when(kind == "null", F.lit("null"))
        .when(kind == "string", quoted(text))
        .otherwise(text)
    )


def canonical_json(raw: Column) -> Column:
    """JSON text with object keys in sorted order (the VARIANT layout keeps keys sorted)."""
    return F.to_json(F.try_parse_json(raw))
