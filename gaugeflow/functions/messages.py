"""JSON message expressions: decode, metric extraction, encode."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strict JSON; only the tokens the format itself allows.
_JSON_OPTIONS = {
    "columnNameOfCorruptRecord": "_broken",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def decode(value, fields) -> Column:
    """One pass over the JSON text: every wanted field as text, `_broken` if unreadable.

    Fields stay text so that a number sent as a string survives.
    """
    wanted = ", ".join(f"`{field}` STRING" for field in fields)
    return F.from_json(value, f"{wanted}, _broken STRING", _JSON_OPTIONS)


def finite(number: Column) -> Column:
    """NULL in place of NaN and the infinities."""
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def metric_strict(text: Column) -> Column:
    """A finite number, or NULL."""
    return finite(text.try_cast("double"))


def metric_lenient(value: Column, field: str, text: Column) -> Column:
    """NULL only if the field is absent; anything that is no number counts as 0,
    and the booleans as 1 and 0."""
    as_boolean = F.try_variant_get(F.try_parse_json(value), f"$.{field}", "double")
    # The key list costs a second parse; most messages cannot hold the field.
    possible = value.contains(f'"{field}"') | value.contains("\\")
    present = possible & F.array_contains(F.json_object_keys(value), field)
    return F.when(
        text.isNotNull(), F.coalesce(text.try_cast("double"), as_boolean, F.lit(0.0))
    ).when(present, F.lit(0.0))


def encode(*columns) -> Column:
    """JSON text of the given columns; NULL fields are written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def nested_number(body, path: str) -> Column:
    """A number from inside a nested JSON document, e.g. `$.current.precipitation`."""
    return F.get_json_object(body, path).try_cast("double")
