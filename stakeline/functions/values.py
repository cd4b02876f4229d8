"""Numeric, cast and text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def convert(value: Column, target: str, strict: bool = True) -> Column:
    """Cast; malformed input fails the query, or becomes null where ``strict`` is off."""
    return value.cast(target) if strict else value.try_cast(target)


def all_digits(
    value: Column, cast: Column, given: T.DataType, kind: T.DecimalType
) -> Column:
    """``cast`` of a value to a decimal type, or an error where that takes digits off it."""
    # Other kinds of values are compared with as many places as a decimal has room for.
    places = 38 - (kind.precision - kind.scale)
    exact = value if isinstance(given, T.DecimalType) else value.cast(T.DecimalType(38, places))
    message = F.concat(value.cast("string"), F.lit(f" does not fit {kind.simpleString()}"))
    return F.when(exact != cast, F.raise_error(message).cast(kind)).otherwise(cast)


def int_floor(value: Column) -> Column:
    """Round towards minus infinity: -1.5 gives -2."""
    return F.floor(value).cast("long")


def floored_difference(a: Column, b: Column, money: T.DecimalType) -> Column:
    """``a - b``, at least 0, for two amounts of type ``money``.

    A digit is kept free, so the difference keeps the scale; amounts that need it are an error.
    """
    room = T.DecimalType(min(money.precision, 37), money.scale)
    zero = F.lit(0).cast(money)
    return F.greatest((a.cast(room) - b.cast(room)).cast(money), zero)


def json_list(order: tuple[Column, ...], value: Column, keep: Column) -> Column:
    """Aggregate: JSON text array of the kept values as strings, in the given order.

    The list is one output value per group, so a group's kept values meet in one task; rows
    that are not kept never leave the map side. No kept value gives ``[]``.
    """
    entry = F.when(
        keep, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], value.alias("value"))
    )
    ordered = F.array_sort(F.collect_list(entry))
    return F.to_json(F.transform(ordered, lambda e: e["value"].cast("string")))
