"""Typing of raw property text: dates, ranks, arrays and scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZONED = r"(Z|[+-]\d{2}:?\d{2})$"


def instant(text: Column) -> Column:
    """Text to a zone-free UTC timestamp; NULL where it is no date."""
    zoned = F.convert_timezone(
        None, F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    return F.when(text.rlike(_ZONED) & text.contains("T"), zoned).otherwise(
        text.try_cast("timestamp_ntz")
    )


def _scalar(text: Column, type_name: str) -> Column:
    if type_name == "string":
        return text
    if type_name.startswith("timestamp"):
        return instant(text)
    return text.try_cast(type_name)


def typed_value(text: Column, type_name: str) -> Column:
    """Raw text as ``type_name``; under ``array<...>`` a lone scalar becomes one element."""
    if not type_name.startswith("array<"):
        return _scalar(text, type_name)
    element = type_name[len("array<"):-1]
    parsed = F.when(
        F.ltrim(text).startswith("["), F.from_json(text, "array<string>")
    ).otherwise(F.when(text.isNotNull(), F.array(text)))
    return F.transform(parsed, lambda x: _scalar(x, element))
