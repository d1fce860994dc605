"""Acceptance rules and field access for raw JSON response bodies.

Bodies are read with Spark's JSON functions.  On well-formed JSON the rules
equal the original job's (Python ``json`` plus ``dict`` access): key presence
with a null value, rejecting values, duplicate keys (the last one wins),
whitespace, key case and escapes were compared case by case.  Field values
that are not strings come back as JSON text (``true``, ``{"a":1}``).  On
malformed text the two parsers differ at the margins (Python also accepts
``NaN``, and rejects trailing text after the object and single quotes); the
services answer with JSON or with an error page, and an error page is not
an object for either.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.fixed_values import ACCEPT_KEY, ADDRESS_FIELDS, PROVIDERS

ADDRESS_STRUCT = T.StructType([T.StructField(n, T.StringType(), True) for n in ADDRESS_FIELDS])


def _as_col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_object(body) -> Column:
    """True only for a JSON object; arrays, scalars, broken text and null are not."""
    return F.json_object_keys(_as_col(body)).isNotNull()


def has_key(body, key: str = ACCEPT_KEY) -> Column:
    """The object has the key, whatever its value (a null value still counts)."""
    return F.coalesce(F.array_contains(F.json_object_keys(_as_col(body)), F.lit(key)), F.lit(False))


def provider_rule(provider: str):
    for name, field, value in PROVIDERS:
        if name == provider:
            return field, value
    raise ValueError(f"unknown provider {provider!r}")


def provider_accepts(body, provider: str) -> Column:
    """Single-provider rule: the rejecting field is absent, null or another value."""
    field, value = provider_rule(provider)
    found = F.get_json_object(_as_col(body), f"$.{field}")
    rule = found.isNull() if value is None else ~found.eqNullSafe(F.lit(value))
    return is_object(body) & rule


def address_fields(body) -> Column:
    return F.from_json(_as_col(body), ADDRESS_STRUCT)
