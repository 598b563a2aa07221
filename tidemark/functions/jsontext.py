"""JSON text: canonical form, hash, field access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A string literal, a number, or the text between them.
_TOKEN = r'"(?:[^"\\]++|\\.)*+"|-?\d++(?:\.\d++)?+(?:[eE][+-]?\d++)?+|[^"\d-]++|-'
_EXPONENT = r"^-?\d+(?:\.\d+)?[eE][+-]?\d+$"


def canonical_json(payload: Column) -> Column:
    """One text for all spellings of the same JSON value.

    Key order, white space, repeated keys (the last one wins) and number spellings
    (``2``, ``2.0``, ``2e0``) no longer matter. Text that is not JSON stays as it is.
    Numbers beyond the range of a decimal(38,10) keep the spelling that Spark gives them.
    """
    text = F.to_json(F.try_parse_json(payload))
    tokens = F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), _plain_number)
    plain = F.when(payload.rlike(r"\d[eE]"), F.array_join(tokens, "")).otherwise(text)
    return F.coalesce(plain, payload)


def _plain_number(token: Column) -> Column:
    """A number without exponent and without a ``.0`` at its end; any other token as it is."""
    wide = token.try_cast("double")
    value = wide.try_cast("decimal(38,10)")
    digits = F.regexp_replace(F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    # What ten places cannot hold would come back changed.
    exponent = token.rlike(_EXPONENT) & (value.cast("double") == wide)
    return F.when(exponent, digits).when(token.rlike(r"^-?\d+\.0$"), F.regexp_replace(token, r"\.0$", "")).otherwise(token)


def payload_hash(payload: Column) -> Column:
    """md5 of the canonical text, so that equal payloads hash alike.

    The digest differs from one over another system's own JSON text (which orders
    keys in its own way); which rows count as equal does not.
    """
    return F.md5(canonical_json(payload))


def field(payload: Column, name: str) -> Column:
    """One top-level field as text, NULL when absent or when the text is not JSON."""
    return F.get_json_object(payload, f"$['{name}']")
