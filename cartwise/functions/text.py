"""Small string helpers for names and requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unknown_name(product_id: Column) -> Column:
    """Display name for an id missing from the catalog: ``Unknown(<id>)``."""
    return F.concat(F.lit("Unknown("), product_id.cast("string"), F.lit(")"))


def percent_text(share: Column, decimals: int = 2) -> Column:
    """A share as percent text, e.g. 0.1234 -> ``12.34%``."""
    return F.concat(F.format_string(f"%.{decimals}f", share.cast("double") * 100), F.lit("%"))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) == "", F.lit(None).cast("string")).otherwise(text)


def parse_request_token(token: Column) -> tuple[Column, Column]:
    """Split a typed request into (product_id, product_name): an integer id if it parses, else a name.

    Blank text resolves to nothing (both null). Only text that looks like an integer is cast: a failing
    cast costs an exception per row.
    """
    trimmed = F.trim(token)
    as_id = F.when(trimmed.rlike(r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"), trimmed.try_cast("bigint"))
    as_name = F.when(as_id.isNull() & (trimmed != ""), token)
    return as_id, as_name
