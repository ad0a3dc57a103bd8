"""JSON payloads as VARIANT values: built from columns, stored in parquet, read by path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload(**fields: Column | str) -> Column:
    """A VARIANT object of the given fields; a NULL field is left away, as JSON has it."""
    columns = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in fields.items()]
    return F.parse_json(F.to_json(F.struct(*columns)))


def payload_field(column: Column | str, path: str, kind: str) -> Column:
    """The value at a path such as ``$.pay.amount``; NULL if it is not there or is of another kind."""
    return F.try_variant_get(column, path, kind)
