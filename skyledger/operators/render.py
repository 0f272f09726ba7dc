"""Text rendering of records (the record's ``toString``)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.formatting import record_text
from ..schema import FIELD_NAMES


def render_records(records: DataFrame, text_col: str = "text") -> DataFrame:
    """Records' other columns plus ``text``: 21 fields, comma separated."""
    keep = [c for c in records.columns if c not in FIELD_NAMES]
    return records.select(*keep, record_text().alias(text_col))
