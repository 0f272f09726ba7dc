"""Scalar column functions (all built-in Spark expressions)."""

from .formatting import RECORD_TEXT_SEPARATOR, record_text, set_label
from .parsing import (
    ARITY_PATTERN,
    RECORD_PATTERN,
    arity_ok,
    event_time,
    record_ok,
    split_fields,
    typed_field_sql,
)

__all__ = [
    "ARITY_PATTERN",
    "RECORD_PATTERN",
    "RECORD_TEXT_SEPARATOR",
    "arity_ok",
    "event_time",
    "record_ok",
    "record_text",
    "set_label",
    "split_fields",
    "typed_field_sql",
]
