"""Parse feed lines into typed records, setting bad lines aside.

One anchored pattern decides whether a line is a record; the projection
splits accepted lines once and casts the nine numeric fields.  Records and
rejects are two filters of the same parse, built only when asked for.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property, lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import arity_ok, record_ok, typed_field_sql
from ..schema import FIELD_NAMES

REASON_ARITY = "arity"
REASON_NUMBER = "number"


def _good(line: Column) -> Column:
    """Whether the line is a record; a null line is not."""
    return F.coalesce(record_ok(line), F.lit(False))


def _bad_reason(line: Column) -> Column:
    """Why a line that is no record is none; a null line has no fields."""
    has_fields = F.coalesce(arity_ok(line), F.lit(False))
    return F.when(has_fields, F.lit(REASON_NUMBER)).otherwise(F.lit(REASON_ARITY))


def _reason(line: Column, on_error: str = "reject") -> Column:
    bad = _bad_reason(line)
    if on_error == "fail":
        bad = F.raise_error(_failure(line))
    return F.when(_good(line), F.lit(None).cast("string")).otherwise(bad)


def _failure(line: Column) -> Column:
    text = F.coalesce(line, F.lit("null"))
    return F.concat(F.lit("bad feed line ("), _bad_reason(line), F.lit("): "), text)


def _check_mode(on_error: str) -> None:
    if on_error not in ("reject", "fail"):
        raise ValueError("on_error must be 'reject' or 'fail'")


def _passthrough(columns: list[str], line_col: str) -> list[str]:
    return [c for c in columns if c not in FIELD_NAMES and c not in (line_col, "reason")]


def _quoted(names: Iterable[str]) -> list[str]:
    return [f"`{c}`" for c in names]


class Parsed:
    """Typed records plus the lines that failed, with a reason.

    ``records`` keeps the input's other columns (line number, batch key, ...)
    and adds the 21 typed fields.  ``rejects`` keeps the input columns and
    adds ``reason``: ``arity`` for fewer than 21 fields (a null line has none), else ``number``.
    ``parsed`` is every line with its typed fields and reason.
    """

    def __init__(self, lines: DataFrame, line_col: str = "line", on_error: str = "reject"):
        _check_mode(on_error)
        self.lines = lines
        self.line_col = line_col
        self.on_error = on_error

    @cached_property
    def records(self) -> DataFrame:
        line = F.col(self.line_col)
        if self.on_error == "fail":
            good = F.when(_good(line), F.lit(True)).otherwise(F.raise_error(_failure(line)))
        else:
            good = _good(line)
        extra = _passthrough(self.lines.columns, self.line_col)
        # The accept filter reads only the line, so it runs before the split.
        return self.lines.filter(good).selectExpr(
            *_quoted(extra), *typed_field_sql(f"`{self.line_col}`")
        )

    @cached_property
    def parsed(self) -> DataFrame:
        return parse_lines(self.lines, self.line_col)

    @cached_property
    def rejects(self) -> DataFrame:
        line = F.col(self.line_col)
        extra = _passthrough(self.lines.columns, self.line_col)
        # One pattern match per line; only rejected lines get the arity test.
        return self.lines.filter(~_good(line)).select(*extra, line, _bad_reason(line).alias("reason"))


def parse_lines(
    lines: DataFrame, line_col: str = "line", keep_good_lines: bool = True, on_error: str = "reject"
) -> DataFrame:
    """All input columns, the 21 typed fields and ``reason`` (null if good).

    ``keep_good_lines=False`` nulls the raw text of accepted lines: only
    rejects need it, and it is the widest column of a persisted or written
    parse.  ``on_error="fail"`` makes the first bad line fail the job.
    """
    _check_mode(on_error)
    keep = [c for c in lines.columns if c not in FIELD_NAMES]
    typed = lines.selectExpr(*_quoted(keep), *typed_field_sql(f"`{line_col}`"))
    reason = _reason_column(line_col, on_error, SparkContext._jvm)
    if keep_good_lines:
        return typed.withColumn("reason", reason)
    return typed.withColumns(
        {"reason": reason, line_col: F.when(reason.isNotNull(), F.col(line_col))}
    )


@lru_cache(maxsize=8)
def _reason_column(line_col: str, on_error: str, jvm: object) -> Column:
    """Built once for a JVM, as it has many parts and is the same for every micro-batch."""
    return _reason(F.col(line_col), on_error)


def parse_records(lines: DataFrame, line_col: str = "line", on_error: str = "reject") -> Parsed:
    """Split ``lines`` into records and rejects (see ``Parsed``).

    ``on_error="fail"`` makes the first bad line fail the job instead, as the
    reference's parser does.
    """
    return Parsed(lines, line_col, on_error)


class _SplitParsed(Parsed):
    def __init__(self, parsed: DataFrame, line_col: str = "line"):
        self._parsed = parsed
        self.line_col = line_col

    @cached_property
    def parsed(self) -> DataFrame:
        return self._parsed

    @cached_property
    def records(self) -> DataFrame:
        extra = _passthrough(self._parsed.columns, self.line_col)
        good = self._parsed.filter("reason IS NULL")
        return good.selectExpr(*_quoted(extra), *_quoted(FIELD_NAMES))

    @cached_property
    def rejects(self) -> DataFrame:
        extra = _passthrough(self._parsed.columns, self.line_col)
        return self._parsed.filter(F.col("reason").isNotNull()).select(
            *extra, self.line_col, "reason"
        )


def split_parsed(parsed: DataFrame, line_col: str = "line") -> Parsed:
    """Records and rejects of an already parsed (e.g. persisted) frame."""
    return _SplitParsed(parsed, line_col)
