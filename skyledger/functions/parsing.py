"""Column expressions that parse feed lines with Java number grammar.

Everything here is a built-in Spark expression (``rlike``, ``split``,
``try_cast``), so parsing stays inside whole-stage codegen.

A line is accepted when

* splitting it on ``;`` and dropping trailing empty fields leaves at least
  21 fields (the arity rule), and
* every numeric field parses: integers as an optional sign plus decimal
  digits inside the 32-bit range, floats in Java's decimal or hexadecimal
  notation with optional blank padding, ``NaN`` or ``Infinity``.

One anchored pattern over the first 20 fields decides both, including the
integer range, so the accept filter never needs the typed values: Catalyst
pushes filters below projections, and a filter on the casts would split the
line once per numeric field.  ``try_cast`` alone would also be too lenient
(it trims blanks around integers and takes ``nan``/``inf``).  For every
line the pattern accepts, ``try_cast`` gives Java's value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import N_FIELDS, RECORD_FIELDS, SEPARATOR

INT_MAX = 2**31 - 1


def digits_at_most(bound: int) -> str:
    """Pattern for numbers with as many digits as ``bound`` and <= ``bound``.

    Built digit by digit: a smaller digit at position k followed by any
    digits, or the bound's own digit and the rule again for the rest.
    """
    text = str(bound)
    alternatives = []
    for k, ch in enumerate(text):
        low = 1 if k == 0 else 0
        high = int(ch) - 1
        if high >= low:
            rest = len(text) - k - 1
            digit = str(low) if low == high else "[%d-%d]" % (low, high)
            tail = "[0-9]{%d}" % rest if rest > 1 else "[0-9]" * rest
            alternatives.append(text[:k] + digit + tail)
    alternatives.append(text)
    return "(?:%s)" % "|".join(alternatives)


def int_grammar(max_value: int = INT_MAX) -> str:
    """Java ``Integer.parseInt`` grammar (ASCII digits) within the int range."""
    short = "[0-9]{1,%d}" % (len(str(max_value)) - 1)
    positive = r"\+?0*(?:%s|%s)" % (short, digits_at_most(max_value))
    negative = r"-0*(?:%s|%s)" % (short, digits_at_most(max_value + 1))
    return "(?:%s|%s)" % (positive, negative)


# Grammar of one field of each kind (Java regex, no separator inside).
INT_GRAMMAR = int_grammar()
_DECIMAL = r"(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+[fFdD]?+"
# Its exponent, of two, must be there.  The cast rounds it as Java does: to the nearest float, ties to even.
_HEXADECIMAL = r"0[xX](?:[0-9a-fA-F]++\.?+[0-9a-fA-F]*+|\.[0-9a-fA-F]++)[pP][+-]?+[0-9]++[fFdD]?+"
FLOAT_GRAMMAR = (
    r"[\x00-\x20]*+[+-]?+" + f"(?:NaN|Infinity|{_DECIMAL}|{_HEXADECIMAL})" + r"[\x00-\x20]*+"
)
STRING_GRAMMAR = r"[^;]*+"

_GRAMMAR = {"int": INT_GRAMMAR, "float": FLOAT_GRAMMAR, "string": STRING_GRAMMAR}

# After the last separator that the arity rule needs, a non-separator must
# follow somewhere: the same as "split drops trailing empties, >= 21 remain".
_TAIL = r";*+[^;]"
ARITY_PATTERN = r"^(?:[^;]*+;){%d}%s" % (N_FIELDS - 1, _TAIL)

# Every field before the last one by its own grammar, then the arity tail.
# Each field and its separator form an atomic group: once a field has
# matched up to its separator the engine never comes back into it, and the
# possessive quantifiers (``*+``, ``++``) skip backtracking inside floats
# and strings.  Integers keep plain quantifiers, since ``0*`` may have to
# give back a zero.
RECORD_PATTERN = (
    "^"
    + "".join("(?>%s;)" % _GRAMMAR[kind] for _, kind in RECORD_FIELDS[:-1])
    + _TAIL
)


def split_fields(line: Column) -> Column:
    """Fields of a line; trailing empty fields are kept (limit -1)."""
    return F.split(line, SEPARATOR, -1)


def arity_ok(line: Column) -> Column:
    return line.rlike(ARITY_PATTERN)


def record_ok(line: Column) -> Column:
    """True when the line parses: arity rule and number grammar in one match."""
    return line.rlike(RECORD_PATTERN)


def typed_field_sql(line_sql: str) -> list[str]:
    """SQL expressions of the 21 typed record columns of a line expression.

    One ``selectExpr`` call instead of dozens of Column calls keeps the
    driver-side plan building short; the expressions are the same.
    """
    fields = f"split({line_sql}, '{SEPARATOR}', -1)"
    out = []
    for i, (name, kind) in enumerate(RECORD_FIELDS):
        raw = f"get({fields}, {i})"
        value = raw if kind == "string" else f"try_cast({raw} AS {kind})"
        out.append(f"{value} AS `{name}`")
    return out


# Fixed value: text form of the record's timestamp field, which ends in Z.
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"


def event_time(text: Column) -> Column:
    """The ``timestamp`` text as a timestamp, null when malformed.

    The record keeps the text; this is the optional typed form for
    event-time work.  ``Z`` is read as UTC, whatever the session's zone.
    """
    return F.when(text.endswith("Z"), F.try_to_timestamp(text, F.lit(TIMESTAMP_PATTERN)))
