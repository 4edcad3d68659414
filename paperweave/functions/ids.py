"""Entity URL -> numeric id, as a Column expression (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT_ID = -1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_oa_id(url: Column | str, on_bad: str = "null") -> Column:
    """Numeric id of an entity URL such as ``https://.../W2741809807``.

    Takes the text after the last ``/``, drops one leading letter (any
    alphabet, the entity tag is not checked), and reads the rest as a bigint.
    A null URL gives -1. Text that is not a number gives null when
    ``on_bad="null"`` (callers drop it as an invalid id) or fails the query
    when ``on_bad="fail"``.
    """
    u = _col(url)
    tail = F.substring_index(u, "/", -1)
    # no text without a digit reaches the cast in the usual cases (a tag alone, an empty end): it raises and catches an
    # error for each. Few operands: callers repeat the expression, and large methods are not compiled.
    letter = F.ascii(tail).bitwiseOR(F.lit(32)).between(97, 122)
    digits = (
        F.when(F.length(tail) < 2, F.when(tail.rlike("[0-9]"), tail))
        .when(letter, F.substring(tail, 2, (1 << 31) - 1))
        .otherwise(F.regexp_replace(tail, r"^\p{L}", ""))
    )
    parsed = digits.try_cast("bigint")
    if on_bad == "fail":
        bad = F.raise_error(F.concat(F.lit("bad id: "), u)).cast("bigint")
        parsed = F.when(parsed.isNull() & u.isNotNull(), bad).otherwise(parsed)
    elif on_bad != "null":
        raise ValueError(f"on_bad must be 'null' or 'fail', not {on_bad!r}")
    return F.when(u.isNull(), F.lit(ABSENT_ID).cast("bigint")).otherwise(parsed)


def is_bad_id(url: Column | str) -> Column:
    """True for an id that is present but not a number (what ``parse_oa_id`` drops or fails on)."""
    u = _col(url)
    return u.isNotNull() & parse_oa_id(u).isNull()


def valid_id(c: Column | str) -> Column:
    """True for a parsed id that is present and non-negative."""
    return F.coalesce(_col(c), F.lit(ABSENT_ID)) >= 0
