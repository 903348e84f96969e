"""Column expressions used by the star builders.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` only,
so it stays inside whole-stage codegen and can be used in ``select``,
``withColumn``, ``filter`` or ``groupBy``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.constants import SAS_EPOCH

ColumnLike = Column | str

# Unicode whitespace at either end of a text, as ``str.strip()`` removes it.
_EDGE_WHITESPACE = r"(?U)^\s+|\s+$"


def col_of(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c: ColumnLike, mapping: Mapping[object, str], default: str | None = "N/A") -> Column:
    """``CASE WHEN c = k1 THEN v1 ... ELSE default END`` for a code table given in code."""
    c = col_of(c)
    expr = None
    for code, label in mapping.items():
        expr = F.when(c == F.lit(code), F.lit(label)) if expr is None else expr.when(c == F.lit(code), F.lit(label))
    if expr is None:
        return F.lit(default).cast("string")
    return expr.otherwise(F.lit(default).cast("string"))


def cast_int(c: ColumnLike) -> Column:
    """Number → int as a cast outside ANSI mode does it, which the original ETL relies on: fractions are cut off,
    NaN becomes 0, and values beyond the range become the nearest int. NULL stays NULL."""
    d = col_of(c).cast("double")
    inside = F.greatest(F.lit(-2147483648.0), F.least(F.lit(2147483647.0), F.nanvl(d, F.lit(0.0))))
    return F.when(d.isNotNull(), inside.cast("int"))


def day_to_date(day: ColumnLike, epoch: str = SAS_EPOCH) -> Column:
    """INT days since ``epoch`` → DATE."""
    return F.date_add(F.lit(epoch).cast("date"), col_of(day))


def day_to_date_or_marker(day: ColumnLike, marker: str | None = "N/A", epoch: str = SAS_EPOCH) -> Column:
    """``epoch_day_to_date_or_marker`` of a column that is INT already (it is named several times, so a cast would
    be repeated)."""
    d = col_of(day)
    as_date = day_to_date(d, epoch)
    if marker is None:
        return F.when(d >= 1, as_date).otherwise(F.lit(None).cast("date"))
    return (F.when(d >= 1, as_date.cast("string"))
            .when(d.isNull(), F.lit(None).cast("string"))
            .otherwise(F.lit(marker)))


def epoch_day_to_date(days: ColumnLike, epoch: str = SAS_EPOCH) -> Column:
    """Days since ``epoch`` (SAS numeric date) → DATE. Fractions are truncated; NaN is day 0 (see ``cast_int``)."""
    return day_to_date(cast_int(days), epoch)


def epoch_day_to_date_or_marker(days: ColumnLike, marker: str | None = "N/A",
                                epoch: str = SAS_EPOCH) -> Column:
    """Day ≥ 1 → date, NULL → NULL, anything else (day 0 or less, NaN) → ``marker``.

    With a marker the result is STRING (``yyyy-MM-dd`` or the marker), as the
    original CASE yields outside ANSI mode. ``marker=None`` gives a DATE.
    """
    return day_to_date_or_marker(cast_int(days), marker, epoch)


def age_at_year(birth_year: ColumnLike, year: int) -> Column:
    """``year - birth_year``; the original fixes the year at 2016."""
    return F.lit(year) - col_of(birth_year)


def upper_trim(c: ColumnLike) -> Column:
    """SQL ``TRIM(UPPER(c))``: removes blanks only."""
    return F.trim(F.upper(col_of(c)))


def strip_whitespace(c: ColumnLike) -> Column:
    """pandas ``str.strip()``: removes all whitespace (tabs, newlines, ...)."""
    return F.regexp_replace(col_of(c), _EDGE_WHITESPACE, "")


def strip_upper(c: ColumnLike) -> Column:
    """pandas ``str.strip().str.upper()``."""
    return F.upper(strip_whitespace(c))


def text_length(c: ColumnLike) -> Column:
    return F.length(col_of(c))


def split_after_first(c: ColumnLike, sep: str = "-") -> Column:
    """Second part after the first ``sep`` of the stripped text; NULL if absent.

    ``F.get`` returns NULL for a missing index instead of failing in ANSI mode.
    """
    return F.get(F.split(strip_whitespace(c), _regex_literal(sep), 2), 1)


def split_coordinates(c: ColumnLike, sep: str = ", ") -> tuple[Column, Column]:
    """``"a, b"`` → two doubles (NULL when the part is missing or not a number)."""
    parts = F.split(col_of(c), _regex_literal(sep))
    return F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")


def parse_date(c: ColumnLike, fmt: str | None = None, as_timestamp: bool = False, strict: bool = False) -> Column:
    """Text → DATE (default) or TIMESTAMP; unparsable text gives NULL, with ``strict`` it fails the job."""
    c = col_of(c)
    if strict:
        found = parse_date(c, fmt, as_timestamp)
        problem = F.raise_error(F.concat(F.lit("not a date: "), c)).cast("timestamp" if as_timestamp else "date")
        return F.when(c.isNotNull() & found.isNull(), problem).otherwise(found)
    if as_timestamp:
        return F.try_to_timestamp(c, F.lit(fmt)) if fmt else c.try_cast("timestamp")
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("date")
    return c.try_cast("date")


def fill_missing(c: ColumnLike, value: object = "") -> Column:
    return F.coalesce(col_of(c), F.lit(value))


def _regex_literal(text: str) -> str:
    """Escape ``text`` for a Java regex (``split`` takes a pattern)."""
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in text)
