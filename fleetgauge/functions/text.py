"""Text helpers: defaults for blanks, one-line statements, signatures and evidence bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholders shown in evidence.
UNKNOWN = "(unknown)"
NONE = "(none)"
UNAVAILABLE = "(unavailable)"


def or_default(value: Column, default: str) -> Column:
    """The value, or the default when it is NULL or only white space."""
    return F.when(value.rlike(r"\S"), value).otherwise(F.lit(default))


def empty_to(value: Column, default: str) -> Column:
    """The value, or the default when it is NULL or the empty string."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def name_key(name: Column) -> Column:
    """What names are compared by: as under the servers' usual collation, case and blanks at the end do not count."""
    return F.lower(F.rtrim(name))


def one_line(statement: Column, limit: int | None) -> Column:
    """Carriage returns and line feeds become blanks; ``limit`` bounds the stored text, None keeps it whole."""
    # One character replaces one, so cutting first gives the same text for less work.
    kept = statement if limit is None else F.substring(statement, 1, limit)
    return F.replace(F.replace(kept, F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))


def signature(statement: Column) -> Column:
    """Upper-case hex SHA-1 over the UTF-16LE bytes."""
    return F.upper(F.sha1(F.encode(statement, "UTF-16LE")))


def plain_number(value: Column, scale: int) -> Column:
    """A number without trailing zeros, rounded to ``scale`` digits."""
    text = F.round(value, scale).cast(f"decimal(28,{scale})").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def moment_text(ts: Column) -> Column:
    """MM/dd/yyyy HH:mm:ss, rearranged from yyyy-MM-dd HH:mm:ss; date formats would go through the session zone."""
    plain = ts.cast("string")

    def part(start: int, length: int) -> Column:
        return F.substring(plain, start, length)

    return F.concat(part(6, 2), F.lit("/"), part(9, 2), F.lit("/"), part(1, 4), part(11, 9))


def details(fields: Sequence[tuple[str, Column] | tuple[str, Column, str]]) -> Column:
    """One "Label: value" line per field; NULL shows as nothing, or as the field's placeholder."""
    lines = []
    for label, value, *placeholder in fields:
        text = value.cast("string")
        shown = or_default(text, placeholder[0]) if placeholder else F.coalesce(text, F.lit(""))
        lines.append(F.concat(F.lit(f"{label}: "), shown))
    return F.concat_ws("\n", *lines)
