"""Column expressions for raw text: stripping, missing values, tolerant casts, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters text stripping removes at both ends.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The texts a CSV cell may hold to mean "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def strip(column: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind, not only spaces."""
    return F.btrim(column, F.lit(WHITESPACE))


def na_to_null(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(~column.isin(*NA_TOKENS), column)


def to_double(column: str) -> Column:
    """Text to a finite number, anything else to null."""
    number = F.col(column).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def to_int(column: str) -> Column:
    """Text to whole number; a decimal part is cut off, anything else unreadable is null."""
    return to_double(column).try_cast("int")


def to_day(column: str) -> Column:
    """Text of the form 2025-01-31 to a date, anything else to null.

    The form is checked by its length and dashes, so that the cast, which is much faster
    than a date pattern, does not accept shorter forms.
    """
    text = F.col(column)
    dashes = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when((F.length(text) == 10) & dashes, text.try_cast("date"))


# The forms of a day that are read besides 2025-01-31, month before day.
DAY_FORMS = (
    "yyyy-M-d[ H:m[:s]]", "yyyy-M-d'T'H:m[:s]", "yyyy/M/d[ H:m[:s]]", "M/d/yyyy[ H:m[:s]]", "M-d-yyyy",
    "d MMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMMM yyyy", "yyyyMMdd",
)


def to_any_day(column: str) -> Column:
    """Text of any common form of a day to a date, a time of day left out; anything else to null."""
    tried = [F.try_to_timestamp(F.col(column), F.lit(form)).cast("date") for form in DAY_FORMS]
    return F.coalesce(to_day(column), *tried)


def surrogate_key(*columns: Column | str) -> Column:
    """The same natural key always gets the same surrogate key, different ones different keys:
    separators inside a part are escaped and a null part has a mark of its own."""

    def part(column: Column | str) -> Column:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        return F.coalesce(escaped, F.lit("\\N"))

    return F.md5(F.concat_ws("|", *map(part, columns)))
