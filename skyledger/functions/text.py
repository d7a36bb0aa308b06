"""String and array column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def starts_with(c: Column, prefix: str) -> Column:
    """prefix test."""
    return c.startswith(F.lit(prefix))


def empty_if_null(c: Column) -> Column:
    """null -> ``''``."""
    return F.coalesce(c, F.lit(""))


def remove_from(arr: Column, value: Column) -> Column:
    """remove every occurrence of ``value``."""
    return F.array_remove(arr, value)


def is_empty(arr: Column) -> Column:
    """empty (or null) list."""
    return F.coalesce(F.size(arr) == 0, F.lit(True))


def comma_split(s: Column) -> Column:
    """split on commas, trim, drop blanks."""
    return F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != F.lit(""))


def json_string(s: Column) -> Column:
    """JSON text of a string in ASCII: quotes, backslashes and control characters escaped, other characters as
    ``\\uXXXX`` in lower case, those beyond the basic plane as two. Null -> ``null``."""
    def escaped(c: Column) -> Column:
        code = F.ascii(c)
        unit = lambda x: F.format_string("\\u%04x", x)
        short = F.create_map(*[F.lit(x) for pair in _SHORT.items() for x in pair])
        over = code - 0x10000
        return F.coalesce(F.get(F.array(short[c]), F.lit(0)),
                          F.when((code >= 0x20) & (code <= 0x7E), c).when(code < 0x10000, unit(code))
                          .otherwise(F.concat(unit(F.shiftright(over, 10) + 0xD800), unit(F.pmod(over, F.lit(1024)) + 0xDC00))))

    characters = F.regexp_extract_all(s, F.lit("(?s)(.)"), F.lit(1))
    plain = F.concat(F.lit('"'), s, F.lit('"'))
    return F.when(s.isNull(), F.lit("null")).when(s.rlike(r'^[ !#-\[\]-~]*$'), plain).otherwise(
        F.concat(F.lit('"'), F.array_join(F.transform(characters, escaped), ""), F.lit('"')))


# JSON's short escapes.
_SHORT = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def station_label(name: Column, wmo_index: Column) -> Column:
    """F32: ``name (id)``, id alone when there is no name."""
    return F.coalesce(F.concat(name, F.lit(" ("), wmo_index, F.lit(")")), wmo_index)
