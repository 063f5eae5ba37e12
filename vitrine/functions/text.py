"""Column functions: refnames, cleaning, keys, dates, flags.

All are built-in expressions, so they stay inside whole-stage codegen and never
start a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MULTI = "␥"  # separator inside a multi-valued cell


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- refnames ---------------------------------------------------------------


def refname_display(col: Column | str) -> Column:
    """Display name after the last ``)'``; anything else passes through.

    ``(?s)\\A…\\z`` because ``.`` must cross newlines and the end must be the end.
    """
    return F.regexp_replace(_c(col), r"(?s)\A.*\)'(.*)'\z", "$1")


def refname_display_first(col: Column | str) -> Column:
    """Display name after the first ``)'``, by position; null or blank gives null.

    On text without ``)'`` the arithmetic still applies, as in the source query.
    """
    c = _c(col)
    at = F.instr(c, ")'")
    return F.when(c.isNotNull() & (c != ""), F.substring(c, at + 2, F.length(c) - at - 2))


def urn_display(col: Column | str) -> Column:
    """Display name of a value that starts with ``urn:``; trailing text is kept."""
    return F.regexp_replace(_c(col), r"^urn:.*'(.*)'", "$1")


# ---- cleaning -----------------------------------------------------------------


def collapse_ctrl_ws(col: Column | str) -> Column:
    """Each run of tabs and line ends becomes one space."""
    return F.regexp_replace(_c(col), r"[\t\n\r]+", " ")


def scrub_newlines(col: Column | str) -> Column:
    """Every CR or LF becomes a space, without collapsing."""
    return F.translate(_c(col), "\r\n", "  ")


def strip_field_quotes(col: Column | str, first: bool = False, last: bool = False, pairs: bool = True) -> Column:
    """Quotes, backslashes and CR out of one cell.

    The rule needs a neighbouring cell, so the ``first`` cell of a row keeps a
    leading quote and the ``last`` one a trailing quote.  ``pairs`` also makes each
    doubled quote a single one.
    """
    c = F.translate(_c(col), "\\\r", "/")
    if not first:
        c = F.regexp_replace(c, r'\A"', "")
    if not last:
        c = F.regexp_replace(c, r'"\z', "")
    return F.replace(c, F.lit('""'), F.lit('"')) if pairs else c


def escape_backslash(col: Column | str) -> Column:
    return F.replace(_c(col), F.lit("\\"), F.lit("\\\\"))


def replace_delim(col: Column | str, old: str, new: str) -> Column:
    return F.replace(_c(col), F.lit(old), F.lit(new))


def blank_if_null(col: Column | str) -> Column:
    return F.coalesce(_c(col), F.lit(""))


def null_if_blank(col: Column | str) -> Column:
    return F.nullif(_c(col), F.lit(""))


def split_multi(col: Column | str, sep: str = "|") -> Column:
    """Values of a multi-valued cell; a blank cell has none."""
    c = _c(col)
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(
        F.split(c, "\\Q" + sep + "\\E")
    )


def slug(col: Column | str) -> Column:
    return F.lower(F.trim(F.regexp_replace(_c(col), r"[^A-Za-z0-9_-]+", "_")))


def tree_label(col: Column | str) -> Column:
    """Label of a tree node: no double quotes, and a leading ``@x`` shown as ``<x> ``."""
    c = F.replace(_c(col), F.lit('"'), F.lit("'"))
    return F.when(c.startswith("@"), F.concat(F.lit("<"), F.substring(c, F.lit(2), F.length(c)), F.lit("> "))).otherwise(c)


# ---- dates ----------------------------------------------------------------------


def local_date(col: Column | str, hours: int = 8) -> Column:
    """Day of a timestamp after shifting it by ``hours``, as text."""
    return F.date_format(_c(col) + F.make_dt_interval(F.lit(0), F.lit(hours)), "yyyy-MM-dd")


def plain_date(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd")


def local_day(col: Column | str, hours: int = 8) -> Column:
    """As :func:`local_date`, but a date."""
    return F.to_date(_c(col) + F.make_dt_interval(F.lit(0), F.lit(hours)))


def iso_date(col: Column | str) -> Column:
    c = _c(col)
    return F.when(c != "", F.concat(c, F.lit("T00:00:00Z"))).otherwise(c)


def iso_datetime(col: Column | str) -> Column:
    """First space to ``T`` and a ``Z`` at the end, even of a blank cell."""
    return F.concat(F.regexp_replace(_c(col), r"(?s)\A([^ ]*) ", "$1T"), F.lit("Z"))


def series_date(col: Column | str) -> Column:
    """ISO text as (year, zero-based month, day), the form a chart axis takes."""
    day = F.to_date(F.substring(_c(col), 1, 10), "yyyy-MM-dd")
    return F.struct(F.year(day).alias("year"), (F.month(day) - 1).alias("month0"), F.dayofmonth(day).alias("day"))


def parse_date(col: Column | str) -> Column:
    """``M/D/YYYY H:M`` as a timestamp without zone; null when it is not one."""
    shape = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2})$"
    c = _c(col)

    def part(group: int) -> Column:
        return F.regexp_extract(c, shape, group).cast("int")

    return F.when(
        c.rlike(shape),
        F.try_make_timestamp_ntz(part(3), part(1), part(2), part(4), part(5), F.lit(0)),
    )


def reference_number(prefix: str, when: Column | str, row: Column | None = None) -> Column:
    """``prefix`` and the time; with ``row``, a minute stamp and the row number."""
    if row is None:
        return F.concat(F.lit(prefix), F.date_format(_c(when), "yyyyMMddHHmmss"))
    return F.concat(F.lit(prefix), F.date_format(_c(when), "yyyy-MM-dd-HH-mm"), F.lit("-"), row.cast("string"))


# ---- keys and numbers ----------------------------------------------------------


def location_key(col: Column | str) -> Column:
    """Sort key of a location name that no collation can reorder."""
    return F.replace(_c(col), F.lit(" "), F.lit("0"))


def storage_location(location: Column | str, crate: Column | str) -> Column:
    shown = refname_display(crate)
    return F.when(_c(crate).isNull(), _c(location)).otherwise(F.concat_ws("", _c(location), F.lit(": "), shown))


def storage_key(location: Column | str, crate: Column | str) -> Column:
    """Always the key of ``location: crate``; nulls are skipped, the colon is not."""
    return location_key(F.concat_ws("", _c(location), F.lit(": "), refname_display(crate)))


def sortable_number(year: Column, accession: Column, sequence: Column) -> Column:
    return F.format_string("%010d.%010d.%010d", year, accession, sequence)


def object_number(year: Column, accession: Column, sequence: Column) -> Column:
    return F.concat_ws(".", year.cast("string"), accession.cast("string"), sequence.cast("string"))


def numeric_sort(col: Column | str) -> Column:
    """``9999.9999`` as a number; null when the text is not of that form."""
    return F.try_to_number(_c(col), F.lit("9999.9999"))


def valid_count(col: Column | str) -> Column:
    """The value if it is an integer that begins with a digit, else null."""
    c = _c(col)
    return F.when(c.rlike(r"^[0-9]+\s*$"), c)


def dimension_text(dimension: Column | str, value: Column | str, unit: Column | str) -> Column:
    """Null as soon as one part is null."""
    return F.concat(_c(dimension), F.lit(" "), _c(value), F.lit(" "), refname_display(unit))


# ---- flags and categories --------------------------------------------------------


def has_coords(col: Column | str) -> Column:
    return F.when(_c(col) != "", F.lit("yes")).otherwise(F.lit("no"))


def bool_text(col: Column | str) -> Column:
    return F.when(_c(col), F.lit("true")).otherwise(F.lit("false"))


def text_bool(col: Column | str) -> Column:
    return F.when(_c(col) == "true", F.lit("Yes")).otherwise(F.lit("No"))


def flag_on(col: Column | str) -> Column:
    return F.when(_c(col) == "on", F.lit("true")).otherwise(F.lit("false"))


def locality_text(place: Column | str, taxon_range: Column | str) -> Column:
    p, r = _c(place), _c(taxon_range)
    return F.when(p.isNotNull() & (p != ""), refname_display(p)).when(
        p.isNull() & r.isNotNull(), F.concat(F.lit("Geographic range: "), r)
    )


def genus(col: Column | str) -> Column:
    return F.substring_index(_c(col), " ", 1)


def species(col: Column | str) -> Column:
    return F.substring_index(F.substring_index(_c(col), " ex ", 1), " var. ", 1)
