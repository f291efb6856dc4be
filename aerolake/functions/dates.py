"""Date guard and calendar decomposition (PostgreSQL-equivalent semantics).

* The guard accepts only ``DD/MM/YYYY`` with nothing after the year. Java's ``$``
  also matches before a trailing newline, so the pattern ends with ``\\z``.
* A string that passes the pattern but is no real date (``31/02/2025``) gives
  NULL instead of failing the job. Its parts are cast as ISO text (``try_cast``): a
  parse by pattern costs ten times as much a row, and raises inside for every such text.
* Day of week counts Sunday as 0; month and day names are English and
  blank-padded to 9 characters, like PostgreSQL's ``to_char(d, 'Month'/'Day')``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted reference-date text pattern, and the English names.
DATE_TEXT_PATTERN = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"
NAME_WIDTH = 9
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")
DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_date(text: str | Column) -> Column:
    """DATE from ``DD/MM/YYYY`` text; NULL for anything else or an impossible date."""
    t = _col(text)
    iso = F.concat_ws("-", F.substring(t, 7, 4), F.substring(t, 4, 2), F.substring(t, 1, 2))
    return F.when(t.rlike(DATE_TEXT_PATTERN), iso.try_cast("date"))


def pg_day_of_week(d: str | Column) -> Column:
    """Sunday = 0 ... Saturday = 6 (Spark's ``dayofweek`` starts at Sunday = 1)."""
    return F.dayofweek(_col(d)) - F.lit(1)


def _name(names: tuple[str, ...], number: Column) -> Column:
    """The blank-padded one of ``names``, counted from 1; NULL without a number (``element_at``
    of literals is taken for never NULL in ANSI mode)."""
    return F.get(F.array(*(F.lit(n.ljust(NAME_WIDTH)) for n in names)), number - 1)


def pg_month_name(d: str | Column) -> Column:
    return _name(MONTHS, F.month(_col(d)))


def pg_day_name(d: str | Column) -> Column:
    return _name(DAYS, F.dayofweek(_col(d)))


def calendar_parts(d: str | Column) -> dict[str, Column]:
    """The seven calendar columns of silver, keyed by output name, in order."""
    dc = _col(d)
    return {
        "ano": F.year(dc).cast("int"),
        "mes": F.month(dc).cast("int"),
        "dia": F.dayofmonth(dc).cast("int"),
        "trimestre": F.quarter(dc).cast("int"),
        "dia_semana_num": pg_day_of_week(dc).cast("int"),
        "nome_mes": pg_month_name(dc),
        "nome_dia_semana": pg_day_name(dc),
    }
