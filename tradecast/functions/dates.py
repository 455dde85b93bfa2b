"""Calendar expressions (native Spark functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish (es-ES) month names, month abbreviations and day names,
# January..December and Monday..Sunday.
MONTH_NAMES_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio",
                  "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
MONTH_SHORT_ES = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep",
                  "oct", "nov", "dic"]
DAY_NAMES_ES = ["lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo"]

# Season bands on the ISO week number and their names.
PEAK1_WEEKS = (3, 6)
PEAK2_WEEKS = (15, 18)
SEASON_PEAK1 = "San Valentin"
SEASON_PEAK2 = "Dia de la Madre"
SEASON_NORMAL = "Normal"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(x) -> Column:
    """Timestamps (ntz or ltz) and text to DATE."""
    return F.to_date(_c(x))


def iso_week(d) -> Column:
    """ISO-8601 week number (``EXTRACT(WEEK)``)."""
    return F.weekofyear(_c(d))


def iso_dow(d) -> Column:
    """ISO day of week, Monday = 1 … Sunday = 7 (``EXTRACT(ISODOW)``)."""
    return F.weekday(_c(d)) + F.lit(1)


def iso_year(d) -> Column:
    """ISO-8601 week-numbering year (the year of that week's Thursday)."""
    c = _c(d)
    return F.year(F.date_add(c, F.lit(4) - iso_dow(c)))


def month_start(d) -> Column:
    """``DATE_TRUNC('month', d)::date``."""
    return F.trunc(_c(d), "month")


def quarter_start(d) -> Column:
    """``DATE_TRUNC('quarter', d)::date``."""
    return F.trunc(_c(d), "quarter")


def week_end_sunday(d) -> Column:
    """End (Sunday) of the Monday–Sunday week holding ``d``; a Sunday maps to itself.

    Same as pandas ``to_period('W-SUN').end_time``.
    """
    c = _c(d)
    return F.date_add(c, (F.lit(7) - iso_dow(c)) % F.lit(7))


def weeknum_monday(d) -> Column:
    """``WEEKNUM(d, 2)``: week 1 holds 1 January, weeks start on Monday (not ISO)."""
    c = _c(d)
    jan1 = F.make_date(F.year(c), F.lit(1), F.lit(1))
    return F.floor((F.dayofyear(c) - F.lit(1) + F.weekday(jan1)) / F.lit(7)).cast("int") + F.lit(1)


def valentines_day(year) -> Column:
    """14 February of ``year``."""
    return F.make_date(_c(year), F.lit(2), F.lit(14))


def mothers_day(year) -> Column:
    """Second Sunday of May of ``year``."""
    may1 = F.make_date(_c(year), F.lit(5), F.lit(1))
    return F.date_add(week_end_sunday(may1), F.lit(7))


def season(d) -> Column:
    """Season band from the ISO week of ``d`` (first match wins)."""
    w = iso_week(d)
    return (F.when(w.between(*PEAK1_WEEKS), F.lit(SEASON_PEAK1))
            .when(w.between(*PEAK2_WEEKS), F.lit(SEASON_PEAK2))
            .otherwise(F.lit(SEASON_NORMAL)))


def _lookup(names: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx)


def month_name_es(d) -> Column:
    return _lookup(MONTH_NAMES_ES, F.month(_c(d)))


def month_short_es(d) -> Column:
    return _lookup(MONTH_SHORT_ES, F.month(_c(d)))


def day_name_es(d) -> Column:
    return _lookup(DAY_NAMES_ES, iso_dow(_c(d)))


def year_month(d) -> Column:
    """``FORMAT(d, "YYYY-MM")``."""
    return F.date_format(_c(d), "yyyy-MM")


def year_week_key(year, week) -> Column:
    """``Year & "-" & FORMAT(week, "00")``."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(week).cast("string"), 2, "0"))


def days_between(later, earlier) -> Column:
    """Whole days ``later - earlier`` (PostgreSQL ``date - date``)."""
    return F.datediff(_c(later), _c(earlier))
