"""Date and time functions: T1-T9.

Every clock read is an explicit ``as_of`` date (Q16); helpers accept a
``datetime.date``, ISO text or a Column.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Month names used in the monthly folder layout ``<yyyy>/<MM. Name>``.
MONTH_NAMES_ES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(as_of) -> Column:
    """``as_of`` (date, ISO text or Column) as a DATE column."""
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def today_in(tz: str) -> Column:
    """The current day in a named zone (only when no ``as_of`` is given)."""
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), tz))


def ymd_to_dmy(c) -> Column:
    """``yyyyMMdd`` text -> ``dd/MM/yyyy`` text; invalid -> null."""
    return F.date_format(F.try_to_date(_c(c), "yyyyMMdd"), "dd/MM/yyyy")


def parse_day_first(c) -> Column:
    """``d/M/yyyy`` text -> DATE; invalid (``31/02/2026``) -> null."""
    return F.try_to_date(_c(c), "d/M/yyyy")


def month_window(as_of, days_before: int = 10) -> tuple[Column, Column]:
    """T4: (first day of the month - ``days_before``, last day of the month)."""
    d = as_date(as_of)
    return F.date_sub(F.trunc(d, "MM"), days_before), F.last_day(d)


def in_month_window(date_col, as_of, days_before: int = 10) -> Column:
    """closed window test; null dates are out."""
    lo, hi = month_window(as_of, days_before)
    return F.coalesce(_c(date_col).between(lo, hi), F.lit(False))


def whole_days(start, as_of) -> Column:
    """T5: whole days from ``start`` (date or timestamp) to ``as_of`` midnight,
    floored like a pandas ``Timedelta.days`` (a start at 10:00 thirty days
    before gives 29, negatives floor too)."""
    start_ts = _c(start).cast("timestamp_ntz")
    day = F.to_date(start_ts)
    # dates and the time within the day, so that no zone's clock change takes part
    late = (start_ts > day.cast("timestamp_ntz")).cast("int")
    return (F.date_diff(as_date(as_of), day) - late).cast("int")


def parse_timestamp(c) -> Column:
    """A start-date text or timestamp -> TIMESTAMP_NTZ; invalid -> null.

    Accepts ISO ``yyyy-MM-dd[ HH:mm[:ss[.fraction]]]`` (blank or ``T``) and
    day-first ``d/M/yyyy[ H:m]``.  No session time zone takes part.
    """
    c = _c(c)
    s = c.cast("string")
    iso = F.regexp_replace(s, r"^(\d{1,2})/(\d{1,2})/(\d{4})(?: (\d{1,2}:\d{1,2}))?$", "$3-$2-$1 $4")
    iso = F.rtrim(iso)
    good = iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?$")
    return F.when(good, iso.try_cast("timestamp_ntz"))


def display_texts(ts) -> dict[str, Column]:
    """Timestamp -> ``dd/MM/yyyy HH:mm``, ``dd/MM/yyyy`` and ``HH:mm`` texts."""
    ts = _c(ts)
    return {
        "stamp": F.date_format(ts, "dd/MM/yyyy HH:mm"),
        "date": F.date_format(ts, "dd/MM/yyyy"),
        "time": F.date_format(ts, "HH:mm"),
    }


def month_label(d, names=MONTH_NAMES_ES) -> Column:
    """``MM. Name`` folder label of a date (Column, column name or a
    ``datetime.date``)."""
    d = as_date(d) if isinstance(d, _dt.date) else _c(d)
    arr = F.array(*[F.lit(n) for n in names])
    return F.concat(F.date_format(d, "MM"), F.lit(". "), F.element_at(arr, F.month(d)))


def month_starts(as_of) -> tuple[_dt.date, _dt.date]:
    """T9 (driver side, from a parameter): first day of the month of ``as_of``
    and of the previous month."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    cur = as_of.replace(day=1)
    prev = (cur - _dt.timedelta(days=1)).replace(day=1)
    return cur, prev


def contact_folder_paths(base: str, cloud: str | None, as_of, names=MONTH_NAMES_ES) -> list[str]:
    """The contact-list folders in the order in which they win: the current load, the history of the
    month of ``as_of`` and of the month before, then the folder of cloud bases."""
    base = base.rstrip("/")
    return [f"{base}/Cargue Actual", *month_folder_paths(f"{base}/Historico", as_of, names), *([cloud] if cloud else [])]


def month_folder_paths(root: str, as_of, names=MONTH_NAMES_ES) -> list[str]:
    """``<root>/<yyyy>/<MM. Name>`` folders of the month of ``as_of`` and
    of the month before (a path list built from a parameter, not a listing)."""
    out = []
    for m in month_starts(as_of):
        out.append(f"{root.rstrip('/')}/{m.year:04d}/{m.month:02d}. {names[m.month - 1]}")
    return out
