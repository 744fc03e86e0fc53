"""Calendar parts of a contact time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weekday_sun1(ts) -> Column:
    """1 = Sunday .. 7 = Saturday (numbering of the Spark-side models)."""
    return F.dayofweek(_col(ts))


def weekday_mon0(ts) -> Column:
    """0 = Monday .. 6 = Sunday (numbering of the pandas side and the rules)."""
    return F.weekday(_col(ts))


def calendar_columns(ts="contact_ts") -> dict[str, Column]:
    """Year, month, hour, both weekday numberings, day of month."""
    t = _col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "hour": F.hour(t),
        "weekday_sun1": weekday_sun1(t),
        "weekday_mon0": weekday_mon0(t),
        "day_of_month": F.dayofmonth(t),
    }


def with_calendar(df, ts="contact_ts", parts=None):
    cols = calendar_columns(ts)
    if parts is not None:
        cols = {k: v for k, v in cols.items() if k in parts}
    return df.withColumns(cols)


def parse_ts(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """X11: text to naive timestamp; unparsable text gives NULL (not an error)."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def year_month(ts) -> Column:
    """``YYYY-MM`` text."""
    return F.date_format(_col(ts), "yyyy-MM")


def ts_from_parts(day, hour, minute=None, second=None) -> Column:
    """A day plus hours, minutes and seconds, as a naive timestamp."""
    d = F.to_date(_col(day))
    return F.make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d), _col(hour),
        F.lit(0) if minute is None else _col(minute),
        F.lit(0) if second is None else _col(second),
    )


def payday_flag(ts) -> Column:
    """Pay-day window, day of month <= 3, 14..17 or >= 29."""
    d = F.dayofmonth(_col(ts))
    return (d <= 3) | d.between(14, 17) | (d >= 29)
