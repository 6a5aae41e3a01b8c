"""Date and time text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text formats of dates and time stamps.
DATE = "yyyy-MM-dd"
STAMP = "yyyy-MM-dd HH:mm:ss"


def day_of(text: Column | str) -> Column:
    return F.to_date(text, DATE)


def stamp(moment: Column | None = None) -> Column:
    """A moment, by default the current one, as text."""
    return F.date_format(F.current_timestamp() if moment is None else moment, STAMP)
