"""Time expressions. Timestamps without zone are read as UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(col: Column) -> Column:
    """Whole seconds; the first cast also accepts TIMESTAMP_NTZ, which cannot cast to long."""
    return F.unix_timestamp(col.cast("timestamp"))


def to_minute(col: Column) -> Column:
    return F.date_trunc("minute", col.cast("timestamp"))


def floor_to(col: Column, minutes: int = 30) -> Column:
    width = minutes * 60
    return F.timestamp_seconds(F.floor(epoch_seconds(col) / width) * width)


def grain(col: Column, name: str) -> Column:
    """``minute`` or ``30min`` as the time part of a cash-point key."""
    return {"minute": to_minute, "30min": floor_to}[name](col)


def minute_label(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd-HH-mm")
