"""Timestamp literals without a time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: _dt.datetime | None) -> Column:
    """A TIMESTAMP_NTZ literal with exactly the fields of ``value``. The
    literal goes through its text: a datetime handed to ``lit`` is taken as an
    instant of the driver's zone and would move with it. An aware value is
    expressed in UTC first, the zone of every stored time."""
    if value is not None and value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(None if value is None else value.isoformat(sep=" ")).cast("timestamp_ntz")
