"""Moments as epoch microseconds, the same in every session time zone.

Zone-less timestamps count from their own 1970-01-01 00:00; casting them to instants would
bring in the session's zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micros(frame: DataFrame, name: str) -> Column:
    """Epoch microseconds of a timestamp column of either type."""
    moment = F.col(name)
    if not isinstance(frame.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(moment)
    day = F.unix_date(moment.cast("date")).cast("long")
    minutes = (day * 24 + F.hour(moment)) * 60 + F.minute(moment)
    seconds = F.extract(F.lit("SECOND"), moment)  # with its fraction, as a decimal
    return minutes * 60000000 + (seconds * 1000000).cast("long")


def moment(count: Column, kind: T.DataType) -> Column:
    """The timestamp of type ``kind`` at an epoch microsecond."""
    if not isinstance(kind, T.TimestampNTZType):
        return F.timestamp_micros(count)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days = F.floor(count / 86400000000).cast("int")
    rest = (count - days.cast("long") * 86400000000).cast("decimal(17,0)") / 1000000
    return epoch + F.make_dt_interval(days=days, secs=rest.cast("decimal(18,6)"))
