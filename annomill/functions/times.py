"""Epoch seconds to times that do not depend on the session's zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_time(epoch: Column) -> Column:
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=epoch)


def iso_utc(epoch: Column) -> Column:
    """``2024-01-31T09:30:00``; NULL stays NULL."""
    return F.replace(utc_time(epoch).cast("string"), F.lit(" "), F.lit("T"))
