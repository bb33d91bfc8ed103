"""Local-calendar helpers. Instants are zone-free UTC timestamps; zone and run date are parameters."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "America/Sao_Paulo"


def utc_literal(moment: dt.datetime) -> Column:
    """A zone-free UTC literal; a moment without zone is read as UTC, whatever the session zone."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")


def local_time(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from one zone-free timestamp to a later one; clock changes of the session zone play no part."""
    gap = end - start
    days, hours, minutes, seconds = (F.extract(F.lit(part), gap) for part in ("DAY", "HOUR", "MINUTE", "SECOND"))
    return ((days.cast("bigint") * 24 + hours) * 60 + minutes) * 60 + seconds.cast("double")


def local_date(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_time(instant, zone))


def utc_bounds(day: dt.date, zone: str = LOCAL_ZONE) -> tuple[dt.datetime, dt.datetime]:
    """UTC range that contains every instant of one local day, widened by an hour for clock changes."""
    start = dt.datetime.combine(day, dt.time(), ZoneInfo(zone))
    end = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(), ZoneInfo(zone))
    margin = dt.timedelta(hours=1)
    return tuple(
        moment.astimezone(dt.timezone.utc).replace(tzinfo=None) + shift
        for moment, shift in ((start, -margin), (end, margin))
    )


def on_local_date(instant: Column, day: dt.date, zone: str = LOCAL_ZONE) -> Column:
    """Exact local-date test, with a plain range in front of it that reaches the Parquet scan."""
    low, high = utc_bounds(day, zone)
    return (
        (instant >= utc_literal(low))
        & (instant < utc_literal(high))
        & (local_date(instant, zone) == F.lit(day))
    )
